"""Every report and operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallywright.functions import dates, filters, money, text
from tallywright.operators import (
    batch_numbers,
    column_widths,
    entity_hierarchy,
    first_in_group,
    labelled_sums,
    left_join_coalesced,
    number_rows,
    occurrence_count,
    pivot_sums,
    range_sums,
    unpivot_present,
)
from tallywright.plans import documents, fees, franchise, ledgers, statements, stores
from tallywright.registry import settings as s
from tallywright.registry.views import LogicalTables
from tallywright.sources.staging import new_run_id, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[LogicalTables], DataFrame]) -> Callable[[LogicalTables], DataFrame]:
    QUERIES[make.__name__] = lambda spark, sf_dir: make(LogicalTables(spark, sf_dir))
    return make


def _platform(t: LogicalTables) -> statements.Platform:
    return statements.Platform(
        entity=t.entity,
        transaction=t.txn,
        payment_intent=t.payment_intent,
        contract=t.contract,
        payout=t.merchant_payout,
        payout_transaction=t.mpt,
        fee_payout=t.mfp,
        fee_payout_payout=t.mfpmp,
        charge=t.charge,
        payout_charge=t.mpc,
        tasks=t.tasks,
    )


def _processor(t: LogicalTables) -> ledgers.Processor:
    return ledgers.Processor(t.entity, t.ledger_transaction, t.merchant_fee)


def _back_office(t: LogicalTables) -> stores.BackOffice:
    return stores.BackOffice(
        stores=t.stores,
        general_prefs=t.general_prefs,
        store_status=t.store_status,
        chains=t.chains,
        cas_clubs=t.cas_clubs,
        cas_companies=t.cas_companies,
        store_info=t.store_info,
        site_type=t.site_type,
        remit_adjustments=t.remit_adjustments,
        cas_reconcile=t.cas_reconcile,
        payments=t.payments,
    )


def _franchise(t: LogicalTables) -> franchise.Franchise:
    return franchise.Franchise(
        stores=t.stores,
        general_prefs=t.general_prefs,
        settlement_log=t.settlement_log,
        settlement_log_fee=t.settlement_log_fee,
        reconcile_fee=t.reconcile_fee,
        fee_category=t.fee_category,
        remit_adjustments=t.remit_adjustments,
        cas_reconcile=t.cas_reconcile,
        cas_clubs=t.cas_clubs,
        payments=t.payments,
        store_detail=t.store_detail,
    )


# --- reports -------------------------------------------------------------------------------------------------------


@query
def stmt_transaction_level(t):
    return statements.transaction_statement(_platform(t))


@query
def stmt_payout_level(t):
    return statements.payout_statement(_platform(t))


@query
def stmt_summary_level(t):
    return statements.summary_statement(_platform(t))


@query
def fee_profiles(t):
    return fees.fee_profiles(t.entity, t.merchant_fee_profile, t.merchant, t.fee_profile)


@query
def profitability_daily(t):
    return ledgers.daily_profitability(_processor(t), s.START, s.END)


@query
def transaction_ledger(t):
    return ledgers.transaction_ledger(_platform(t), s.EXCLUDED_MERCHANTS, s.CHARGES_AFTER)


@query
def operating_account(t):
    return ledgers.operating_account(_processor(t), s.DIVISIONS, s.ACCOUNTS)


@query
def merchant_processing_view(t):
    return fees.merchant_processing_view(t.fee_lines)


@query
def store_dimension_remit(t):
    return stores.stores_by_remit_group(_back_office(t), s.REMIT)


@query
def store_dimension_brand(t):
    return stores.stores_by_brand(_back_office(t), s.BRAND)


@query
def store_accrual_balance(t):
    dimension = stores.stores_by_remit_group(_back_office(t))
    balances = stores.with_accrual_balance(dimension, t.remit_adjustments, t.cas_reconcile, s.CUTOFF)
    return balances.select("StoreId", "SiteTypeId", "AccrualBalance")


@query
def store_accrual_positive(t):
    cutoff, only_positive = stores.accrual_cutoff(2, s.TODAY, s.CUTOFF)
    dimension = stores.stores_by_remit_group(_back_office(t))
    kept = stores.with_accrual_balance(dimension, t.remit_adjustments, t.cas_reconcile, cutoff, only_positive)
    return kept.select("StoreId", "SiteTypeId", "AccrualBalance")


def _period(t: LogicalTables, period: int, columns: str, accrual_mode: int | None = None) -> DataFrame:
    dimension = stores.stores_by_remit_group(_back_office(t))
    accruals = (t.remit_adjustments, t.cas_reconcile)
    return stores.management_financials(
        dimension, *accruals, t.payments, s.TODAY, s.START, s.END, period, columns, accrual_mode
    )


@query
def management_financials_today(t):
    return _period(t, dates.PERIOD_MONTH, "all", accrual_mode=1)


@query
def management_financials_end(t):
    return _period(t, dates.PERIOD_MONTH, "all", accrual_mode=2)


@query
def store_period_transactions(t):
    return _period(t, dates.PERIOD_WEEK, "all")


@query
def store_month_transactions(t):
    return _period(t, dates.PERIOD_MONTH, "cc,ec")


@query
def store_quarter_transactions(t):
    return _period(t, dates.PERIOD_QUARTER, "cc")


@query
def store_year_transactions(t):
    return _period(t, dates.PERIOD_YEAR, "ec")


@query
def franchise_fee_staging(t):
    return franchise.staging(_franchise(t), s.FRANCHISE)


@query
def ff_category_skeleton(t):
    return franchise.category_skeleton(_franchise(t), s.FRANCHISE)


@query
def ff_settlement_wide(t):
    return franchise.settlement_wide(_franchise(t), s.FRANCHISE)


@query
def ff_fee_lines(t):
    return franchise.fee_lines(_franchise(t), s.FRANCHISE)


@query
def ff_fee_adjustments(t):
    return franchise.fee_adjustments(_franchise(t), s.FRANCHISE)


@query
def franchise_fee_report(t):
    return franchise.franchise_fee_report(_franchise(t), s.FRANCHISE, s.REPORT_DATE, s.AS_OF)


@query
def reconcile_fee_minimums(t):
    patterns = {**franchise.FEE_MINIMUMS, "OtherFee": "Fee%"}
    return franchise.with_fee_minimums(t.stores.select(F.col("StoreID").alias("StoreId")), t.reconcile_fee, s.AS_OF, patterns)


@query
def workbook_split(t):
    return documents.workbook_rows(t.workbook_rows, ["annual_sales_volume"])


def _sections(t: LogicalTables) -> list[documents.Section]:
    summary = t.mfp.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("fee_payouts"), F.sum("amount").alias("fee_cents")
    )
    deposits = (
        t.mfp.filter(F.col("status") != "FAILED")
        .select(F.col("id").alias("merchant_fee_payout_id"), "merchant_id")
        .join(t.mfpmp, "merchant_fee_payout_id")
        .join(t.merchant_payout.withColumnRenamed("id", "merchant_payout_id"), "merchant_payout_id")
        .select("merchant_id", "merchant_payout_id", "funding_type", "gross_amount")
    )
    platform_fees = t.mfp.select("merchant_id", F.col("id").alias("fee_payout"), "status", "amount")
    charges = t.charge.select(F.col("entity_id").alias("merchant_id"), F.col("id").alias("charge"), "type", "amount")
    return [
        documents.Section("Account Info", t.account_info, ["merchant_id", "merchant_name"], keep_ids=True),
        documents.Section("Summary", summary, ["merchant_id"]),
        documents.Section("Deposit Detail", deposits, ["merchant_payout_id"]),
        documents.Section("Platform Fees", platform_fees, ["fee_payout"]),
        documents.Section("Charges", charges, ["charge"]),
    ]


@query
def workbook_sheets(t):
    return documents.workbook_sheets(t.workbook_rows, "group_name", ["annual_sales_volume"], ["merchant_id", "contact_phone"])


@query
def statement_pack(t):
    return documents.statement_pack(_sections(t))


@query
def statement_run(t):
    salutation = F.replace(F.col("salutation"), F.lit("Shop "), F.lit("Shop"))  # as the file names have it
    files = documents.run_files(t.account_info, "/run")
    return documents.run_manifest(t.recipients.withColumn("salutation", salutation), s.DISPATCH, files, F.lit(s.TODAY))


@query
def statement_run_files(t):
    return documents.run_files(t.account_info, "/run")


@query
def statement_run_pack(t):
    staging_path = f"{shared_folder(t.spark)}/statement-staging"
    run = documents.statement_run(
        _platform(t), t.account_info, t.recipients, s.DISPATCH, "/run", s.START, s.END, staging_path, new_run_id()
    )
    return run.pack


@query
def statement_file_names(t):
    return documents.statement_file_names(t.account_info)


@query
def statement_dispatch_manifest(t):
    return documents.dispatch_manifest(t.recipients, s.DISPATCH, t.attachments, F.lit(s.TODAY))


@query
def statement_batches(t):
    return documents.statement_batches(t.merchant.withColumnRenamed("id", "merchant_id"), s.START, s.END)


@query
def statement_run_estimate(t):
    return documents.run_estimate(t.merchant)


@query
def address_timezone(t):
    return documents.address_timezones(t.addresses, t.address_tz)


# --- joins ---------------------------------------------------------------------------------------------------------


@query
def entity_hierarchy_walk(t):
    return entity_hierarchy(t.entity)


QUERIES["entity_hierarchy"] = QUERIES.pop("entity_hierarchy_walk")


@query
def join_inner(t):
    fees_ = t.settlement_log_fee.join(t.reconcile_fee.select("ReconcileFeeId", "CoreId", "FeeMin"), "ReconcileFeeId")
    return fees_.select("SettlementLogId", "ReconcileFeeId", "CoreId", "FeeMin", "Amount")


@query
def join_left(t):
    intents = t.payment_intent.select(F.col("id").alias("intent"), "contract_id", "card_brand")
    contracts = t.contract.select(F.col("id").alias("contract"), "fee_profile_id")
    return (
        t.txn.select("id", "payment_intent_id")
        .join(intents, F.col("payment_intent_id") == F.col("intent"), "left")
        .join(contracts, F.col("contract_id") == F.col("contract"), "left")
        .select("id", "contract_id", "card_brand", "fee_profile_id")
    )


@query
def join_left_null_reject(t):
    links = t.mfpmp.withColumnRenamed("merchant_payout_id", "payout")
    live = t.mfp.select(F.col("id").alias("fee_payout"), "status")
    return (
        t.mpt.join(links, F.col("merchant_payout_id") == F.col("payout"), "left")
        .join(live, F.col("merchant_fee_payout_id") == F.col("fee_payout"), "left")
        .filter(F.col("status") != statements.FAILED)
        .select("transaction_id", "merchant_payout_id", "fee_payout", "status")
    )


@query
def join_coalesce_key(t):
    kinds = t.ledger_transaction.filter(F.col("transaction_type") == "REVERS").groupBy(
        F.col("activity_date").alias("day")
    )
    busy = kinds.agg(F.count(F.lit(1)).alias("reversals")).withColumn("source", F.lit("Core Monthly"))
    days = t.ledger_transaction.sparkSession.range(1).select(F.explode(dates.calendar(s.START, s.END)).alias("day"))
    costs = t.merchant_fee.groupBy(F.col("statement_date").alias("day"), "source").agg(F.sum("amount").alias("fees"))
    joined = left_join_coalesced(days.join(busy, "day", "left"), costs, ["day"], ["source"])
    return joined.select(
        "day", "reversals", F.coalesce("source", "right_source").alias("source"), F.col("fees").cast("decimal(28,2)").alias("fees")
    )


@query
def join_bridge(t):
    charge = t.charge.select(F.col("id").alias("charge_id"), "amount")
    return (
        t.mfp.select(F.col("id").alias("merchant_fee_payout_id"))
        .join(t.mfpmp, "merchant_fee_payout_id")
        .join(t.mpc, "merchant_payout_id")
        .join(charge, "charge_id")
        .select("merchant_fee_payout_id", "merchant_payout_id", "charge_id", "amount")
    )


@query
def lateral_sum_equi(t):
    sums = (
        t.remit_adjustments.filter(F.col("QuickbookSubcategoryId").isin(85, 86))
        .groupBy(F.col("CreatedByReconcileId").alias("ReconcileId"), F.col("StoreId").alias("CoreId"))
        .agg(F.sum("Amount").alias("ACHAdjustments"))
    )
    log = t.settlement_log.select("SettlementLogId", "ReconcileId", "CoreId")
    return log.join(sums, ["ReconcileId", "CoreId"], "left").select("SettlementLogId", "ACHAdjustments")


@query
def lateral_sum_range(t):
    paid = t.payments.filter(F.col("PurchaseWith") == 1).select(
        F.col("StoreID").alias("CoreId"),
        F.to_date("PaymentDate").alias("day"),
        money.money_text(F.col("TotalAmount")).alias("CardPresent"),
    )
    log = t.settlement_log.select("SettlementLogId", "CoreId", "FromDate", "ToDate")
    keys = ["CoreId", "FromDate", "ToDate"]
    sums = range_sums(paid, log, "CoreId", "day", "FromDate", "ToDate", ["CardPresent"])
    return log.join(sums, keys, "left").select(
        "SettlementLogId", F.col("CardPresent").cast("decimal(27,2)").alias("CardPresent")
    )


@query
def join_multi_key(t):
    log = t.settlement_log.select("SettlementLogId", "ReconcileId", "CoreId", "CoreTypeId")
    lines = t.remit_adjustments.select("ReconcileId", "CoreId", "CoreTypeId", "AdjustmentNo", "Amount")
    joined = log.join(lines, ["ReconcileId", "CoreId", "CoreTypeId"])
    return joined.select("SettlementLogId", "AdjustmentNo", "Amount")


@query
def join_row_offset_range(t):
    prefs = t.general_prefs.select("StoreID", "TimeOffset")
    local = dates.shifted_hours(F.col("PaymentDate"), F.col("TimeOffset"))
    return (
        t.payments.select("PaymentID", "StoreID", "PaymentDate")
        .join(prefs, "StoreID")
        .select("PaymentID", "StoreID", local.alias("local_time"))
        .filter(dates.within_days(F.col("local_time"), s.START, s.CUTOFF))
    )


@query
def semi_join(t):
    open_stores = t.stores.filter(F.col("Deleted") == 0).select("StoreID")
    return t.payments.join(open_stores, "StoreID", "left_semi").select("PaymentID", "StoreID")


@query
def join_config(t):
    division = F.lower(F.trim("division"))
    settings = documents.division_setting(s.DISPATCH, division, "sender")
    joined = t.recipients.select("merchant_id", division.alias("division"), settings.alias("sender"))
    return joined.filter(F.col("sender").isNotNull())


@query
def join_calendar(t):
    days = t.merchant_fee.sparkSession.range(1).select(F.explode(dates.calendar(s.START, s.END)).alias("day"))
    totals = t.merchant_fee.groupBy(F.col("statement_date").alias("day")).agg(F.sum("amount").alias("fees"))
    fees_ = money.zero_if_null(F.col("fees")).cast("decimal(28,2)")
    return days.join(totals, "day", "left").select("day", fees_.alias("fees"))


@query
def join_composite_left(t):
    month = dates.truncated("month", F.col("created_at")).alias("month")
    by_fee = t.mfp.groupBy("merchant_id", month).agg(F.sum("amount").alias("fee_cents"))
    by_txn = t.txn.groupBy("merchant_id", month).agg(F.sum("amount").alias("txn_cents"))
    return by_fee.join(by_txn, ["merchant_id", "month"], "left")


# --- aggregates ----------------------------------------------------------------------------------------------------


@query
def agg_sum_count(t):
    return t.ledger_transaction.groupBy("activity_date", "transaction_type").agg(
        F.sum("settlement_amount").alias("settlement"), F.count(F.lit(1)).alias("transactions")
    )


@query
def agg_count_distinct(t):
    totals = statements.payout_totals(_platform(t))
    return totals.select(
        F.col("totals_mp_id").alias("merchant_payout_id"), "txn_count", "amount_cents", "reversal_count"
    )


@query
def agg_conditional(t):
    payfac = F.col("source").like("PayFac%")
    return t.merchant_fee.groupBy("statement_date").agg(
        money.sum_when(~payfac, F.col("amount"), F.lit(0)).alias("core"),
        money.sum_when(payfac, F.col("amount")).alias("vap"),
    )


@query
def agg_case_of_agg(t):
    month = dates.truncated("month", F.col("created_at")).alias("month")
    gross = F.sum("gross_amount")
    chosen = F.when(F.col("funding_type") == "GROSS", gross).when(F.col("funding_type") == "NET", gross - F.count(F.lit(1)))
    return t.merchant_payout.groupBy(month, "funding_type").agg(
        chosen.otherwise(F.lit(0)).alias("amount")
    )


@query
def agg_expr_key(t):
    label = dates.period_label(dates.PERIOD_QUARTER, F.col("created_at")).alias("quarter")
    return t.txn.groupBy(F.coalesce("original_transaction_id", F.lit("none")).alias("original"), label).agg(
        F.count(F.lit(1)).alias("transactions")
    )


@query
def agg_fanout_ratio(t):
    # the bridge is added up per transaction first, where equal rows meet, then per payout: a hot payout is reduced before it
    # is gathered, and the payouts join one row each
    per_txn = t.mpt.groupBy("merchant_payout_id", "transaction_id").agg(F.count(F.lit(1)).alias("rows"))
    bridge = per_txn.groupBy("merchant_payout_id").agg(F.sum("rows").alias("rows"), F.count("transaction_id").alias("n"))
    paid = t.merchant_payout.select(F.col("id").alias("merchant_payout_id"), "gross_amount")
    joined = paid.join(bridge, "merchant_payout_id", "left")
    repeated = F.col("gross_amount") * F.coalesce("rows", F.lit(1))
    count = F.coalesce("n", F.lit(0))
    return joined.select("merchant_payout_id", money.ratio(money.dollars(repeated), count).alias("adjusted"))


@query
def agg_decimal(t):
    return t.fee_lines.groupBy("Month", "CLUB").agg(
        F.sum(F.col("Total_Fees").cast("decimal(18,2)")).alias("fees"),
        F.sum(F.col("Txn_Count").cast("int")).alias("txns"),
    )


@query
def agg_string_list(t):
    return text.listed_values(t.settlement_log_fee, [], "FeeName", "fee_names")


@query
def distinct_rows(t):
    return t.remit_adjustments.select("StoreId", "RemitAdjustmentTypeId", "Accrual").distinct()


@query
def pivot_dynamic(t):
    named = t.settlement_log_fee.join(t.settlement_log.select("SettlementLogId", "CoreId"), "SettlementLogId")
    return pivot_sums(named, ["CoreId"], "FeeName", "Amount")


@query
def unpivot(t):
    columns = ["Draft_PilTotal_Total", "Net_Total", "SalesTax_Total"]
    return unpivot_present(t.settlement_log, ["SettlementLogId"], columns, "category", "amount")


@query
def multi_label_rollup(t):
    present = F.col("card_present") == "true"
    rules = [
        ("all", F.lit(True), "volume"),
        ("card present", present, "volume"),
        ("reversals", F.col("transaction_type") == "REVERS", "volume"),
        ("present credit", present & (F.col("transaction_type") == "CREDIT"), "volume"),
    ]
    measures = {"volume": F.col("settlement_amount")}
    return labelled_sums(t.ledger_transaction, ["activity_date"], rules, measures, "label", "amount", "decimal(28,2)")


@query
def global_sum(t):
    name = F.col("FeeName")
    return t.settlement_log_fee.agg(
        money.sum_when(name.ilike("heart%"), F.col("Amount")).alias("heart"),
        money.sum_when(name.ilike("%9r%now%"), F.col("Amount")).alias("now"),
    )


@query
def column_width_profile(t):
    return documents.workbook_widths(t.workbook_rows, "group_name", ["annual_sales_volume"])


@query
def column_width_text(t):
    return column_widths(t.account_info, [], {"merchant_id": "Merchant ID", "merchant_name": "Merchant Name"})


@query
def group_iterate(t):
    return t.recipients.groupBy(F.lower(F.trim("division")).alias("division")).agg(
        F.min_by("email", "sheet_row").alias("first_email"), F.count(F.lit(1)).alias("recipients")
    )


@query
def count_by_name(t):
    return t.account_info.groupBy(text.safe_file_name(F.col("merchant_name")).alias("name")).agg(
        F.count(F.lit(1)).alias("merchants")
    )


# --- windows, sorts, sets ------------------------------------------------------------------------------------------


@query
def win_row_number(t):
    return stores.remit_group_list(t.cas_companies, {})


@query
def win_row_number_grouped(t):
    rows = t.txn.select("merchant_id", "created_at", "id")
    numbered = number_rows(rows, ["created_at", "id"], ["merchant_id"], "place")
    return numbered.select("id", "place")


@query
def win_partition_sum(t):
    keys = ["StoreId", "CoreTypeId", "Chain", "RemitAdjustmentTypeId"]
    reduced = t.remit_adjustments.groupBy(*keys, "Accrual").agg(F.sum("Amount").alias("part"))
    total = F.sum("part").over(Window.partitionBy(*keys))
    return reduced.select(*keys, "Accrual", total.alias("total")).distinct()


@query
def first_per_group_flag(t):
    rows = t.recipients.select("sheet_row", F.lower(F.trim("division")).alias("division"))
    return first_in_group(rows, ["division"], ["sheet_row"], "is_first")


@query
def batch_number(t):
    return batch_numbers(t.account_info.select("merchant_id"), ["merchant_id"], 10)


@query
def name_unique_flag(t):
    named = t.account_info.select("merchant_id", text.safe_file_name(F.col("merchant_name")).alias("name"))
    counted = occurrence_count(named, "name", "n")
    return counted.select("merchant_id", (F.col("n") == 1).alias("is_unique"))


@query
def sort_rows(t):
    return t.txn.select("id", "created_at", "type").orderBy("created_at", "type", "id")


@query
def top_1(t):
    named = t.stores.join(t.general_prefs.select("StoreID", "LocationName"), "StoreID")
    return named.filter("ChainID is not null").orderBy("StoreID").limit(1).select("StoreID", "LocationName")


@query
def sort_in_list(t):
    return text.listed_values(t.reconcile_fee, ["CoreId"], "FeeName", "fees", ", ")


@query
def union_all(t):
    by_type = t.txn.select(F.col("id"), F.col("amount"), F.col("currency"))
    charges = t.charge.select("id", "amount")
    return by_type.unionByName(charges, allowMissingColumns=True)


@query
def insert_append(t):
    return stores.remit_group_list(t.cas_companies, {-1: 0.5, -2: 0.4, -3: 0.3, -4: 0.2})


# --- expressions ---------------------------------------------------------------------------------------------------


@query
def text_expressions(t):
    name, path = F.col("merchant_name"), F.col("attachment_path")
    joined = t.account_info.join(t.recipients, "merchant_id")
    return joined.select(
        "merchant_id",
        text.clean_string(name).alias("cleaned"),
        text.safe_file_name(name).alias("safe"),
        text.base_name(path).alias("base"),
        F.element_at(F.split("salutation", ","), 1).alias("greeting"),
        F.regexp_extract(text.base_name(path), r"^(.*)_Statement\.pdf$", 1).alias("captured"),
        F.concat_ws(", ", F.nullif(F.trim("division"), F.lit("unknown")), F.col("email")).alias("joined"),
        F.upper(F.trim("division")).alias("division"),
        F.length(name).alias("name_length"),
        F.format_string("%s <%s>", "merchant_id", "email").alias("template"),
    )


@query
def address_expressions(t):
    return t.general_prefs.select(
        "StoreID",
        text.address_line(F.col("ClubAddress"), F.col("ClubCity"), F.col("ClubState"), F.col("ClubZip")).alias("address"),
        text.trimmed(text.mapped(F.col("ClubState"), stores.STATE_CODES)).alias("state"),
        F.contains("LocationName", F.lit("BRAND")).alias("branded"),
    )


@query
def list_parameter(t):
    wanted = [int(part) for part in text.split_list("1, 3, 9")]
    return t.stores.filter(filters.in_if_set(F.col("Status"), wanted)).select("StoreID", "Status")


@query
def list_relation(t):
    wanted = text.list_relation(t.spark, " 9, 1,,3 ,1, ", "status")
    statuses = wanted.select(F.col("status").cast("int").alias("Status"), F.col("place").cast("long").alias("place"))
    return t.stores.select("StoreID", "Status").join(statuses, "Status")


@query
def date_expressions(t):
    c = F.col("created_at")
    d = F.to_date(c)
    return t.txn.select(
        "id",
        dates.truncated("month", c).alias("month_start"),
        dates.truncated("quarter", c).alias("quarter_start"),
        dates.truncated("year", c).alias("year_start"),
        dates.padded_month(c).alias("month_name"),
        dates.month_sort_label(dates.month_before(c)).alias("month_before"),
        dates.weekday_label(c).alias("weekday"),
        F.weekofyear(c).alias("iso_week"),
        dates.us_week(d).alias("us_week"),
        dates.first_of_next_month(d).alias("next_month"),
        F.add_months(d, -1).alias("earlier"),
        F.date_add(d, 10).alias("later"),
        dates.period_label(dates.PERIOD_WEEK, c).alias("week_label"),
        dates.period_label(dates.PERIOD_MONTH, c).alias("month_label"),
        dates.previous_month_tag(d).alias("tag"),
        dates.shifted_hours(c, F.lit(-5)).alias("local_time"),
    )


@query
def money_expressions(t):
    return t.payments.select(
        "PaymentID",
        money.money_text(F.coalesce("TotalAmount", "Amount")).alias("amount"),
        money.ratio(money.dollars(F.col("PaymentID")), F.col("PurchaseWith") - 2).alias("ratio"),
        F.ceil(F.col("PaymentID") / 10).alias("tens"),
        F.coalesce("TotalAmount", "Amount").alias("shown"),
        (-F.col("PurchaseWith")).alias("negative"),
    )


@query
def json_paths(t):
    cfg = F.col("configuration")
    specific = F.get_json_object(cfg, "$.networkSpecificFees")
    amex = F.get_json_object(cfg, "$.networkSpecificFees['American Express'].buyerPct")
    visa = F.get_json_object(cfg, "$.networkSpecificFees.Visa.buyerPct")
    return t.fee_profile.select(
        "id",
        F.get_json_object(cfg, "$.defaultAchFees.buyerPct").alias("ach"),
        amex.alias("amex"),
        (specific == "{}").alias("no_networks"),
        F.concat_ws(", ", F.when(amex.isNotNull(), "American Express"), F.when(visa.isNotNull(), "Visa")).alias("networks"),
        F.get_json_object(cfg, "$.networkSpecificFees['American Express'].merchantPct").try_cast("decimal(10,2)").alias("unreadable"),
    )


@query
def filter_expressions(t):
    joined = t.stores.join(t.general_prefs, "StoreID", "left")
    tests = [
        filters.equals_if_set(F.col("ChainID"), None),
        filters.in_if_set(F.col("Status"), (1, 2, 7)),
        filters.region_mode(F.col("clubcountry"), F.col("ClubState"), 3),
        text.any_like(F.col("LocationName"), ["brand_%", "Club%1%"]),
        F.col("CollectionsBy").between(0, 1),
    ]
    kept = joined.filter(filters.all_of(tests))
    return filters.delete_where(kept, F.col("ChainID") == 4).select("StoreID", "ChainID", "clubcountry", "ClubState")
