"""Franchise-fee staging and report: settlement rows, fee lines and adjustments, made long and then pivoted.

`chain_id=None` stands for every chain, so that one job covers all of them.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywright.functions import dates, filters, text
from tallywright.functions.money import fixed_point, money_text, sum_when, zero_if_null
from tallywright.operators.rangesums import tagged_range_sums
from tallywright.operators.reshape import distinct_labels, pivot_sums, unpivot_present
from tallywright.plans.stores import accrued

STORE_TYPE = 3
CORPORATE_FEE = 3

# The report's categories, in the source's order.
CATEGORIES = (
    "franchisefee1", "franchisefee1Adj", "franchisefee2", "franchisefee2Adj", "CardPresent", "Down", "Products",
    "Draft", "Collections", "Refunds", "Returns", "NetTotal", "Tax", "TotalAfterTax", "CrCardDraft", "ECheckDraft",
    "CashDraft", "WrittenCheckDraft", "ExtTerminalDraft", "ACHAdjustments", "AmexAdjustments", "HeartMonitorFee",
    "CorporateEmailFee", "InsuranceFee", "CorporateFee", "CorpAdj", "DigitalMarketingService", "SoftwareFee",
    "directcoll", "RemitStatementFee", "LeadSpeakFee", "NowFee", "EmmaFee", "WorkoutScreens", "PCICompliance",
    "CRConnect", "VTS",
)

# Measures read from the settlement row, by category.
SETTLEMENT_MEASURES = {
    "Down": "UpFront_PilTotal_Total",
    "Draft": "Draft_PilTotal_Total",
    "Products": "Product_PilTotal_Total",
    "Collections": "Pdc_PilTotal_Total",
    "DirectColl": "PdcDirect_PilTotal_Total",
    "Refunds": "Refund_RefundTotal_Total",
    "Returns": "Return_PaymentTotal_Total",
    "NetTotal": "Net_Total",
    "Tax": "SalesTax_Total",
    "TotalAfterTax": "Total_AfterTax",
    "ECheckDraft": "Draft_PilTotal_Ach",
    "CashDraft": "Draft_PilTotal_Cash",
    "WrittenCheckDraft": "Draft_PilTotal_WrittenCheck",
    "ExtTerminalDraft": "Draft_PilTotal_External",
}

# Fee category and name pattern of the fees that get a column of their own.
NAMED_FEES = {
    "HeartMonitorFee": (3, "Heart%"),
    "CorporateEmailFee": (3, "%Corp%Email%"),
    "DigitalMarketingService": (3, "%Digital Marketing Service%"),
    "NowFee": (3, "%9r%now%"),
    "EmmaFee": (3, "emma%"),
    "WorkoutScreens": (3, "Workout Screens%"),
    "PCICompliance": (17, "%PCI Compliance%"),
    "CRConnect": (35, "%CR%Connect%"),
    "VTS": (3, "%VTS%"),
}

# Categories whose missing amounts are shown as zero.
ZEROED = ("SoftwareFee", "RemitStatementFee", "NowFee", "EmmaFee")

# The one fee-minimum pattern the source shows in full.
FEE_MINIMUMS = {"WorkoutSystemFee": "%Workout%System%"}


@dataclass(frozen=True)
class Franchise:
    """Tables the franchise-fee report reads."""

    stores: DataFrame
    general_prefs: DataFrame
    settlement_log: DataFrame
    settlement_log_fee: DataFrame
    reconcile_fee: DataFrame
    fee_category: DataFrame
    remit_adjustments: DataFrame
    cas_reconcile: DataFrame
    cas_clubs: DataFrame
    payments: DataFrame
    store_detail: DataFrame


@dataclass(frozen=True)
class FranchiseParams:
    """longest: days a settlement row may span; a row of the period that spans more is an error. So no fact dated earlier
    than that before the start can count, and none is read beyond its date."""

    start: dt.date
    end: dt.date
    chain_id: int | None = None
    store_id: int | None = None
    longest: int = 366

    @property
    def reach(self) -> dt.date:
        return self.start - dt.timedelta(days=self.longest)


def _location(id_column: str) -> Column:
    return F.concat("LocationName", F.lit(" ["), F.col(id_column).cast("string"), F.lit("]"))


def _chain_stores(f: Franchise, params: FranchiseParams) -> DataFrame:
    chosen = F.col("ChainID").isNotNull() if params.chain_id is None else F.col("ChainID") == params.chain_id
    tests = [chosen, filters.equals_if_set(F.col("StoreID"), params.store_id)]
    return f.stores.filter(filters.all_of(tests)).select(
        F.col("StoreID").alias("store_key"), "ChainID", "ExternalStoreID", "CollectionsBy"
    )


def _named_stores(f: Franchise, params: FranchiseParams, how: str = "left") -> DataFrame:
    prefs = f.general_prefs.select(F.col("StoreID").alias("prefs_key"), "LocationName", "ClubState")
    joined = _chain_stores(f, params).join(prefs, F.col("store_key") == F.col("prefs_key"), how)
    return joined.drop("prefs_key").withColumn("ClubState", text.trimmed(F.col("ClubState")))


def _in_period(params: FranchiseParams) -> Column:
    """Settlement rows of stores that end within the report's days."""
    in_days = (F.col("ToDate") >= F.lit(params.start)) & (F.col("ToDate") < F.lit(params.end + dt.timedelta(days=1)))
    return in_days & (F.col("CoreTypeId") == STORE_TYPE)


def _period_log(f: Franchise, params: FranchiseParams) -> DataFrame:
    return f.settlement_log.filter(_in_period(params))


def category_skeleton(f: Franchise, params: FranchiseParams) -> DataFrame:
    """All categories at zero for the first store of each chosen chain, so that the pivot has every column."""
    named = _named_stores(f, params, how="inner").withColumn("Location", _location("store_key"))
    first = named.groupBy("ChainID").agg(
        F.min_by(
            F.struct("store_key", "Location", "ClubState", "ExternalStoreID", "CollectionsBy"),
            F.struct("store_key", "Location", "ClubState"),
        ).alias("s")
    )
    return first.select(
        F.col("s.store_key").alias("CoreId"),
        F.lit(STORE_TYPE).alias("CoreTypeId"),
        F.col("s.Location").alias("Location"),
        F.col("s.ClubState").alias("ClubState"),
        F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("Category"),
        F.lit(0).cast("decimal(17,2)").alias("Amount"),
        F.col("s.ExternalStoreID").alias("ExternalStoreId"),
        F.col("s.CollectionsBy").alias("CollectionsBy"),
    )


def _dated_sums(f: Franchise, params: FranchiseParams) -> DataFrame:
    """Card-present payments and named fees per store and settlement period, in one pass over log, fees and payments.

    A fee counts once for every settlement row that shares the reconciliation, store and type of the row it hangs on,
    so fees are weighted by the number of such rows. That stands for the self-join of the log without pairing rows. A log
    row is a dated fact, and a range of days if it ends in the period.
    """
    keys = _chain_stores(f, params).select("store_key").distinct()
    first_day, last_day = F.lit(params.reach), F.lit(params.end)
    paid = (
        f.payments.filter(
            (F.col("PurchaseWith") == 1)
            & filters.same_text(F.col("GatewayType"), ["CP"])
            & (F.col("PaymentDate") >= first_day)
            & (F.col("PaymentDate") < F.lit(params.end + dt.timedelta(days=1)))
        )
        .select(F.col("StoreID").alias("store_key"), F.to_date("PaymentDate").alias("day"), F.col("TotalAmount"))
        .join(keys, "store_key", "left_semi")
        .select("store_key", "day", money_text(F.col("TotalAmount")).alias("CardPresent"))
    )
    named = {
        name: (F.col("FeeCategoryId") == category) & F.col("FeeName").ilike(pattern)
        for name, (category, pattern) in NAMED_FEES.items()
    }
    fees = (
        f.settlement_log_fee.filter(reduce(operator.or_, named.values()))
        .groupBy(F.col("SettlementLogId").alias("fee_log_id"))
        .agg(*[sum_when(test, F.col("Amount")).alias(name) for name, test in named.items()])
    )
    shared = ["ReconcileId", "CoreId", "CoreTypeId"]
    has_key = F.col("ReconcileId").isNotNull() & F.col("CoreTypeId").isNotNull()
    in_period = _in_period(params)
    long = F.datediff("ToDate", "FromDate") > params.longest
    error = F.concat(F.lit("longer than the parameter `longest`: settlement row "), F.col("SettlementLogId").cast("string"))
    per_day = (
        f.settlement_log.filter(has_key | in_period)
        .select("SettlementLogId", *shared, "FromDate", F.when(in_period, F.col("ToDate")).alias("ToDate"))
        .join(keys, F.col("CoreId") == F.col("store_key"), "left_semi")
        .withColumn("ToDate", F.when(F.assert_true(~F.coalesce(long, F.lit(False)), error).isNull(), F.col("ToDate")))
        .join(fees, F.col("SettlementLogId") == F.col("fee_log_id"), "left")
        .groupBy(*shared, "FromDate", "ToDate")
        .agg(F.count(F.lit(1)).alias("log_rows"), *[F.sum(name).alias(name) for name in NAMED_FEES])
    )
    # by now a key has few rows per day, so counting its settlement rows over a window is bounded by the calendar
    twins = F.sum("log_rows").over(Window.partitionBy(*shared))
    counts = has_key & F.col("FromDate").between(first_day, last_day)
    charged = per_day.withColumn("twins", twins).select(
        F.col("CoreId").alias("store_key"),
        F.when(counts, F.col("FromDate")).alias("day"),
        F.when(F.col("ToDate").isNotNull(), F.col("FromDate")).alias("FromDate"),
        "ToDate",
        *[(F.col(name) * F.col("twins")).alias(name) for name in NAMED_FEES],
    )
    rows = charged.unionByName(paid, allowMissingColumns=True)
    sums = tagged_range_sums(rows, "store_key", "day", "FromDate", "ToDate", ["CardPresent", *NAMED_FEES])
    return sums.select(
        "store_key",
        F.col("FromDate").alias("sum_from"),
        F.col("ToDate").alias("sum_to"),
        *[fixed_point(F.col(m)).alias(m) for m in ("CardPresent", *NAMED_FEES)],
    )


def _adjustment_sums(f: Franchise) -> DataFrame:
    """Per reconciliation and store: adjustments it created and corporate adjustments, in one pass.

    An adjustment can be both: it is tagged for the reconciliation that created it and for the one it belongs to.
    """
    sub, amount = F.col("QuickbookSubcategoryId"), F.col("Amount")
    tag = lambda reconcile, store, kind, value, club: F.struct(
        reconcile.alias("sum_reconcile"), store.alias("sum_store"), F.lit(kind).alias("kind"), value.alias("value"), club.alias("club")
    )
    created, nowhere = (F.col("CreatedByReconcileId"), F.col("StoreId")), F.lit(None).cast(f.remit_adjustments.schema["StoreId"].dataType)
    corporate = (F.col("CoreTypeId") == STORE_TYPE) & (F.col("Chain") == 1) & F.col("AdjustmentForFeeId").isNull()
    tags = F.array(
        F.when(sub.isin(85, 86), tag(*created, "ach", amount, nowhere)),
        F.when(sub.isin(80, 81), tag(*created, "amex", -amount, nowhere)),
        F.when(corporate, tag(F.col("ReconcileId"), F.col("CoreId"), "corp", amount, F.col("StoreId"))),
    )
    clubs = f.cas_clubs.groupBy(F.col("StoreID").alias("club_store")).agg(F.count(F.lit(1)).alias("clubs"))
    keys = ["sum_reconcile", "sum_store"]
    reduced = (
        f.remit_adjustments.select(F.explode(F.array_compact(tags)).alias("t"))
        .select("t.*")
        .filter(F.col("sum_reconcile").isNotNull() & F.col("sum_store").isNotNull())
        .groupBy(*keys, "kind", "club")
        .agg(F.sum("value").alias("value"))
        .join(clubs, F.col("club") == F.col("club_store"), "left")
    )
    of = lambda kind, value: sum_when(F.col("kind") == kind, value)
    return reduced.groupBy(*keys).agg(
        of("ach", F.col("value")).alias("ACHAdjustments"),
        of("amex", F.col("value")).alias("AmexAdjustments"),
        of("corp", F.col("value") * F.coalesce("clubs", F.lit(1))).alias("CorpAdj"),
    )


def settlement_wide(f: Franchise, params: FranchiseParams) -> DataFrame:
    """Distinct settlement rows with their own measures and thirteen sums taken from payments, fees and adjustments.

    The sums depend only on the row's reconciliation, store and dates, so they are worked out per distinct key and
    joined to the distinct rows.
    """
    stores = _named_stores(f, params)
    own = {category: fixed_point(F.col(column)) for category, column in SETTLEMENT_MEASURES.items()}
    own["CrCardDraft"] = fixed_point(F.col("Draft_PilTotal_Vmd") + F.col("Draft_PilTotal_Amex"))
    rows = (
        _period_log(f, params)
        .join(stores, F.col("CoreId") == F.col("store_key"))
        .select(
            "CoreId",
            "CoreTypeId",
            _location("CoreId").alias("Location"),
            "ClubState",
            "ReconcileId",
            "ToDate",
            "FromDate",
            *[value.alias(category) for category, value in own.items()],
            "CollectionsBy",
            F.col("ExternalStoreID").alias("ExternalStoreId"),
        )
        .distinct()
    )
    joined = rows.join(
        _adjustment_sums(f),
        (F.col("ReconcileId") == F.col("sum_reconcile")) & (F.col("CoreId") == F.col("sum_store")),
        "left",
    ).join(
        _dated_sums(f, params),
        (F.col("CoreId") == F.col("store_key")) & (F.col("FromDate") == F.col("sum_from")) & (F.col("ToDate") == F.col("sum_to")),
        "left",
    )
    return joined.select(
        *rows.columns,
        fixed_point(zero_if_null(F.col("ACHAdjustments"))).alias("ACHAdjustments"),
        fixed_point(zero_if_null(F.col("AmexAdjustments"))).alias("AmexAdjustments"),
        fixed_point(F.col("CorpAdj")).alias("CorpAdj"),
        "CardPresent",
        *NAMED_FEES,
    )


STAGED = ("CoreId", "CoreTypeId", "Location", "ClubState", "Category", "Amount", "ExternalStoreId", "CollectionsBy")


def settlement_long(f: Franchise, params: FranchiseParams, added_up: bool = False) -> DataFrame:
    """added_up: the measures of a store's settlement rows are added up while they are columns, before they are made long."""
    wide = settlement_wide(f, params)
    ids = ["CoreId", "CoreTypeId", "Location", "ClubState", "ExternalStoreId", "CollectionsBy"]
    measures = [c for c in wide.columns if c not in (*ids, "ReconcileId", "ToDate", "FromDate")]
    if added_up:
        wide = wide.groupBy(*ids).agg(*[F.sum(c).alias(c) for c in measures])
    return unpivot_present(wide, ids, measures, "Category", "Amount").select(*STAGED)


LINE, ADJUSTMENT = "line", "adjustment"


def _fee_parts(f: Franchise, params: FranchiseParams, kinds: Sequence[str], added_up: bool = False) -> DataFrame:
    """Fee lines outside the corporate category, and adjustments to fees added up per category, store and location.

    Log rows and facts are tagged by kind and keyed alike - a fee line by its settlement row, an adjustment by
    reconciliation, store and type - so each table is read once for both. Rows that share a key, and equal fee lines, are
    counted and added up before they are joined, so a key that many rows share is never paired out; fee lines come back
    one by one at the end, or as one row with their sum if they are to be added up.
    """
    tag = lambda kind, *keys: F.struct(
        F.lit(kind).alias("kind"), *[(F.lit(0) if k is None else F.col(k)).cast("long").alias(f"k{n}") for n, k in enumerate(keys)]
    )
    keys = {LINE: ("SettlementLogId", None, None), ADJUSTMENT: ("ReconcileId", "CoreId", "CoreTypeId")}
    on = ["kind", "k0", "k1", "k2"]
    log = (
        _period_log(f, params)
        .select("CoreId", "CoreTypeId", F.explode(F.array(*[tag(k, *keys[k]) for k in kinds])).alias("t"))
        .groupBy("CoreId", "CoreTypeId", "t")
        .agg(F.count(F.lit(1)).alias("log_rows"))
        .select("CoreId", "CoreTypeId", "t.*", "log_rows")
    )
    # lines keep their amount as a key, adjustments are added up
    lines = f.settlement_log_fee.filter(F.col("FeeCategoryId") != CORPORATE_FEE).select(
        tag(LINE, *keys[LINE]).alias("t"),
        F.col("ReconcileFeeId").alias("fee_key"),
        F.col("FeeCategoryId").alias("line_category"),
        F.col("Amount").alias("line_amount"),
    )
    adjustments = f.remit_adjustments.filter(F.col("AdjustmentForFeeId").isNotNull()).select(
        tag(ADJUSTMENT, *keys[ADJUSTMENT]).alias("t"),
        F.col("AdjustmentForFeeId").alias("fee_key"),
        zero_if_null(F.col("Amount")).alias("adjusted"),
    )
    chosen = [part for kind, part in ((LINE, lines), (ADJUSTMENT, adjustments)) if kind in kinds]
    facts = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1], allowMissingColumns=True)
    amount = f.settlement_log_fee.schema["Amount"].dataType
    for column, kind in (("line_category", "int"), ("line_amount", amount), ("adjusted", f.remit_adjustments.schema["Amount"].dataType)):
        if column not in facts.columns:
            facts = facts.withColumn(column, F.lit(None).cast(kind))
    facts = (
        facts.groupBy("t", "fee_key", "line_category", "line_amount")
        .agg(F.sum("adjusted").alias("adjusted"), F.count(F.lit(1)).alias("facts"))
        .select("t.*", "fee_key", "line_category", "line_amount", "adjusted", "facts")
    )
    fee_kinds = f.reconcile_fee.select("ReconcileFeeId", F.col("FeeCategoryId").alias("kind_category"))
    names = f.fee_category.select("FeeCategoryId", F.col("Name").alias("category_name"))
    is_line = F.col("kind") == LINE
    stores = ["CoreId", "CoreTypeId", "LocationName", "ClubState", "ExternalStoreID", "CollectionsBy"]
    name = F.when(is_line, F.col("category_name")).otherwise(F.rtrim("category_name"))
    reduced = (
        facts.join(log, on)
        .join(fee_kinds, F.col("fee_key") == F.col("ReconcileFeeId"))
        .withColumn("category_key", F.when(is_line, F.col("line_category")).otherwise(F.col("kind_category")))
        .join(names, F.col("category_key") == F.col("FeeCategoryId"), "left")
        .join(_named_stores(f, params), F.col("CoreId") == F.col("store_key"))
        .groupBy(*stores, "kind", name.alias("category_name"), "line_amount")
        .agg(F.sum(F.col("facts") * F.col("log_rows")).alias("lines"), F.sum(F.col("adjusted") * F.col("log_rows")).alias("adjusted"))
    )
    alike = ["kind", "category_name", "CoreId", "CoreTypeId", "LocationName", "line_amount"]
    total = F.sum("adjusted").over(Window.partitionBy(*alike))
    times = F.when(is_line, F.col("lines")).otherwise(F.lit(1)).cast("int")
    value = fixed_point(F.when(is_line, F.col("line_amount")).otherwise(F.col("total")))
    parts = reduced.withColumn("total", total)
    if not added_up:
        parts = parts.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return parts.select(
        "CoreId",
        "CoreTypeId",
        _location("CoreId").alias("Location"),
        "ClubState",
        F.when(is_line, F.col("category_name")).otherwise(F.concat(F.trim("category_name"), F.lit("adj"))).alias("Category"),
        (value * times if added_up else value).alias("Amount"),
        F.col("ExternalStoreID").alias("ExternalStoreId"),
        "CollectionsBy",
    )


def fee_lines(f: Franchise, params: FranchiseParams) -> DataFrame:
    """Fee lines outside the corporate category, labelled by the name of their category."""
    return _fee_parts(f, params, [LINE])


def fee_adjustments(f: Franchise, params: FranchiseParams) -> DataFrame:
    """Adjustments to fees, added up per category, store and location; distinct rows, label suffix `adj`."""
    return _fee_parts(f, params, [ADJUSTMENT])


def staging(f: Franchise, params: FranchiseParams, added_up: bool = False) -> DataFrame:
    """All four parts in one long table; if a reader only adds amounts up per store and category, with fewer rows that have
    the same sums."""
    fees = _fee_parts(f, params, [LINE, ADJUSTMENT], added_up)
    parts = category_skeleton(f, params), settlement_long(f, params, added_up), fees
    return reduce(DataFrame.unionByName, parts)


def one_spelling(category: Column, categories: Sequence[str]) -> Column:
    """Category names that differ only in case or trailing blanks take the spelling of the list."""
    spellings = F.create_map(*[F.lit(x) for c in categories for x in (c.rstrip(" ").lower(), c)])
    return F.coalesce(F.try_element_at(spellings, F.lower(F.rtrim(category))), F.rtrim(category))


def listed(category: Column, categories: Sequence[str]) -> Column:
    """True; a run fails on a category that is not in the list, whose amounts the pivot would drop."""
    known = category.isNull() | category.isin(list(categories))
    return F.assert_true(known, F.concat(F.lit("category without a column: "), category)).isNull()


def known_categories(f: Franchise) -> list[str]:
    """The fixed categories plus those named in the fee-category enumeration, without doubles in another spelling."""
    names = distinct_labels(f.fee_category.select(F.rtrim("Name").alias("Name")), "Name")
    found = {c.lower(): c for c in reversed((*CATEGORIES, *sorted(names), *sorted(n + "adj" for n in names)))}
    return sorted(found.values())


def fee_minimums(
    reconcile_fee: DataFrame, as_of: dt.datetime, patterns: Mapping[str, str] = FEE_MINIMUMS
) -> DataFrame:
    """Per store: sum of the fee minimums in force, one column per fee-name pattern."""
    name = F.col("FeeName")
    wanted = filters.all_of(
        [F.col("StartUtc") <= dates.moment(as_of), F.col("CoreTypeId") == STORE_TYPE]
    )
    return (
        reconcile_fee.filter(wanted & text.any_like(name, list(patterns.values())))
        .groupBy(F.col("CoreId").alias("minimum_store"))
        .agg(*[sum_when(name.ilike(p), F.col("FeeMin")).alias(column) for column, p in patterns.items()])
    )


def with_fee_minimums(
    stores: DataFrame,
    reconcile_fee: DataFrame,
    as_of: dt.datetime,
    patterns: Mapping[str, str] = FEE_MINIMUMS,
    store_column: str = "StoreId",
) -> DataFrame:
    minimums = fee_minimums(reconcile_fee, as_of, patterns)
    joined = stores.join(minimums, F.col(store_column) == F.col("minimum_store"), "left").drop("minimum_store")
    return joined.withColumns({c: zero_if_null(F.col(c)) for c in patterns})


def month_earlier(day: dt.date) -> dt.date:
    """The same day a month earlier, or the last day of a shorter month."""
    last_of_previous = day.replace(day=1) - dt.timedelta(days=1)
    return last_of_previous.replace(day=min(day.day, last_of_previous.day))


def franchise_fee_report(
    f: Franchise,
    params: FranchiseParams,
    report_date: dt.date,
    as_of: dt.datetime,
    categories: Sequence[str] | None = None,
    minimums: Mapping[str, str] = FEE_MINIMUMS,
) -> DataFrame:
    """One row per store with a column per category, two accrual balances and the fee minimums in force at `as_of`.

    `PastAccrualBalance` is cut off at the report date and `CurrentAccrualBalance` a month earlier, as in the source,
    though the names suggest the reverse. Stores missing from the store detail are left out, and a store with several
    clubs counts its amounts once per club. Categories default to the fixed ones and the fee-category enumeration;
    a staged category that is not among them is an error, so no amount is lost.
    """
    categories = known_categories(f) if categories is None else categories
    ids = ["CoreId", "CoreTypeId", "Location", "ExternalStoreId", "CollectionsBy", "ClubState"]
    long = (
        staging(f, params, added_up=True)
        .withColumn("Category", one_spelling(F.col("Category"), categories))
        .groupBy(*ids, "Category")
        .agg(F.sum(zero_if_null(F.col("Amount"))).alias("Amount"))
        .filter(listed(F.col("Category"), categories))
    )
    detail = f.store_detail.select(F.col("StoreId").alias("detail_store"), "ChainName", "ChainId")
    clubs = f.cas_clubs.select(F.col("StoreID").alias("club_store"))
    widened = long.join(detail, F.col("CoreId") == F.col("detail_store")).join(
        clubs, F.col("CoreId") == F.col("club_store"), "left"
    )
    wide = pivot_sums(widened, [*ids, "ChainName", "ChainId"], "Category", "Amount", categories)
    zeroed = [c for c in ZEROED if c in categories]
    cutoffs = {"PastAccrual": report_date, "CurrentAccrual": month_earlier(report_date)}
    lines = accrued(f.remit_adjustments, f.cas_reconcile, cutoffs)
    report = (
        wide.fillna(0, subset=zeroed)
        .join(lines, F.col("CoreId") == F.col("accrual_store"), "left")
        .select(
            "Location",
            F.col("CoreId").alias("StoreId"),
            "ExternalStoreId",
            "CollectionsBy",
            "ChainName",
            "ChainId",
            "ClubState",
            *[F.col(c).cast("decimal(38,2)").alias(c) for c in categories],
            fixed_point(zero_if_null(-F.col("CurrentAccrual"))).alias("CurrentAccrualBalance"),
            fixed_point(zero_if_null(-F.col("PastAccrual"))).alias("PastAccrualBalance"),
        )
    )
    return with_fee_minimums(report, f.reconcile_fee, as_of, minimums)
