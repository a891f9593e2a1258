"""Store dimension, accrual balances and transactions per store and period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import dates, filters, text
from tallywright.functions.money import money_text, zero_if_null
from tallywright.operators.numbering import number_rows

# Statuses of stores that are reported, the site type that never is, and state spellings.
REPORTED_STATUSES = (1, 2, 3, 7, 13, 14, 15)
HIDDEN_SITE_TYPE = 4
STATE_CODES = {"Kentucky": "KY", "Massachusetts": "MA", "Texas": "TX", "Fl": "FL"}


@dataclass(frozen=True)
class BrandRule:
    """A brand told by the store's name, or by the chain's name where a chain pattern is given."""

    location_like: str
    brand_id: int
    brand_name: str
    chain_like: str | None = None


@dataclass(frozen=True)
class RebateRule:
    location_like: str
    country: str
    chain_id: int


# The brand and rebate rules that are visible in the source; ids are numbered, since it blanks them out.
BRAND_RULES = (
    BrandRule("BRAND_D%", 1, "BRAND_D"),
    BrandRule("BRAND_R%", 2, "BRAND_S", chain_like="BRAND_S%"),
    BrandRule("BRAND_F%", 3, "BRAND_F"),
    BrandRule("BRAND_G%", 4, "BRAND_G"),
    BrandRule("BRAND_T%", 5, "BRAND_T"),
    BrandRule("BRAND_U%", 6, "BRAND_U"),
    BrandRule("BRAND_V%", 7, "BRAND_V"),
    BrandRule("BRAND_W%", 8, "BRAND_W"),
    BrandRule("BRAND_Q%", 9, "BRAND_Q"),
    BrandRule("BRAND_A%", 10, "BRAND_A"),
    BrandRule("BRAND_B%", 11, "BRAND_B"),
    BrandRule("BRAND_Y%", 12, "BRAND_Y"),
    BrandRule("BRAND_H%", 13, "BRAND_H"),
    BrandRule("BRAND_J%", 14, "BRAND_J"),
    BrandRule("BRAND_P%", 15, "BRAND_P"),
)
REMIT_BRAND_RULES = tuple(r for r in BRAND_RULES if r.brand_name in ("BRAND_D", "BRAND_S", "BRAND_P"))
REBATE_RULES = (
    RebateRule("BRAND_A%", "US", 1),
    RebateRule("BRAND_B%", "US", 2),
    RebateRule("BRAND_C%", "US", 3),
    RebateRule("BRAND_P%", "US", 21),
    RebateRule("BRAND_P%", "CA", 22),
    RebateRule("BRAND_Q%", "CA", 23),
)
NO_BRAND = "No Brand Assigned"

ALL_GROUPS = "all"
ANY_COMPANY = "any company"


@dataclass(frozen=True)
class BackOffice:
    """Tables of the franchise back office."""

    stores: DataFrame
    general_prefs: DataFrame
    store_status: DataFrame
    chains: DataFrame
    cas_clubs: DataFrame
    cas_companies: DataFrame
    store_info: DataFrame
    site_type: DataFrame
    remit_adjustments: DataFrame
    cas_reconcile: DataFrame
    payments: DataFrame


@dataclass(frozen=True)
class StoreParams:
    """Filters of the store dimension; None means no filter, except that statuses fall back to the reported ones. Lists of
    ids may be given as text, separated by commas."""

    remit_groups: Sequence[int] | str | None = None
    default_group: int = -1
    special_groups: Sequence[int] = (-1, -2, -3, -4)
    brand_ids: Sequence[int] | str | None = None
    no_brand_id: int = -1
    special_brand_ids: Sequence[int] = (-1, -2, -3, -4)
    skipped_chain_ids: Sequence[int] = ()
    chain_id: int | None = None
    store_id: int | None = None
    statuses: Sequence[int] | None = None
    only_remit_clubs: bool = False
    region_mode: int | None = None
    club_states: Sequence[str] | None = None
    site_types: Sequence[int] | None = None
    mixed_chain_id: int | None = None
    brand_rules: Sequence[BrandRule] = BRAND_RULES
    remit_brand_rules: Sequence[BrandRule] = REMIT_BRAND_RULES
    rebate_rules: Sequence[RebateRule] = REBATE_RULES
    state_codes: Mapping[str, str] = field(default_factory=lambda: dict(STATE_CODES))

    def __post_init__(self) -> None:
        for name in ("remit_groups", "brand_ids", "skipped_chain_ids", "statuses", "site_types"):
            value = getattr(self, name)
            if value not in (ALL_GROUPS, ANY_COMPANY):
                object.__setattr__(self, name, text.number_list(value))


def _brand_case(rules: Sequence[BrandRule], value: str, location: Column, chain: Column, otherwise: Column) -> Column:
    result = None
    for rule in rules:
        test = location.ilike(rule.location_like)
        if rule.chain_like is not None:
            test = test | chain.ilike(rule.chain_like)
        found = F.lit(getattr(rule, value))
        result = F.when(test, found) if result is None else result.when(test, found)
    return otherwise if result is None else result.otherwise(otherwise)


def _rebate_chain(params: StoreParams) -> Column:
    """The store's chain; stores without one (or in the mixed chain) get it from name and country."""
    chain = F.col("ChainID")
    ruled = F.lit(None).cast("int")
    for rule in reversed(params.rebate_rules):
        test = F.col("LocationName").ilike(rule.location_like) & filters.same_text(
            F.col("clubcountry"), [rule.country]
        )
        ruled = F.when(test, F.lit(rule.chain_id)).otherwise(ruled)
    needs_rule = chain.isNull()
    if params.mixed_chain_id is not None:
        needs_rule = needs_rule | (chain == params.mixed_chain_id)
    return F.when(needs_rule, ruled).otherwise(chain)


def _joined_stores(b: BackOffice) -> DataFrame:
    """Stores with the seven lookups attached; every lookup has one row per key or is repeated as stored."""

    def lookup(df: DataFrame, key: str, *columns: Column | str) -> DataFrame:
        return df.select(F.col(key).alias("_key"), *columns)

    joined = b.stores
    for df, key, columns in (
        (b.general_prefs, "StoreID", ("LocationName", "clubcountry", "ClubState", "ClubAddress", "ClubCity", "ClubZip", "TimeOffset")),
        (b.cas_clubs, "StoreID", ("CasClubId", "CasCompanyID", "IsRemitClubEnabled")),
        (b.store_info, "StoreId", ("SiteTypeId",)),
    ):
        side = lookup(df, key, *columns)
        joined = joined.join(side, joined["StoreID"] == side["_key"], "left").drop("_key")
    for df, key, on, columns in (
        (b.store_status, "StoreStatusId", "Status", [F.col("Name").alias("StatusName")]),
        (b.chains, "ChainID", "ChainID", ["ChainName"]),
        (b.cas_companies, "CASCompanyID", "CasCompanyID", [F.col("CASCompanyID").alias("CompanyId"), "CompanyName", "IsRemitGroupEnabled"]),
        (b.site_type, "SiteTypeId", "SiteTypeId", [F.col("Name").alias("SiteTypeName")]),
    ):
        side = lookup(df, key, *columns)
        joined = joined.join(side, joined[on] == side["_key"], "left").drop("_key")
    return joined


def _dimension(joined: DataFrame, params: StoreParams, chain: Column, chain_name: Column, brand: Column, no_site: str):
    location = F.col("LocationName")
    suffix = F.when(F.col("Deleted") == 1, F.lit(" (Deleted)")).otherwise(F.lit(""))
    return joined.select(
        chain.alias("ChainId"),
        _rebate_chain(params).alias("ChainIdRebates"),
        chain_name.alias("ChainName"),
        brand.alias("BrandName"),
        F.col("StoreID").alias("StoreId"),
        F.concat(location, suffix).alias("LocationName"),
        F.col("clubcountry").alias("ClubCountry"),
        "ClubState",
        "Status",
        F.col("StatusName").alias("StoreStatus"),
        F.coalesce("SiteTypeName", F.lit(no_site)).alias("SiteType"),
        "TimeOffset",
        F.coalesce("CompanyName", F.lit("DIY")).alias("RemitGroup"),
        F.col("CompanyId").alias("CasCompanyId"),
        "IsRemitGroupEnabled",
        "IsRemitClubEnabled",
        "CollectionsBy",
        "Deleted",
        "SiteTypeId",
        F.when(F.col("CasClubId").isNotNull(), F.lit("FS")).otherwise(F.lit("DIY")).alias("BillingType"),
        text.address_line(F.col("ClubAddress"), F.col("ClubCity"), F.col("ClubState"), F.col("ClubZip")).alias("Address"),
        text.trimmed(text.mapped(F.col("ClubState"), params.state_codes)).alias("State"),
    )


def remit_group_list(companies: DataFrame, special: Mapping[int, float]) -> DataFrame:
    """Every remit group with its place in the list: special groups by their given place, companies by name."""
    numbered = number_rows(companies.select("CASCompanyID", "CompanyName"), ["CompanyName", "CASCompanyID"], name="place")
    rows = numbered.select(F.col("CASCompanyID").alias("CASCompanyId"), F.col("place").cast("decimal(17,2)").alias("OrderBy"))
    if not special:
        return rows
    fixed = companies.sparkSession.createDataFrame(list(special.items()), "CASCompanyId int, place double")
    return rows.union(fixed.select("CASCompanyId", F.col("place").cast("decimal(17,2)")))


def _remit_filter(params: StoreParams) -> Column | None:
    groups = params.remit_groups
    if groups is None or params.store_id is not None or params.chain_id is not None:
        return None
    if groups == ANY_COMPANY:
        return F.col("CasCompanyID").isNotNull()
    if groups == ALL_GROUPS:
        # every company is in the list of all groups, so only stores without one depend on the special groups
        return F.col("CompanyId").isNotNull() | F.lit(params.default_group in params.special_groups)
    return F.coalesce("CompanyId", F.lit(params.default_group)).isin(list(groups))


def stores_by_remit_group(b: BackOffice, params: StoreParams = StoreParams()) -> DataFrame:
    """Store dimension chosen by remit group, chain, store, status, club, region, state and site type."""
    tests = [
        _remit_filter(params),
        filters.equals_if_set(F.col("ChainID"), params.chain_id),
        filters.equals_if_set(F.col("StoreID"), params.store_id),
        F.col("Status").isin(list(params.statuses or REPORTED_STATUSES)),
        F.col("IsRemitClubEnabled") == 1 if params.only_remit_clubs else None,
        filters.region_mode(F.col("clubcountry"), F.col("ClubState"), params.region_mode),
        None if params.club_states is None else filters.same_text(F.col("ClubState"), params.club_states),
        filters.in_if_set(F.coalesce("SiteTypeId", F.lit(0)), params.site_types),
    ]
    joined = _joined_stores(b).filter(filters.all_of(tests))
    chain_name = F.col("ChainName")
    or_chain = F.coalesce(chain_name, F.lit(NO_BRAND))
    brand = _brand_case(params.remit_brand_rules, "brand_name", F.col("LocationName"), chain_name, or_chain)
    return _dimension(joined, params, F.col("ChainID"), F.col("ChainName"), brand, no_site="-")


def brand_list(b: BackOffice, params: StoreParams) -> DataFrame:
    """Brand ids of the chains in use: test, demo, deleted and skipped chains are left out."""
    name = F.col("ChainName")
    used = b.chains.filter(
        F.col("Deleted").isNull()
        & (F.rtrim(name) != "")
        & ~name.ilike("%test%")
        & ~name.ilike("%demo%")
        & ~name.ilike("%delete%")
    )
    if params.skipped_chain_ids:
        used = used.filter(~F.col("ChainID").isin(list(params.skipped_chain_ids)))
    rules = [BrandRule(r.chain_like or r.location_like, r.brand_id, r.brand_name, r.location_like) for r in params.brand_rules]
    brand = _brand_case(rules, "brand_id", name, name, F.col("ChainID"))
    return used.select(brand.cast("int").alias("BrandId")).distinct()


def stores_by_brand(b: BackOffice, params: StoreParams) -> DataFrame:
    """Store dimension chosen by brand id; the brand overrides chain id and chain name."""
    location, chain_name = F.col("LocationName"), F.col("ChainName")
    brand_id = _brand_case(params.brand_rules, "brand_id", location, chain_name, F.col("ChainID"))
    name = _brand_case(params.brand_rules, "brand_name", location, chain_name, F.coalesce(chain_name, F.lit(NO_BRAND)))
    tests = [
        filters.region_mode(F.col("clubcountry"), F.col("ClubState"), params.region_mode),
        None if params.club_states is None else filters.same_text(F.col("ClubState"), params.club_states),
        F.col("Status").isin(list(REPORTED_STATUSES)),
    ]
    joined = _joined_stores(b).filter(filters.all_of(tests))
    wanted = F.coalesce(brand_id, F.lit(params.no_brand_id)).cast("int")
    if params.brand_ids == ALL_GROUPS:
        marked = joined.withColumn("_brand", wanted)
        known = brand_list(b, params).select(F.col("BrandId").alias("_known"))
        in_chain = marked.join(known, F.col("_brand") == F.col("_known"), "left")
        special = F.col("_brand").isin(list(params.special_brand_ids))
        joined = in_chain.filter(F.col("_known").isNotNull() | special).drop("_brand", "_known")
    else:
        joined = joined.filter(wanted.isin(list(params.brand_ids or ())))
    return _dimension(joined, params, brand_id, name, name, no_site="No Site Type")


def accrued(remit_adjustments: DataFrame, cas_reconcile: DataFrame, cutoffs: Mapping[str, dt.date]) -> DataFrame:
    """Per store: accrued adjustments reconciled before each cutoff, one column per cutoff, in one pass.

    Adjustments are added up per store and reconciliation before the join. A store without any adjustment before a
    cutoff has null there.
    """
    lines = (
        remit_adjustments.filter(
            ((F.col("Accrual") == 1) | (F.col("RemitAdjustmentTypeId") == 4)) & F.col("ReconcileId").isNotNull()
        )
        .groupBy(F.col("StoreId").alias("accrual_store"), F.col("ReconcileId").alias("accrual_reconcile"))
        .agg(F.sum("Amount").alias("accrued"))
    )
    latest = max(cutoffs.values())
    reconciled = cas_reconcile.filter(F.col("Cutoff") < F.lit(latest)).select("CasReconcileId", "Cutoff")
    return (
        lines.join(reconciled, F.col("accrual_reconcile") == F.col("CasReconcileId"))
        .groupBy("accrual_store")
        .agg(
            *[
                F.sum(F.when(F.col("Cutoff") < F.lit(day), F.col("accrued"))).alias(name)
                for name, day in cutoffs.items()
            ]
        )
    )


def with_accrual_balance(
    stores: DataFrame,
    remit_adjustments: DataFrame,
    cas_reconcile: DataFrame,
    cutoff: dt.date,
    only_positive: bool = False,
) -> DataFrame:
    """Drop the hidden site type (unknown types stay) and add each store's accrual balance."""
    visible = filters.delete_where(stores, F.col("SiteTypeId") == HIDDEN_SITE_TYPE)
    balances = accrued(remit_adjustments, cas_reconcile, {"AccrualBalance": cutoff})
    result = (
        visible.join(balances, F.col("StoreId") == F.col("accrual_store"), "left")
        .drop("accrual_store")
        .withColumn("AccrualBalance", zero_if_null(F.col("AccrualBalance")).cast("decimal(17,2)"))
    )
    return filters.delete_where(result, F.col("AccrualBalance") <= 0) if only_positive else result


def accrual_cutoff(mode: int | None, today: dt.date, end: dt.date) -> tuple[dt.date, bool]:
    """Cutoff day and whether only positive balances are kept: mode 2 looks at the day after the report's end."""
    return (end + dt.timedelta(days=1) if mode == 2 else today), mode in (1, 2)


def management_financials(
    dimension: DataFrame,
    remit_adjustments: DataFrame,
    cas_reconcile: DataFrame,
    payments: DataFrame,
    today: dt.date,
    start: dt.date,
    end: dt.date,
    period: int,
    columns: str = "all",
    accrual_mode: int | None = None,
) -> DataFrame:
    """The chain of the management report: store dimension, without the hidden site type and, by accrual mode, without
    stores of non-positive balance, then the transactions of the stores that are left."""
    cutoff, only_positive = accrual_cutoff(accrual_mode, today, end)
    kept = with_accrual_balance(dimension, remit_adjustments, cas_reconcile, cutoff, only_positive)
    return store_period_transactions(payments, kept, start, end, period, columns)


def checked_offset(hours: Column) -> Column:
    """Hours of a store's offset; a run fails on two days or more, for which the payments read would not do, and on parts of
    an hour, for which sums per clock hour would not do."""
    wrong = F.raise_error(F.concat(F.lit("offset of two days or more, or of parts of an hour: "), hours.cast("string"))).cast("int")
    return F.when((F.abs(hours) >= 48) | (hours != F.floor(hours)), wrong).otherwise(hours.cast("int"))


def store_period_transactions(
    payments: DataFrame,
    stores: DataFrame,
    start: dt.date,
    end: dt.date,
    period: int,
    columns: str = "all",
) -> DataFrame:
    """Amount and count per store, period of the store-local time and tender, for whole local days start to end.

    Offsets are whole hours, less than two days (checked), and the range is whole days, so payments are added up per
    store, tender and clock hour before the store's offset is looked up; a store with very many payments is small by then.
    """
    wide_start, wide_end = start - dt.timedelta(days=2), end + dt.timedelta(days=3)
    hourly = (
        payments.filter(
            filters.tender_switch(F.col("PurchaseWith"), columns)
            & (F.col("PaymentDate") >= F.lit(wide_start))
            & (F.col("PaymentDate") < F.lit(wide_end))
        )
        .groupBy(
            F.col("StoreID").alias("paid_store"),
            F.date_trunc("hour", F.col("PaymentDate")).cast("timestamp_ntz").alias("paid_hour"),
            F.when(F.col("PurchaseWith") == 1, F.lit("CC Txn"))
            .when(F.col("PurchaseWith") == 6, F.lit("eCheck Txn"))
            .otherwise(F.lit("Other Txn"))
            .alias("TransactionCategory"),
        )
        .agg(
            F.sum(money_text(F.coalesce("TotalAmount", "Amount"))).alias("amount"),
            F.count("PaymentID").alias("payments"),
        )
    )
    offsets = stores.select(F.col("StoreId").alias("StoreID"), "TimeOffset")
    local = dates.shifted_hours(F.col("paid_hour"), checked_offset(F.col("TimeOffset")))
    return (
        hourly.join(offsets, F.col("paid_store") == F.col("StoreID"))
        .withColumn("local_time", local)
        .filter(dates.within_days(F.col("local_time"), start, end))
        .groupBy("StoreID", dates.period_label(period, F.col("local_time")).alias("PeriodDisplay"), "TransactionCategory")
        .agg(F.sum("amount").alias("Amount"), F.sum("payments").alias("TransactionCount"))
        .select(
            "StoreID",
            "PeriodDisplay",
            "TransactionCategory",
            F.lit("Transactions").alias("TransactionType"),
            "Amount",
            "TransactionCount",
        )
    )
