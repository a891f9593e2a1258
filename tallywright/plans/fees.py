"""Rule-based fee classification and fee-profile flattening."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallywright.operators.hierarchy import entity_hierarchy
from tallywright.operators.joins import preserve_rows
from tallywright.operators.reshape import labelled_sums


@dataclass(frozen=True)
class Condition:
    """One condition of a rule: `is`, `is not`, `has` or `has not` any of the values."""

    column: str
    op: str
    values: tuple[str, ...]

    def sql(self, case_sensitive: bool) -> str:
        """The condition as a SQL predicate; without case the column is expected in lower case already."""
        values = [v if case_sensitive else v.lower() for v in self.values]
        quoted = ["'" + v.replace("'", "''") + "'" for v in values]
        if self.op in ("is", "is not"):
            test = f"{self.column} in ({', '.join(quoted)})"
        else:
            test = " or ".join(f"contains({self.column}, {q})" for q in quoted)
        return f"not ({test})" if self.op.endswith("not") else f"({test})"


@dataclass(frozen=True)
class FeeRule:
    label: str
    measure: str
    tests: tuple[Condition, ...]


def _is(column: str, *values: str) -> Condition:
    return Condition(column, "is", values)


def _not(column: str, *values: str) -> Condition:
    return Condition(column, "is not", values)


def _has(column: str, value: str) -> Condition:
    return Condition(column, "has", (value,))


def _has_not(column: str, value: str) -> Condition:
    return Condition(column, "has not", (value,))


PAYMENT, KIND, CATEGORY, SUB = "Payment_Type", "Fee_Category_Type", "Fee_Category", "Fee_Sub_Category"
TEXT, GROUP = "Description", "reporting_group"
FEES, COUNT, VOLUME = "Total_Fees", "Txn_Count", "Txn_Amount"

_known = _not(PAYMENT, "Not Applicable")
_gateway, _network = _is(KIND, "Vantiv Fees"), _not(KIND, "Vantiv Fees")
_amex, _echeck = "American Express", "Electronic Check"
_bank_cards = _not(PAYMENT, _echeck, _amex)
_no_updater = _not(CATEGORY, "Revenue Solutions")
_assessment = _is(CATEGORY, "Assessments")
_no_extras = _not(CATEGORY, "Assessments", "Authorizations")
_chargeback = "Chargebacks/Returns"
_debit, _credit = _has(TEXT, "DEBIT"), _has_not(TEXT, "DEBIT")
_regulated, _unregulated = _has(TEXT, "Regulated"), _has_not(TEXT, "Regulated")

_card_network = (_known, _network, _no_updater, _bank_cards, _credit)
_amex_gateway = (_known, _gateway, _no_updater, _is(PAYMENT, _amex))
_echeck_gateway = (_gateway, _is(PAYMENT, _echeck), _is(CATEGORY, "Payments Acceptance"))
_regulated_debit = (_known, _network, _debit, _regulated, _no_extras)
_unregulated_debit = (_known, _network, _debit, _unregulated, _no_extras)


def processing_rules(reporting_group: str = "REPORTING_GROUP_X") -> tuple[FeeRule, ...]:
    """The 24 fee categories. They overlap: a fee line counts in every category it meets.

    The labels are fixed values. Category 33 has no reporting-group test although category 16 has one.
    """
    in_group = _is(GROUP, reporting_group)
    no_debit_category = _has_not(CATEGORY, "DEBIT")
    return (
        FeeRule("03_WP - Credit Card (Visa,MC,Dis)-Total Network Costs", FEES, (*_card_network, _not(CATEGORY, "Assessments"))),
        FeeRule("04_Intermediate - CC and Debit Gateway Fees", FEES, (_known, _gateway, _not(SUB, _chargeback), _no_updater, _bank_cards)),
        FeeRule("06_WP - Credit Card (Visa,MC,Dis)-Assesments", FEES, (*_card_network, _assessment)),
        FeeRule("08_WP - Credit Cards (AMEX) - Total Network Costs", FEES, (_is(PAYMENT, _amex), _network, _no_extras)),
        FeeRule("American Express OptBlue Assesment", FEES, (_has(TEXT, "INT AMEX OptBlue"),)),
        FeeRule("09_WP - Credit Cards (AMEX) - Total Gateway Costs", FEES, (*_amex_gateway, _not(SUB, _chargeback))),
        FeeRule("10_WP - Credit Cards (AMEX) - Brand Assesments", FEES, (_is(PAYMENT, _amex), _network, _assessment)),
        FeeRule("16_WP - Regulated DEBIT Cards - Total Interchange Costs", FEES, (in_group, *_regulated_debit)),
        FeeRule("20_WP - UnRegulated DEBIT Cards - Total Interchange Costs", FEES, (in_group, *_unregulated_debit)),
        FeeRule("13_WP - Combined DEBIT Cards Assesments", FEES, (_known, _network, _debit, _unregulated, _assessment)),
        FeeRule("14_WP - Combined DEBIT Cards Authorizations", FEES, (_known, _network, _debit, _unregulated, _is(CATEGORY, "Authorizations"))),
        FeeRule("24_WP - eCheck - Total Gateway Costs", FEES, _echeck_gateway),
        FeeRule("26_WP - Account Updater Costs", FEES, (_known, no_debit_category, _gateway, _is(CATEGORY, "Revenue Solutions"))),
        FeeRule("27_WP - Chargeback Costs", FEES, (_known, no_debit_category, _gateway, _is(SUB, _chargeback))),
        FeeRule("30_WP - Credit Card Counts (Visa,MC,Dis)", COUNT, (*_card_network, _not(CATEGORY, "Assessments", "Credit Interchange"), _has_not(TEXT, "AVS"))),
        FeeRule("31_WP - Credit Card Counts (AMEX)", COUNT, _amex_gateway),
        FeeRule("32_WP - UnRegulated Debit Card Counts", COUNT, (in_group, *_unregulated_debit)),
        FeeRule("33_WP - Regulated Debit Card Counts", COUNT, _regulated_debit),
        FeeRule("37_WP - Credit Card $$$ (AMEX)", VOLUME, _amex_gateway),
        FeeRule("39_WP - Regulated Debit Card", VOLUME, _regulated_debit),
        FeeRule("40_WP - eCheck", VOLUME, _echeck_gateway),
        FeeRule("34_WP - eCheck Counts", COUNT, _echeck_gateway),
        FeeRule("36_WP - Credit Card (Visa,MC,Dis)", VOLUME, (*_card_network, _is(CATEGORY, "Credit Interchange"))),
        FeeRule("38_WP - UnRegulated Debit Card", VOLUME, _unregulated_debit),
    )


def merchant_processing_view(
    fee_lines: DataFrame, rules: Sequence[FeeRule] | None = None, case_sensitive: bool = False
) -> DataFrame:
    """Amount per month, club, kind of store and fee category, from one pass over the fee lines.

    Text is compared without case and trailing blanks by default, as the source server does; `Regulated` then also
    matches `Unregulated`. Measures are text in the source and are read as decimals and whole numbers.
    """
    rules = processing_rules() if rules is None else rules
    keys = ["Month", "CLUB", "isXPO"]
    looked_at = sorted({c.column for rule in rules for c in rule.tests})
    lines = fee_lines.select(
        *keys,
        *[(F.col(c) if case_sensitive else F.lower(F.rtrim(F.col(c)))).alias(c) for c in looked_at],
        FEES,
        COUNT,
        VOLUME,
    )
    labelled = [(r.label, F.expr(" and ".join(c.sql(case_sensitive) for c in r.tests)), r.measure) for r in rules]
    measures = {
        FEES: F.col(FEES).cast("decimal(18,2)"),
        COUNT: F.col(COUNT).cast("int"),
        VOLUME: F.col(VOLUME).cast("decimal(18,2)"),
    }
    return labelled_sums(lines, keys, labelled, measures, label="Value", amount="Amount", amount_type="decimal(28,2)")


NETWORKS = {"AMEX": "American Express", "Visa": "Visa", "MasterCard": "MasterCard", "Discover": "Discover"}

_ACH = ("buyerPct", "merchantPct", "buyerFixedFee", "debitReturnFee", "creditReturnFee", "merchantFixedFee")
_CARD = ("buyerPct", "merchantPct", "buyerFixedFee", "merchantFixedFee")
_NETWORK = ("buyerPct", "merchantPct", "buyerFixedFee", "merchantFixedFee", "interChangePlus")


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CONFIGURATION = T.StructType(
    [
        T.StructField("defaultAchFees", _texts(_ACH)),
        T.StructField("defaultCardFees", _texts(_CARD)),
        T.StructField("disputeFixedFee", T.StringType()),
        T.StructField("disputeInquiryFixedFee", T.StringType()),
        T.StructField("defaultInterChangePlus", T.StringType()),
        T.StructField("networkSpecificFees", T.MapType(T.StringType(), _texts(_NETWORK))),
    ]
)


def _amount(value: Column) -> Column:
    """Text to decimal(10,2); unreadable text is null."""
    return value.try_cast("decimal(10,2)")


def _share(value: Column) -> Column:
    return (_amount(value) / 100).cast("decimal(14,6)")


def _fee_column(value: Column, field: str) -> Column:
    if field == "interChangePlus":
        return value
    return _share(value) if field.endswith("Pct") else _amount(value)


def flatten_configuration(fee_profile: DataFrame) -> DataFrame:
    """One row per fee profile with its JSON configuration in columns; the text is parsed once per profile.

    Percentages are divided by 100, fixed fees are not. The list of networks is null for an empty object, and empty
    text when no network names a buyer percentage.
    """
    cfg = F.from_json("configuration", CONFIGURATION).alias("cfg")
    parsed = fee_profile.select("id", "start_date", "end_date", cfg)
    networks = F.col("cfg.networkSpecificFees")

    def network_field(network: str, field: str) -> Column:
        return F.try_element_at(networks, F.lit(network)).getField(field)

    present = [F.when(network_field(n, "buyerPct").isNotNull(), F.lit(n)) for n in NETWORKS.values()]
    names = F.when(F.size(networks) == 0, F.lit(None)).otherwise(F.concat_ws(", ", *present))
    ach = {"buyerPct": "buyerPCT"}
    return parsed.select(
        F.col("id").alias("fee_profile_id"),
        F.col("start_date").alias("FROM"),
        F.col("end_date").alias("TO"),
        *[_fee_column(F.col(f"cfg.defaultAchFees.{f}"), f).alias(ach.get(f, f)) for f in _ACH],
        *[_fee_column(F.col(f"cfg.defaultCardFees.{f}"), f).alias(f"{f}_card") for f in _CARD],
        _amount(F.col("cfg.disputeFixedFee")).alias("disputeFixedFee"),
        names.alias("networkSpecificFeesName"),
        *[
            _fee_column(network_field(network, f), f).alias(f"{short}_{f}")
            for short, network in NETWORKS.items()
            for f in _NETWORK
        ],
        F.col("cfg.defaultInterChangePlus").alias("defaultInterChangePlus"),
        _amount(F.col("cfg.disputeInquiryFixedFee")).alias("disputeInquiryFixedFee"),
    )


def fee_profiles(
    entity: DataFrame, merchant_fee_profile: DataFrame, merchant: DataFrame, fee_profile: DataFrame
) -> DataFrame:
    """Every merchant with its place in the tree, its processor id and the fee profile it is on, flattened."""
    flat = flatten_configuration(fee_profile)
    on_profile = (
        merchant_fee_profile.select(
            F.col("merchant_id").alias("merchant_entity_id"), F.col("fee_profile_id").alias("on_profile"), "is_active"
        )
        .join(flat, F.col("on_profile") == F.col("fee_profile_id"), "left")
        .drop("on_profile")
    )
    ids = merchant.select(F.col("id").alias("mid_merchant"), "mid")
    rest = [c for c in flat.columns if c not in ("fee_profile_id", "FROM", "TO")]
    # without a profile the list of networks is empty, as the source joins texts that are all missing
    names = F.when(F.col("fee_profile_id").isNull(), F.lit("")).otherwise(F.col("networkSpecificFeesName"))
    tree = entity_hierarchy(entity)
    merchants = tree.join(ids, F.col("merchant_entity_id") == F.col("mid_merchant"), "left")
    known = merchant_fee_profile.select(F.col("merchant_id").alias("merchant_entity_id"))
    return (
        preserve_rows(merchants, on_profile, known, "merchant_entity_id")
        .withColumn("networkSpecificFeesName", names)
        .select("fee_profile_id", *tree.columns, "mid", "is_active", "FROM", "TO", *rest)
    )
