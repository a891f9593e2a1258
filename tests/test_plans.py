"""Plan shape: no Python on the data path, no pairing joins, and single passes where they are promised."""

import datetime as dt
import re

import pytest
from pyspark.sql import SparkSession

from tallywright.registry import QUERIES
from tallywright.registry.views import TASKS_PER_SCAN, LogicalTables, _dealt
from tallywright.sources.tables import read_table, table_schema


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def no_broadcast(spark: SparkSession):
    """What the plans are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shape_without_broadcast(no_broadcast, sf_dir, name):
    plan = physical(QUERIES[name](no_broadcast, sf_dir))
    assert not re.search(r"EvalPython|InPandas|InArrow|PythonUDF", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BroadcastHashJoin", plan)


@pytest.mark.parametrize(
    "name, table, scans",
    [
        ("merchant_processing_view", "lineitem", 1),
        ("operating_account", "lineitem", 1),
        ("profitability_daily", "lineitem", 1),
        ("store_accrual_balance", "orders", 0),
        ("agg_count_distinct", "orders", 1),
        ("ff_settlement_wide", "lineitem", 4),  # settlement log as rows and as dated facts, fees, adjustments
        ("franchise_fee_staging", "lineitem", 9),
        ("profitability_daily", "customer", 8),  # the entity tree once
        ("stmt_payout_level", "lineitem", 2),  # transactions and their bridge, once each
        ("fee_profiles", "orders", 0),
    ],
)
def test_tables_are_read_once(spark, sf_dir, name, table, scans):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert len(re.findall(rf"{table}\.parquet", plan)) == scans


def test_distinct_count_needs_no_second_shuffle_of_transactions(no_broadcast, sf_dir):
    plan = physical(QUERIES["agg_count_distinct"](no_broadcast, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning\(bridge_txn_id|Exchange hashpartitioning\(totals_mp_id#\d+, bridge_txn_id", plan)) == 1


def test_a_hot_payout_is_reduced_before_it_is_gathered(no_broadcast, sf_dir):
    """The bridge reaches the payout's key as partial sums; no join or window takes its rows there."""
    plan = physical(QUERIES["agg_fanout_ratio"](no_broadcast, sf_dir))
    assert plan.count("partial_sum") == 1 and "Window" not in plan
    join = plan.index("SortMergeJoin")
    assert plan[join:].count("HashAggregate") >= 4


def test_only_needed_columns_are_scanned(spark, sf_dir):
    plan = physical(QUERIES["semi_join"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s.count(":") <= 2 for s in schemas)


def test_null_rejected_left_joins_become_inner(spark, sf_dir):
    assert "LeftOuter" not in optimized(QUERIES["join_left_null_reject"](spark, sf_dir))


@pytest.mark.parametrize(
    "name", ["win_row_number", "win_row_number_grouped", "batch_number", "insert_append", "statement_batches", "statement_pack"]
)
def test_no_job_while_a_plan_is_built(spark, sf_dir, name):
    QUERIES[name](spark, sf_dir)  # schemas of the files are read the first time
    spark.sparkContext.setJobGroup(f"building {name}", name)
    QUERIES[name](spark, sf_dir)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_payments_are_scanned_once(spark, sf_dir):
    plan = physical(QUERIES["store_quarter_transactions"](spark, sf_dir))
    assert len(re.findall(r"orders\.parquet", plan)) == 1


@pytest.mark.parametrize("name", ["agg_expr_key", "win_row_number_grouped", "sort_rows", "date_expressions", "union_all", "join_composite_left", "join_left"])
def test_transactions_are_dealt_over_tasks_that_follow_the_scan(no_broadcast, sf_dir, name):
    """The stage that sorts and hashes every line is not left to adaptive execution, which would join its tasks together."""
    tables = LogicalTables(no_broadcast, sf_dir)
    assert tables.tasks == TASKS_PER_SCAN * read_table(no_broadcast, sf_dir, "lineitem").rdd.getNumPartitions()
    dealt = re.findall(r"Exchange hashpartitioning\(([lo]_orderkey)#\d+L?, (\d+)\), REPARTITION_BY_NUM", physical(QUERIES[name](no_broadcast, sf_dir)))
    assert set(dealt) == {("l_orderkey", str(tables.tasks)), ("o_orderkey", str(tables.tasks))}


@pytest.mark.parametrize("name", ["agg_count_distinct", "stmt_payout_level", "stmt_summary_level"])
def test_bridge_and_transactions_are_dealt_alike(no_broadcast, sf_dir, name):
    tasks = LogicalTables(no_broadcast, sf_dir).tasks
    plan = physical(QUERIES[name](no_broadcast, sf_dir))
    for key in ("bridge_txn_id", "txn_id"):
        assert len(re.findall(rf"Exchange hashpartitioning\({key}#\d+, {tasks}\), REPARTITION_BY_NUM", plan)) == 1


def test_ledger_lines_are_shuffled_by_merchant_once(no_broadcast, sf_dir):
    """Lines, of which a merchant has few per day, are not added up per merchant and day before they meet the entity tree."""
    plan = physical(QUERIES["operating_account"](no_broadcast, sf_dir))
    by_merchant = re.findall(r"Exchange hashpartitioning\((?:fact_merchant|merchant_entity_id)#\d+, [^)]*", plan)
    assert by_merchant and not [x for x in by_merchant if "#" in x.partition(", ")[2]]


def test_the_report_adds_settlements_up_before_they_are_made_long(spark, sf_dir):
    """A store's measures are columns until they are sums, and its fee lines are not spread into one row each."""
    plan = optimized(QUERIES["franchise_fee_report"](spark, sf_dir))
    assert re.search(r"Expand[^\n]*\n[\s:|+-]*Aggregate", plan) and "explode(sequence(" not in plan
    assert "explode(sequence(" in optimized(QUERIES["franchise_fee_staging"](spark, sf_dir))


def test_ledger_rows_are_put_in_order_with_one_text(spark, sf_dir):
    """Texts that no join or order needs travel as one, and a merchant's ancestors join after the rows were dealt by time."""
    plan = optimized(QUERIES["transaction_ledger"](spark, sf_dir))
    columns = re.search(r"RepartitionByExpression \[created_at[^\n]*\n[^\n]*Union[^\n]*\n[^\n]*Project \[([^\n]*)\]", plan).group(1)
    assert len(columns.split(", ")) <= 14 and not re.search("merchant_name|business_|division_|currency|status", columns)


def test_statement_rows_meet_intents_with_one_text(no_broadcast, sf_dir):
    plan = optimized(QUERIES["stmt_transaction_level"](no_broadcast, sf_dir))
    columns = re.search(r"Join LeftOuter, \(payment_intent_id[^\n]*\n[^\n]*Project \[([^\n]*)\]", plan).group(1)
    assert "texts" in columns and not re.search("currency|merchant_name#|division_|mfp_id|settled_at#[^ ]* AS", columns)


def test_ledger_rows_carry_their_numbers_in_few_columns(no_broadcast, sf_dir):
    """Cents and days of transactions and payouts are one number each where rows are shuffled by id and by payout."""
    plan = physical(QUERIES["transaction_ledger"](no_broadcast, sf_dir))
    assert "money" in plan and "paid" in plan
    optimized_plan = optimized(QUERIES["transaction_ledger"](no_broadcast, sf_dir))
    columns = re.search(r"RepartitionByExpression \[created_at[^\n]*\n[^\n]*Union[^\n]*\n[^\n]*Project \[([^\n]*)\]", optimized_plan).group(1)
    assert {"money", "paid"} <= set(re.findall(r"(\w+)#", columns)) and not re.search(r"amount|_fee#|created_at#\d+, .*created_at#", columns)


def test_lines_come_back_from_being_dealt(spark):
    """Amounts of no whole cents, below zero, infinite or too large, nulls, separators and times outside the bits stay as they are."""
    amounts = [0.0, None, 0.01, 655.34, 655.35, 1 / 3, -5.25, 1e300, float("inf"), 21474836.46, 21474836.47, 0.1 + 0.2]
    times = [dt.datetime(1998, 1, 1), None, dt.datetime(1960, 5, 5, 1), dt.datetime(2300, 1, 1, 23, 59, 59, 999999), dt.datetime(1999, 1, 1, 7)]
    flags = ["A", None, "", "x\x1f", "\x1e2"]
    data = [(i, 1, 1, i, amounts[i % 12], amounts[i * 5 % 12], 0.1, None, flags[i % 5], flags[i % 3], times[i % 5]) for i in range(120)]
    lines = spark.createDataFrame(data, table_schema("lineitem"))
    dealt = _dealt(lines, "lineitem", 5, "l_orderkey")
    assert dealt.schema.simpleString() == lines.schema.simpleString() and dealt.rdd.getNumPartitions() == 5
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, lines.collect()))
    assert re.search(r"RepartitionByExpression \[l_orderkey[^\n]*\n[^\n]*Project \[[^\n]* AS _folded#[^\n]* AS _texts#", optimized(dealt))
