import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.functions import dates, filters, money, text


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()
    return row["x"]


def column_of(spark, values, schema, make):
    df = spark.createDataFrame([(v,) for v in values], f"v {schema}")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_money_text(spark):
    raw = ["$1,234..50", "", "  ", None, "abc", "12", " 7.5 "]
    wanted = [Decimal("1234.50"), None, None, None, None, Decimal("12.00"), Decimal("7.50")]
    assert column_of(spark, raw, "string", money.money_text) == wanted


def test_money_text_fallback(spark):
    df = spark.createDataFrame([(None, "3.25"), ("", "9")], "a string, b string")
    assert [r[0] for r in df.select(money.money_text(F.coalesce("a", "b"))).collect()] == [Decimal("3.25"), None]


def test_ratio_of_zero_is_null(spark):
    assert one(spark, money.ratio(F.col("a"), F.col("b")), a=3.0, b=0) is None


@pytest.mark.parametrize(
    "day, week",
    [
        (dt.date(2024, 1, 1), 1),
        (dt.date(2024, 1, 6), 1),
        (dt.date(2024, 1, 7), 2),
        (dt.date(2023, 1, 1), 1),
        (dt.date(2024, 12, 31), 53),
        (dt.date(2022, 12, 31), 53),
    ],
)
def test_us_week(spark, day, week):
    assert one(spark, dates.us_week(F.lit(day))) == week


@pytest.mark.parametrize(
    "moment, label",
    [
        ("2024-01-01 10:00:00", "2024 - Week 1"),  # the day before is in week 53 of 2023
        ("2024-01-07 10:00:00", "2024 - Week 1"),
        ("2024-01-08 10:00:00", "2024 - Week 2"),
        ("2023-01-01 10:00:00", "2023 - Week 1"),
        ("2024-12-31 10:00:00", "2024 - Week 53"),
    ],
)
def test_week_label(spark, moment, label):
    value = dates.moment(dt.datetime.fromisoformat(moment))
    assert one(spark, dates.period_label(dates.PERIOD_WEEK, value)) == label


def test_other_period_labels(spark):
    value = dates.moment(dt.datetime(2024, 2, 1, 3))
    local = dates.shifted_hours(value, F.lit(-5))
    assert one(spark, dates.period_label(dates.PERIOD_MONTH, local)) == "2024 - January"
    assert one(spark, dates.period_label(dates.PERIOD_QUARTER, value)) == "2024 - Q1"
    assert one(spark, dates.period_label(dates.PERIOD_YEAR, value)) == "2024"
    assert one(spark, dates.period_label(9, value)) is None


def test_calendar_labels(spark):
    value = dates.moment(dt.datetime(2024, 3, 31, 8))
    assert one(spark, dates.month_sort_label(dates.month_before(value))) == "02 - February "
    assert one(spark, dates.weekday_label(value)) == "03-31-2024 - Sunday   "
    assert one(spark, dates.month_before(value)) == dt.datetime(2024, 2, 29, 8)
    assert one(spark, dates.first_of_next_month(F.lit(dt.date(2024, 2, 10)))) == dt.date(2024, 3, 1)
    assert one(spark, dates.previous_month_tag(F.lit(dt.date(2025, 1, 15)))) == "DEC 2024"


def test_text(spark):
    assert one(spark, text.clean_string(F.lit("\tSh@op/ No. 7\n"))) == "shop no 7"
    assert one(spark, text.safe_file_name(F.lit('a<b>:"/\\|?*c'))) == "abc"
    assert one(spark, text.base_name(F.lit(r"C:\out/x.pdf"))) == "x.pdf"
    assert one(spark, text.mapped(F.lit("kentucky"), {"Kentucky": "KY"})) == "KY"
    assert column_of(spark, [None, "", "x"], "string", lambda c: text.blank_to(c, "n/a")) == ["n/a", "n/a", "x"]


def test_address_without_state(spark):
    parts = [F.lit(" 1 Main St "), F.lit("Town"), F.lit(None).cast("string"), F.lit("123")]
    assert one(spark, text.address_line(*parts)) == "1 Main St Town  123"
    parts[2] = F.lit("TX")
    assert one(spark, text.address_line(*parts)) == "1 Main St Town, TX 123"


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(4,), (2,), (None,)], "t int")
    assert sorted(r[0] or 0 for r in filters.delete_where(df, F.col("t") == 4).collect()) == [0, 2]


@pytest.mark.parametrize("mode, kept", [(None, "abcde"), (1, "a"), (2, "bcde"), (3, "b"), (7, "")])
def test_region_mode(spark, mode, kept):
    rows = [("a", "CA", "ON"), ("b", "US", "TX"), ("c", None, None), ("d", "US", "PR"), ("e", "MX", "TX")]
    df = spark.createDataFrame(rows, "id string, country string, state string")
    test = filters.all_of([filters.region_mode(F.col("country"), F.col("state"), mode)])
    assert "".join(sorted(r[0] for r in df.filter(test).collect())) == kept


@pytest.mark.parametrize("switch, kept", [("all", [1, 2, 6]), ("cc", [1]), ("x cc,ec", [1, 6]), ("none", [])])
def test_tender_switch(spark, switch, kept):
    df = spark.createDataFrame([(1,), (2,), (6,)], "t int")
    assert [r[0] for r in df.filter(filters.tender_switch(F.col("t"), switch)).collect()] == kept


def test_required_columns(spark):
    with pytest.raises(ValueError):
        filters.require_columns(spark.range(1), ["id", "name"])
