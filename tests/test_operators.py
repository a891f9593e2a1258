"""Operators against brute force, on small made-up rows with hot keys, ties and nulls."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tallywright.functions import text
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
    preserve_rows,
    range_sums,
    running_totals,
    unpivot_present,
)
from tallywright.operators import packing
from tallywright.operators.rangesums import covered_days
from tallywright.plans import stores
from tallywright.operators.numbering import SLICES, slice_bounds, with_slices

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@few
@given(
    left=st.lists(st.tuples(st.integers(0, 2), st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1, 2])), max_size=8),
    right=st.lists(st.tuples(st.integers(0, 2), st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1]), st.integers(0, 9)), max_size=8),
)
def test_left_join_coalesced(spark, left, right):
    l = spark.createDataFrame(left, "k int, a string, b int")
    r = spark.createDataFrame(right, "k int, a string, b int, v int")
    found = left_join_coalesced(l, r, ["k"], ["a", "b"]).select("k", "a", "b", "right_a", "right_b", "v")
    wanted = []
    for k, a, b in left:
        hits = [
            (k, a, b, ra, rb, v)
            for rk, ra, rb, v in right
            if rk == k and ra is not None and rb is not None and a in (None, ra) and b in (None, rb)
        ]
        wanted += hits or [(k, a, b, None, None, None)]
    assert rows(found) == sorted(wanted, key=repr)


@few
@given(
    facts=st.lists(st.tuples(st.sampled_from([None, 1, 1, 1, 2]), st.integers(0, 20), st.sampled_from([None, 1, 5, -3])), max_size=25),
    ranges=st.lists(st.tuples(st.sampled_from([1, 1, 2, 3]), st.integers(0, 20), st.integers(0, 25)), min_size=1, max_size=8),
)
def test_range_sums(spark, facts, ranges):
    at = lambda n: DAY + dt.timedelta(days=n)
    f = spark.createDataFrame([(k, at(d), v) for k, d, v in facts], "k int, day date, v long")
    g = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in ranges], "k int, a date, b date")
    found = {(r.k, r.a, r.b): r.v for r in range_sums(f, g, "k", "day", "a", "b", ["v"]).collect()}
    for k, a, b in set(ranges):
        hit = [v for fk, d, v in facts if fk == k and a <= d <= b and v is not None]
        assert found.get((k, at(a), at(b))) == (sum(hit) if hit else None)


def test_facts_outside_all_ranges_are_dropped_first(spark):
    """A fact that would overflow the sum stands on a day that no range of its key holds."""
    at = lambda n: DAY + dt.timedelta(days=n)
    large = 2**63 - 1
    facts = [(1, at(0), large), (1, at(0), large), (1, at(5), 2), (1, at(6), 3), (1, at(9), large), (2, at(5), large)]
    f = spark.createDataFrame(facts, "k int, day date, v long")
    g = spark.createDataFrame([(1, at(5), at(5)), (1, at(4), at(6)), (1, at(6), at(7)), (3, at(0), at(9))], "k int, a date, b date")
    assert rows(range_sums(f, g, "k", "day", "a", "b", ["v"])) == [(1, at(4), at(6), 5), (1, at(5), at(5), 2), (1, at(6), at(7), 3), (3, at(0), at(9), None)]
    assert {tuple(r) for r in covered_days(g, "k", "a", "b").collect()} == {(1, at(n)) for n in (4, 5, 6, 7)} | {(3, at(n)) for n in range(10)}


@few
@given(data=st.lists(st.tuples(st.sampled_from([None, 1, 1, 2]), st.sampled_from([None, *range(20)]), st.integers(0, 24)), max_size=12))
def test_covered_days(spark, data):
    at = lambda n: None if n is None else DAY + dt.timedelta(days=n)
    g = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in data], "k int, a date, b date")
    wanted = {(k, at(n)) for k, a, b in data if k is not None and a is not None for n in range(a, b + 1)}
    assert rows(covered_days(g, "k", "a", "b")) == sorted(wanted, key=repr)


def test_range_sums_of_inexact_numbers(spark):
    """A running total of doubles would lose 0.1 beside 1e16; as decimals both ranges are right."""
    at = lambda n: DAY + dt.timedelta(days=n)
    f = spark.createDataFrame([(1, at(0), 1e16), (1, at(1), 0.1)], "k int, day date, v double")
    g = spark.createDataFrame([(1, at(0), at(1)), (1, at(1), at(1))], "k int, a date, b date")
    with pytest.raises(TypeError, match="cast them first"):
        range_sums(f, g, "k", "day", "a", "b", ["v"])
    exact = f.withColumn("v", F.col("v").cast("decimal(20,2)"))
    assert [str(r.v) for r in range_sums(exact, g, "k", "day", "a", "b", ["v"]).orderBy("a").collect()] == ["10000000000000000.10", "0.10"]


def test_range_sums_with_null_bounds(spark):
    f = spark.createDataFrame([(1, DAY, 2)], "k int, day date, v long")
    g = spark.createDataFrame([(1, None, DAY), (1, DAY, None), (1, DAY, DAY)], "k int, a date, b date")
    assert rows(range_sums(f, g, "k", "day", "a", "b", ["v"])) == [(1, DAY, DAY, 2)]


def test_number_rows_in_groups(spark):
    """One group holds a third of all rows; the numbers must agree with the plain window."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("long")).otherwise(F.col("id") * 37 % 101).alias("o"),
        "id",
    )
    numbered = number_rows(df, ["o", "id"], ["g"], "n")
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
    assert rows(numbered.select("g", "o", "id", "n")) == rows(plain)
    assert sorted(r.n for r in numbered.filter("g is null").collect()) == list(range(1, 1001))


# a constant head, keys that differ in their first 8 characters, one hot value, outliers, dates, hardly any keys
KEYS = {
    "constant head": ("format_string('Customer#%012d', id * 7 % 20011)", "string"),
    "all different": ("sha2(cast(id as string), 256)", "string"),
    "one hot value": ("if(id % 3 > 0, 'hot', cast(id as string))", "string"),
    "outliers": ("if(id % 5000 = 7, id * 1000000000000, id * 31 % 977)", "long"),
    "dates": ("if(id % 9 > 0, date_add(date '2024-01-01', cast(id % 40 as int)), null)", "date"),
    "few": ("id % 3", "double"),
}


@pytest.mark.parametrize("name", KEYS)
def test_slices_follow_the_keys(spark, name):
    """However the keys look, slices are few enough to be added up in one task and each holds few of the rows."""
    key, kind = KEYS[name]
    df = spark.range(20011).select(F.expr(key).cast(kind).alias("k"), "id").repartition(7)
    per_slice = with_slices(df, ["k", "id"], "s").groupBy("s").agg(F.count("*").alias("n"), F.min(F.struct("k", "id")).alias("a"), F.max(F.struct("k", "id")).alias("z"))
    cut = per_slice.orderBy("s").collect()
    assert 300 < len(cut) <= SLICES and max(r.n for r in cut) < 600
    order = lambda r: (r.k is not None, r.k if r.k is not None else 0, r.id)
    assert all(order(x.z) < order(y.a) for x, y in zip(cut, cut[1:]))
    numbered = sorted((r.n, *order(r)) for r in number_rows(df, ["k", "id"], name="n").collect())
    assert [r[0] for r in numbered] == list(range(1, 20012)) and numbered == sorted(numbered, key=lambda r: r[1:])


def test_bounds_are_the_same_each_time(spark):
    df = spark.range(50000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    first = slice_bounds(df.repartition(3), ["k"]).first()
    assert first == slice_bounds(df.repartition(11), ["k"]).first() and len(set(first.bounds)) > 1000


def test_slices_of_many_keys_are_all_used(spark):
    df = spark.range(600_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    sizes = [r["count"] for r in with_slices(df, ["k"], "s").groupBy("s").count().collect()]
    assert 4000 < len(sizes) <= SLICES and max(sizes) < 2000


def test_rows_that_tie_and_no_rows(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"))
    found = sorted((r.n, r.k) for r in number_rows(df, ["k"], name="n").collect())
    assert found == [(n, 0 if n <= 250 else 1) for n in range(1, 501)]
    assert number_rows(df.limit(0), ["k"]).count() == 0 and number_rows(df.limit(1), ["k"], name="n").first().n == 1


@few
@given(data=st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 9), st.sampled_from([None, 1, -5, 7])), max_size=30))
def test_running_totals(spark, data):
    df = spark.createDataFrame([(g, o, k, v) for k, (g, o, v) in enumerate(data)], "g string, o int, id int, v long")
    found = running_totals(df, ["o", "id"], {"t": F.col("v"), "n": F.lit(1)}, ["g"])
    for r in found.collect():
        until = [v for k, (g, o, v) in enumerate(data) if g == r.g and (o, k) <= (r.o, r.id)]
        assert (r.t, r.n) == (sum(v or 0 for v in until), len(until))


def test_rows_are_shuffled_once_to_be_numbered(spark):
    """What stands before a slice comes as a row of its own, so numbered rows meet nothing in a join; types stay."""
    df = spark.range(9000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 9001).alias("o"), F.lit("line").alias("line"), F.lit(1.5).cast("decimal(9,2)").alias("v"))
    found = running_totals(df, ["o"], {"n": F.lit(1), "t": F.col("v")}, ["g"])
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.columns == [*df.columns, "n", "t"] and [found.schema[c].dataType.simpleString() for c in ("n", "t")] == ["bigint", "decimal(33,2)"]
    plain = Window.partitionBy("g").orderBy("o")
    wanted = df.withColumns({"n": F.row_number().over(plain).cast("long"), "t": F.sum("v").over(plain).cast("decimal(33,2)")})
    assert rows(found) == rows(wanted)


@few
@given(n=st.integers(0, 40), size=st.integers(1, 12))
def test_batches(spark, n, size):
    found = [r.batch_no for r in batch_numbers(spark.range(n), ["id"], size).orderBy("id").collect()]
    assert found == [i // size + 1 for i in range(n)]


@few
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from([None, "p", "q"]), st.sampled_from([None, 1, 2, 3])), max_size=20))
def test_labelled_sums(spark, data):
    df = spark.createDataFrame(data, "g string, t string, v long")
    tests = {
        "p": (F.col("t") == "p", "v"),
        "not q": (~F.col("t").isin("q"), "v"),
        "any": (F.lit(True), "v"),
        "twice": (F.col("t").isNotNull(), "w"),
    }
    rules = [(name, test, measure) for name, (test, measure) in tests.items()]
    found = labelled_sums(df, ["g"], rules, {"v": F.col("v"), "w": F.col("v") * 2}, "label", "total", "long")
    wanted = None
    for name, (test, measure) in tests.items():
        value = F.col("v") if measure == "v" else F.col("v") * 2
        part = df.filter(test).groupBy("g").agg(F.sum(value).alias("total")).select("g", F.lit(name).alias("label"), "total")
        wanted = part if wanted is None else wanted.unionByName(part)
    assert rows(found) == rows(wanted)


def test_labelled_sums_with_many_rules(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), "id")
    rules = [(f"rule {i}", F.col("id") % 100 == i, "id") for i in range(100)]
    found = labelled_sums(df, ["g"], rules, {"id": F.col("id")}, "label", "total", "long")
    assert found.agg(F.sum("total")).first()[0] == sum(range(200)) and found.select("label").distinct().count() == 100


@few
@given(data=st.lists(st.tuples(st.integers(0, 9), st.sampled_from([None, 1]), st.sampled_from([None, 2])), max_size=8, unique_by=lambda t: t[0]))
def test_pivot_undoes_unpivot(spark, data):
    df = spark.createDataFrame(data, "id int, a long, b long")
    back = pivot_sums(unpivot_present(df, ["id"], ["a", "b"], "c", "v"), ["id"], "c", "v", ["a", "b"])
    assert rows(back) == sorted([t for t in data if t[1:] != (None, None)], key=repr)


def test_pivot_finds_labels(spark):
    df = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (2, "x", 4), (3, None, 9)], "id int, c string, v long")
    assert rows(pivot_sums(df, ["id"], "c", "v")) == [(1, 2, 3), (2, 4, None), (3, None, None)]


def test_hierarchy(spark):
    tree = [("d", "D", 2, None), ("g", "G", 3, "d"), ("b", "B", 4, "g"), ("m", "M", 5, "b"), ("m", "M", 5, "b"), ("x", "X", 5, "g"), ("n", "N", 6, "b")]
    entity = spark.createDataFrame(tree, "id string, name string, entity_type int, parent_entity_id string")
    assert [r.merchant_entity_id for r in entity_hierarchy(entity).collect()] == ["m"]
    assert sorted(r.merchant_entity_id for r in entity_hierarchy(entity, None).collect()) == ["m", "m", "n"]


def test_preserve_rows(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string")
    facts = spark.createDataFrame([(1, 5), (1, 6), (3, 7)], "k int, v int")
    assert rows(preserve_rows(dim, facts, facts, "k")) == [(1, "a", 5), (1, "a", 6), (2, "b", None)]


def test_flags_and_counts(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "g string, o int")
    assert rows(first_in_group(df, ["g"], ["o"], "f")) == [("a", 1, True), ("a", 2, False), (None, 3, True), (None, 4, False)]
    assert rows(occurrence_count(df, "g", "n").select("o", "n")) == [(1, 2), (2, 2), (3, 2), (4, 2)]


def test_column_widths(spark):
    df = spark.createDataFrame([("g", "abcdef", 1.5), ("h", "a", None)], "g string, name string, x double")
    assert rows(column_widths(df, ["g"], ["name", "x"])) == [("g", 8, 5), ("h", 6, 3)]


def test_bounded_lists(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", None), ("b", None), ("c", "z")], "g string, v string")
    assert rows(text.listed_values(df, ["g"], "v", "l", "; ", most=2)) == [("a", "x; y"), ("b", ""), ("c", "z")]
    assert text.listed_values(df, [], "v", "l", most=3).first().l == "x,y,z"
    assert text.listed_values(df.limit(0), [], "v", "l").first().l == ""
    with pytest.raises(Exception, match="more than 1 values of v in one list"):
        text.listed_values(df, ["g"], "v", "l", most=1).collect()
    plan = text.listed_values(df, ["g"], "v", "l", most=2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # a task sends no more than the bound of each group


def test_bounded_labels(spark):
    df = spark.range(12).select((F.col("id") % 2).alias("k"), F.concat(F.lit("c"), F.col("id") % 4).alias("l"), "id")
    assert pivot_sums(df, ["k"], "l", "id", most=4).columns == ["k", "c0", "c1", "c2", "c3"]
    with pytest.raises(ValueError, match="more than 3 values"):
        pivot_sums(df, ["k"], "l", "id", most=3)


def test_list_relation(spark):
    found = lambda param: [tuple(r) for r in text.list_relation(spark, param).orderBy("place").collect()]
    assert found(" b, a,,b , c a,") == [("b", 1), ("a", 2), ("c a", 3)] and found(" , ") == [] == found("")
    assert text.split_list(" b, a,,b ") == ["b", "a"] and text.number_list("3, 1,3") == (3, 1) and text.number_list(None) is None
    params = stores.StoreParams(remit_groups="5, 6", statuses="1,2", site_types=(3,), brand_ids="all")
    assert (params.remit_groups, params.statuses, params.site_types, params.brand_ids) == ((5, 6), (1, 2), (3,), "all")


def test_packed_texts_come_back_as_they_were(spark):
    """Nulls, empty texts, separators, escapes and what nulls are written as are told apart, also after packing twice."""
    values = [None, "", "a", "\x1f", "\x1e", "\x1e0", "\x1e1", "\x1e2", "\x1e\x1f", "a\x1fb", "\x1e\x1e2", "\n", "."]
    rows = [(a, b, c) for a in values for b in values for c in (None, "", "\x1f\x1e2")]
    df = spark.createDataFrame(rows, "a string, b string, c string").select(
        "a", "b", "c", packing.packed([F.col("a"), F.col("b")]).alias("two"), packing.packed([F.col("c")]).alias("one")
    )
    df = df.withColumn("texts", packing.packed_again("two", "one"))
    found = df.withColumn("parts", packing.parts(F.col("texts"))).select(
        "a", "b", "c", *[packing.unpacked(F.col("parts"), n).alias(f"back_{n}") for n in range(3)], packing.last_value(F.col("texts")).alias("last")
    )
    assert all((r.a, r.b, r.c, r.c) == (r.back_0, r.back_1, r.back_2, r.last) for r in found.collect())


def test_spans_give_times_back(spark):
    times = [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(9999, 12, 31)]
    df = spark.createDataFrame([(a, b) for a in times for b in times], "a timestamp_ntz, b timestamp_ntz")
    found = df.select("a", F.col("b").alias("was"), packing.spanned("b", since="a")).select("was", packing.unspanned("b", since="a"))
    assert all(r.was == r.b for r in found.collect())


@few
@given(data=st.lists(st.tuples(*[st.sampled_from([None, 0, 1, -1, 6, 7, 8, 254, 255, 2**31, 2**62, -(2**63)])] * 3), min_size=1, max_size=12))
def test_folded_numbers_come_back(spark, data):
    """Nulls, the largest numbers of the bits and those that need more; where all fit, no text is beside the number."""
    df = spark.createDataFrame(data, "a long, b long, c long")
    bits = {"a": 3, "b": 8, "c": 52}
    folds = df.select("a", "b", "c", *packing.folded(bits, "f"))
    found = folds.select("a", "b", "c", "f", "f_rest", *[v.alias(f"back_{n}") for n, v in packing.unfolded(bits, "f").items()]).collect()
    for r in found:
        fit = all(v is None or 0 <= v < 2**w - 1 for v, w in zip(r[:3], bits.values()))
        assert r[5:] == r[:3] and (r.f_rest is None) == (r.f is not None) == fit


def test_days_and_spans_make_the_time(spark):
    times = [None, dt.datetime(2024, 2, 29), dt.datetime(1960, 1, 1, 23, 59, 59, 999999), dt.datetime(9999, 12, 31, 12)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select("t", packing.day_number("t").alias("d"), packing.of_day("t").alias("s"))
    assert [r.u for r in df.select(packing.day_and_span(F.col("d"), F.col("s")).alias("u")).collect()] == times
