"""File sources and sinks, checked by reading back."""

import json
import re

import pytest
from pyspark.sql import functions as F, types as T

from tallywright.sources import files, staging


def test_grouped_export_replaces_only_its_groups(spark, tmp_path):
    out = str(tmp_path / "books")
    first = spark.createDataFrame([("a", "1"), ("b", "2")], "grp string, v string")
    files.write_by_group(first, "grp", out)
    files.write_by_group(spark.createDataFrame([("a", "9")], "grp string, v string"), "grp", out)
    back = spark.read.option("header", True).csv(out)
    assert sorted((r.grp, r.v) for r in back.collect()) == [("a", "9"), ("b", "2")]
    text = next((tmp_path / "books" / "grp=a").glob("*.csv")).read_text()
    assert text == "v\n9\n"  # the group is not a column of the file


def test_large_group_is_split(spark, tmp_path):
    out = str(tmp_path / "skewed")
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("grp"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        files.write_by_group(rows, "grp", out, "parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "skewed" / "grp=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(out).count() == 60000


PACK = "merchant_id string, section_no int, section string, row_no long, line string"


def test_packs_as_json(spark, tmp_path):
    rows = [("m1", 1, "A", 2, "y"), ("m1", 1, "A", 1, "x"), ("m2", 1, "A", 1, "z\n\u00e9"), (None, 1, "A", 1, None)]
    pack = spark.createDataFrame(rows, PACK)
    for _ in range(2):  # a second run replaces the first
        files.write_packs(pack, str(tmp_path / "packs"))
    texts = [f.read_text() for f in (tmp_path / "packs" / "packs").rglob("*.json")]
    assert len(texts) == 1  # three merchants share a file
    lines = [json.loads(x) for x in texts[0].splitlines()]
    assert [(x.get("merchant_id"), x.get("line")) for x in lines] == [(None, None), ("m1", "x"), ("m1", "y"), ("m2", "z\n\u00e9")]
    back = files.read_packs(spark, str(tmp_path / "packs"), pack.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, pack.collect()))


def test_number_of_pack_files_follows_the_bytes(spark, tmp_path):
    """2,000 merchants, one of whom holds a third of all lines."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("m_hot")).otherwise(F.format_string("m%04d", F.col("id") % 1999))
    pack = spark.range(30000).select(
        hot.alias("merchant_id"), F.lit(1).alias("section_no"), F.lit("A").alias("section"), F.col("id").alias("row_no"), F.lit("x" * 100).alias("line")
    )
    path, file_bytes = str(tmp_path / "packs"), 300_000
    files.write_packs(pack, path, file_bytes=file_bytes)
    folders = list((tmp_path / "packs" / "packs").glob("file_no=*"))
    assert 15 <= len(folders) <= 30000 * 200 / file_bytes + 2
    sizes = [sum(f.stat().st_size for f in d.glob("*.json")) for d in folders]
    assert max(sizes) < 2.5 * file_bytes
    index = {r.merchant_id: r for r in spark.read.parquet(f"{path}/index").collect()}
    assert len(index) == 2000 and index["m_hot"].lines == 10000 and index["m_hot"].last_file - index["m_hot"].first_file == 5
    for wanted in (["m_hot"], ["m0001", "m1998"], ["nobody"]):
        found = files.read_packs(spark, path, pack.schema, wanted)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, pack.where(F.col("merchant_id").isin(wanted)).collect()))
    assert "dynamicpruning" in files.read_packs(spark, path, pack.schema, ["m0001"])._jdf.queryExecution().executedPlan().toString()


def test_runs_are_staged_side_by_side(spark, tmp_path):
    path = str(tmp_path / "staged")
    first, second = staging.new_run_id(), "2024-02"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    staging.stage_run(rows, path, first)
    staging.stage_run(rows.limit(1), path, second)
    one = staging.read_run(spark, path, rows.schema, first)
    assert sorted(map(tuple, one.collect())) == [(1, "a"), (2, "b")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*run_id#\d+ = " + first, plan)
    # a repeated run replaces its own rows, also by none
    staging.stage_run(rows.where("n = 2"), path, first)
    assert [tuple(r) for r in staging.read_run(spark, path, rows.schema, first).collect()] == [(2, "b")]
    staging.stage_run(rows.limit(0), path, first)
    assert staging.read_run(spark, path, rows.schema, first).count() == 0
    assert staging.read_runs(spark, path, rows.schema).select("run_id").distinct().collect() == [(second,)]
    with pytest.raises(ValueError, match="run id"):
        staging.stage_run(rows, path, "../x")


def test_lines(spark, tmp_path):
    files.write_lines(spark.createDataFrame([("a: b",)], "line string"), str(tmp_path / "tz"))
    assert [r.value for r in spark.read.text(str(tmp_path / "tz")).collect()] == ["a: b"]


def test_typed_csv_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "in.csv").write_text('Merchant ID,Annual Sales Volume\n007,12.5\n"0,8",\n')
    df = files.read_typed_csv(spark, str(tmp_path / "in.csv"), ["Merchant ID", "Annual Sales Volume"], ["Annual Sales Volume"])
    assert [tuple(r) for r in df.collect()] == [("007", 12.5), ("0,8", None)]


def test_sections_recipients_and_addresses(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Id,Mail,Hello,File,X,Div\nm1,a@x,\"Dear A, hi\",/o/a.pdf,,diva\n")
    assert tuple(files.read_recipients(spark, str(tmp_path / "r.csv")).first()) == ("m1", "a@x", "Dear A, hi", "/o/a.pdf", "diva")
    (tmp_path / "a.csv").write_text("No,Address\n1,\"1 St, Town\"\n")
    assert files.read_addresses(spark, str(tmp_path / "a.csv")).first().Address == "1 St, Town"
    schema = T.StructType([T.StructField("merchant_id", T.StringType()), T.StructField("cents", T.LongType())])
    (tmp_path / "s.csv").write_text("merchant_id,cents\nm1,5\n")
    assert tuple(files.read_sections(spark, {"Charges": str(tmp_path / "s.csv")}, {"Charges": schema})["Charges"].first()) == ("m1", 5)


def test_attachments(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "A Shop_Statement.pdf").write_bytes(b"x")
    (tmp_path / "out" / "other.txt").write_bytes(b"x")
    assert [r.path for r in files.list_attachments(spark, str(tmp_path / "out")).collect()] == [str(tmp_path / "out" / "A Shop_Statement.pdf")]


def test_stage(spark):
    files.stage(spark.range(3), "staged_rows")
    assert spark.sql("select count(*) n from staged_rows").first().n == 3
    spark.catalog.dropTempView("staged_rows")
