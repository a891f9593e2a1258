"""File sources and sinks of the document reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallywright.operators.numbering import running_totals

#: Bytes of a line's names, numbers and quotes beside its text, about.
LINE_BYTES = 100


def typed_schema(columns: Sequence[str], numbers: Sequence[str]) -> T.StructType:
    """Text for every column but the numbers, so that ids keep their leading zeros."""
    return T.StructType(
        [T.StructField(c, T.DoubleType() if c in numbers else T.StringType()) for c in columns]
    )


def read_typed_csv(spark: SparkSession, path: str, columns: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """CSV with a heading row, read with declared types."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .schema(typed_schema(columns, numbers))
        .csv(path)
    )


def read_sections(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """One relation per statement section."""
    return {
        name: spark.read.option("header", True).option("escape", '"').schema(schemas[name]).csv(path)
        for name, path in paths.items()
    }


# The recipient list is read by position.
RECIPIENT_COLUMNS = ("merchant_id", "email", "salutation", "attachment_path", "unused", "division")


def read_recipients(spark: SparkSession, path: str) -> DataFrame:
    """Recipient list by position, whatever its headings say."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .schema(typed_schema(RECIPIENT_COLUMNS, ()))
        .csv(path)
        .drop("unused")
    )


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path).select("Address")


def list_attachments(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Paths of the files below a folder; only the listing is read, not the contents."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    return listed.select(F.regexp_replace("path", "^file:/*", "/").alias("path"))


def write_by_group(
    df: DataFrame, group_column: str, path: str, file_format: str = "csv", order_by: Sequence[str] = ()
) -> None:
    """One folder per group, without the group column in its files; only the folders written are replaced.

    The rebalance keeps a group together while it is of normal size and splits one that is not, so a large group
    becomes several files in its folder instead of one slow task.
    """
    balanced = df.hint("rebalance", group_column)
    if order_by:
        balanced = balanced.sortWithinPartitions(group_column, *order_by)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group_column)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def packed(pack: DataFrame, file_bytes: int, id_column: str) -> tuple[DataFrame, DataFrame]:
    """(lines with the number of their file, index of merchants with their first and last file).

    Merchants are laid end to end in id order by the bytes of their lines, and a file is so many bytes of that: small
    merchants share files, and a merchant of several files' size is dealt over as many by the hash of its line's place.
    """
    size = (F.octet_length(F.coalesce("line", F.lit(""))) + LINE_BYTES).cast("long")
    merchants = pack.groupBy(id_column).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("lines"))
    first = F.floor((F.col("until") - F.col("bytes")) / file_bytes)
    files = F.greatest(F.floor(F.col("bytes") / file_bytes), F.lit(1))
    index = running_totals(merchants, [id_column], {"until": F.col("bytes")}).select(
        id_column, "lines", "bytes", first.alias("first_file"), (first + files - 1).alias("last_file")
    )
    places = index.select(F.col(id_column).alias("_of"), "first_file", "last_file")
    turn = F.pmod(F.xxhash64("section_no", "row_no"), F.col("last_file") - F.col("first_file") + 1)
    dealt = pack.join(places, F.col(id_column).eqNullSafe(F.col("_of"))).withColumn("file_no", F.col("first_file") + turn)
    return dealt.select(*pack.columns, "file_no"), index


def write_packs(pack: DataFrame, path: str, id_column: str = "merchant_id", file_bytes: int = 64 << 20) -> None:
    """Statement lines as JSON in files of about so many bytes, with merchant, sheet and line order in each, and beside them
    an index that names each merchant's files. The number of files follows from the bytes, not from the merchants. Replaces
    what stands there; the index is written last, so a run that fails leaves none."""
    dealt, index = packed(pack, file_bytes, id_column)
    balanced = dealt.hint("rebalance", "file_no").sortWithinPartitions("file_no", id_column, "section_no", "row_no")
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file_no").json(f"{path}/packs")
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_packs(
    spark: SparkSession, path: str, schema: T.StructType, merchants: Sequence[str] | None = None, id_column: str = "merchant_id"
) -> DataFrame:
    """Lines of all or some merchants; for some, only the files that the index names are read."""
    lines = spark.read.schema(T.StructType([*schema.fields, T.StructField("file_no", T.LongType())])).json(f"{path}/packs")
    if merchants is None:
        return lines.drop("file_no")
    wanted = spark.read.parquet(f"{path}/index").filter(F.col(id_column).isin(list(merchants)))
    places = wanted.select(id_column, F.explode(F.sequence("first_file", "last_file")).alias("file_no"))
    return lines.join(places, [id_column, "file_no"], "left_semi").drop("file_no")


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """One text line per row."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result, so that SQL can read it too."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
