"""Run registered queries beside their SQL and compare rows, column names, types and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallywright.sources.tables import table_names  # noqa: E402

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in table_names():
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    text = frame.apply(lambda c: c.map(lambda v: "\0" if v is None or pd.isna(v) else str(v)))
    order = text.sort_values(list(text.columns), kind="stable").index
    return text.loc[order].reset_index(drop=True)


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(rel.columns):
        return [f"columns {sorted(set(columns) ^ set(rel.columns))}"]
    found = []
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c in columns:
        wanted = DUCK_TYPES.get(spark_types[c], spark_types[c].upper())
        if wanted != duck_types[c]:
            found.append(f"type of {c}: {spark_types[c]} / {duck_types[c]}")
    left = df.toArrow().select(columns).to_pandas(types_mapper=pd.ArrowDtype)
    right = con.sql(sql).to_arrow_table().select(columns).to_pandas(types_mapper=pd.ArrowDtype)
    if len(left) != len(right):
        return found + [f"rows {len(left)} / {len(right)}"]
    a, b = _sorted(left), _sorted(right)
    for c in columns:
        unequal = a[c] != b[c]
        if unequal.any():
            at = unequal.idxmax()
            found.append(f"{c}: {int(unequal.sum())} differ, first {a[c][at]!r} / {b[c][at]!r}")
    return found


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        began = time.time()
        try:
            problems = differences(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on to the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - began:.2f}s")
        for p in problems:
            print("     ", p)
        sys.stdout.flush()
    print("bad:", bad)
