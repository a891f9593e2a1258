"""Staged tables that several runs share: each run has its own partition, which it alone replaces."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RUN = "run_id"
FOLDER = "spark.checkpoint.dir"


def new_run_id() -> str:
    return str(uuid.uuid4())


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session without one gets a temporary folder; on a cluster, where
    each executor would write to its own disk, that is an error."""
    folder = spark.conf.get(FOLDER, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{FOLDER} must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallywright-")
        spark.conf.set(FOLDER, folder)
    return folder.rstrip("/")


def _checked(run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError(f"a run id holds letters, digits, - and _ only: {run_id!r}")
    return run_id


def stage_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Writes the rows as the run's partition of the staged table. A run that is repeated replaces its own rows, also by
    none; other runs stay as they are."""
    rows.write.mode("overwrite").parquet(f"{path}/{RUN}={_checked(run_id)}")


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All staged rows with their run id."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])).parquet(path)


def read_run(spark: SparkSession, path: str, schema: T.StructType, run_id: str) -> DataFrame:
    """One run's rows; only its partition is listed and read."""
    return read_runs(spark, path, schema).filter(F.col(RUN) == _checked(run_id)).drop(RUN)


def staged(rows: DataFrame, path: str, run_id: str) -> DataFrame:
    """The rows, written once under the run and read back: what follows does not work them out again."""
    stage_run(rows, path, run_id)
    return read_run(rows.sparkSession, path, rows.schema, run_id)
