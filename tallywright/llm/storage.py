"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallywright.sources.staging import shared_folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written once as Parquet and reread: later steps neither recompute them nor need the executors that made them."""
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
