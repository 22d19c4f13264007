"""Append-only datasets written once per micro-batch.

Each batch owns the partition ``stream=<id>/batch=<n>`` and overwrites only
that one, so a batch repeated after a failure replaces its earlier attempt.
``stream`` identifies the checkpoint, as batch numbers start over with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelog.schemas import BIGINT, STRING


@dataclass(frozen=True)
class Batch:
    stream: str
    number: int


def stream_id(checkpoint: str) -> str:
    """A short stable name for a checkpoint location."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def write_batch(df: DataFrame, path: str, batch: Batch, by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Write the rows of one batch, replacing only an earlier attempt of it."""
    rows = df.withColumn("stream", F.lit(batch.stream)).withColumn("batch", F.lit(batch.number).cast("bigint"))
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "stream", "batch")
        .save(path)
    )


def batch_schema(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("stream", STRING).add("batch", BIGINT)


def create_dataset(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create an empty dataset unless something is there already."""
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def read_batches(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(batch_schema(schema)).load(path)


def up_to(reached: Mapping[str, int]) -> Column:
    """Whether a row's batch is at or before the position of its stream."""
    test = F.lit(False)
    for stream, batch in reached.items():
        test = test | ((F.col("stream") == stream) & (F.col("batch") <= batch))
    return test
