"""Latency counts per day, kept beside the metric rows, so that a report does not read their history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.operators import kpi
from tidelog.schemas import BIGINT, DATE, STRING, TIMESTAMP, struct
from tidelog.sinks.batches import create_dataset, up_to

_SUMS = ("doc_size_bytes", "debezium_lat_ms", "consumer_lat_ms", "write_lat_ms")
COUNTS = struct(e2e_lat_ms=BIGINT, n=BIGINT, newest=TIMESTAMP, **{c: BIGINT for c in _SUMS}, **{f"n_{c}": BIGINT for c in _SUMS}, fold=BIGINT, day=DATE)
FOLDED = struct(fold=BIGINT, stream=STRING, batch=BIGINT)


class DailyCounts:
    """Counts of metric rows under ``path``. Each fold adds the batches since the one before, and names them last.

    A fold that failed on the way is written again under its number, so every
    batch counts once. One fold at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        create_dataset(spark, f"{self.path}/counts", COUNTS)
        create_dataset(spark, f"{self.path}/folded", FOLDED)

    def _folded(self) -> tuple[int, dict[str, int]]:
        """The last fold and how far it has come: a row per stream and fold."""
        rows = self.spark.read.schema(FOLDED).parquet(f"{self.path}/folded").groupBy("stream").agg(F.max("batch").alias("batch"), F.max("fold").alias("fold")).collect()
        return max((r["fold"] for r in rows), default=0), {r["stream"]: r["batch"] for r in rows}

    def pending(self, metrics: DataFrame, reached: Mapping[str, int]) -> DataFrame:
        """Metric rows up to the batches ``reached`` that no fold has counted. A test on partition columns: other files stay closed."""
        return metrics.filter(up_to(reached) & ~up_to(self._folded()[1]))

    def refresh(self, metrics: DataFrame, reached: Mapping[str, int]) -> None:
        """Count the batches of stored metrics (stream -> last complete batch) that are new."""
        last, folded = self._folded()
        if all(folded.get(stream, -1) >= batch for stream, batch in reached.items()):
            return
        counted = kpi.daily_counts(self.pending(metrics, reached)).withColumn("fold", F.lit(last + 1).cast("bigint"))
        where = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fold", "day")
        where.parquet(f"{self.path}/counts")
        rows = [(last + 1, stream, batch) for stream, batch in sorted(reached.items())]
        self.spark.createDataFrame(rows, FOLDED).coalesce(1).write.mode("append").parquet(f"{self.path}/folded")

    def read(self) -> DataFrame:
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts").filter(F.col("fold") <= self._folded()[0])

    def kpis(self, metrics: DataFrame, as_of: Column | None = None) -> DataFrame:
        return kpi.kpis_of_counts(self.read(), metrics, as_of)
