"""Target tables on plain Parquet: appended states, merged when read.

A micro-batch appends its collapsed states (operators.merge) and never rewrites
stored rows, so its cost follows the batch and not the table. A read resolves
the keys touched since the last compaction and passes the others on. ``compact``
folds the states into a new version every so often.

States combine without regard to order or overlap, so a repeated batch, a
replayed log or a compaction that ran twice all leave the same rows. A version
counts only once its commit row is written; until then readers use the one
before. On a cluster with a table format that has MERGE, the same states can
feed that instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidelog.operators import merge
from tidelog.schemas import BIGINT, BOOLEAN, COMMIT, STATE, STRING
from tidelog.sinks.batches import Batch, batch_schema, create_dataset, read_batches, up_to, write_batch
from tidelog.spec import Target


class TargetTable:
    """One target of a collection, stored under ``path``.

    ``buckets`` splits the next compacted version by key hash; aim at files of a
    few hundred megabytes. A lookup by key reads only the key's bucket, and
    within it the row groups whose key range fits.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        target: Target,
        column_types: dict[str, DataType],
        buckets: int = 64,
        order_by: str = merge.ARRIVAL,
    ):
        self.order_by = order_by
        self.spark = spark
        self.target = target
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.payload = merge.target_payload(target)
        self.states = StructType([StructField(target.key, STRING), *STATE.fields])
        for name in self.payload:
            self.states.add(name, column_types[name])

    def create(self) -> None:
        """Create the table unless it exists."""
        create_dataset(self.spark, f"{self.path}/changes", batch_schema(self.states))
        create_dataset(self.spark, f"{self.path}/base", self._base_schema())
        create_dataset(self.spark, f"{self.path}/commits", COMMIT)

    def append(self, states: DataFrame, batch: Batch) -> None:
        """Store the states of one batch, collapsed from its applied events with the fields the target reads."""
        write_batch(merge.target_states(states, self.target), f"{self.path}/changes", batch)

    def read(self, keys: Sequence[str] | None = None) -> DataFrame:
        """Current rows; with ``keys`` only those, from their buckets and the batches since."""
        version, folded, buckets = self._committed()
        name = self.target.key
        base, since = self._base(version, buckets, keys), self._changes(folded).select(*self.states.names)
        if keys is not None:
            wanted = F.col(name).isin(list(keys))
            base, since = base.filter(wanted), since.filter(wanted)
        return self._rows(base, since)

    def read_joined(self, keys: DataFrame) -> DataFrame:
        """Current rows of the keys in a column of a table named like the target's key; no key is collected.

        Only their states are resolved. A small set of keys also prunes the
        compacted version: buckets without any of them are not read.
        """
        version, folded, buckets = self._committed()
        name = self.target.key
        wanted = keys.select(F.col(name)).distinct()
        base = self._base_rows(version).join(wanted.withColumn("bucket", _bucket(F.col(name), buckets)), ["bucket", name], "left_semi")
        since = self._changes(folded).select(*self.states.names).join(wanted, name, "left_semi")
        return self._rows(base.select(*self.states.names, "settled"), since)

    def _rows(self, base: DataFrame, since: DataFrame) -> DataFrame:
        """Rows from compacted states and those since.

        A settled key that no later batch has touched is its row already. Only
        the others are resolved: with few changes since the compaction, Spark
        broadcasts their keys and does not shuffle the version.
        """
        name = self.target.key
        touched = since.select(name).distinct()
        settled = base.filter("settled")
        same = settled.join(touched, name, "left_anti").filter(~F.col("is_delete"))
        same = same.select(name, F.coalesce("first_ms", "event_ms").alias("first_ms"), "event_ms", *self.payload)
        others = base.filter(~F.col("settled")).unionByName(settled.join(touched, name, "left_semi")).drop("settled").unionByName(since)
        resolved = merge.resolve(others, self.payload, name, order=self.order_by).select(*same.columns)
        return merge.stored_rows(same.unionByName(resolved), self.target)

    def compact(self, forget_deleted_before_ms: int | None = None, complete: DataFrame | None = None) -> None:
        """Fold all states stored so far into a new version.

        Deleted keys keep a marker row, so late re-deliveries cannot bring them
        back. ``forget_deleted_before_ms`` drops markers of keys whose last
        record is older than that. ``complete`` is that of ``merge.fold``.
        """
        version, folded, buckets = self._committed()
        # Positions first: batches arriving from here on stay in the change set.
        reached = self._changes(folded).groupBy("stream").agg(F.max("batch").alias("batch")).collect()
        reached = folded | {row["stream"]: row["batch"] for row in reached}
        if reached == folded:
            return
        pending = self._changes(folded).filter(up_to(reached)).select(*self.states.names)
        states = merge.fold(self._base(version, buckets).drop("settled").unionByName(pending), self.payload, self.target.key, complete, self.order_by)
        if forget_deleted_before_ms is not None:
            states = _forget_deleted(states, self.target.key, forget_deleted_before_ms)
        # One state is all there is of a settled key.
        alone = F.count("*").over(Window.partitionBy(self.target.key)) == 1
        bucketed = states.withColumns(
            {
                "settled": alone,
                "version": F.lit(version + 1).cast("bigint"),
                "bucket": _bucket(F.col(self.target.key), self.buckets),
            }
        )
        # Rebalancing splits large and joins small buckets by their real size.
        (
            bucketed.hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", self.target.key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("version", "bucket")
            .parquet(f"{self.path}/base")
        )
        rows = [(version + 1, stream, batch, self.buckets) for stream, batch in sorted(reached.items())]
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def expire(self) -> None:
        """Delete versions and change batches that the current version replaces.

        Run it while no reader still uses an older version.
        """
        version, folded, _ = self._committed()
        old = [f"{self.path}/base/version={v}" for v in range(1, version)]
        spent = self._all_changes().filter(up_to(folded)).select("stream", "batch").distinct().collect()
        old += [f"{self.path}/changes/stream={r['stream']}/batch={r['batch']}" for r in spent]
        jvm = self.spark._jvm
        for folder in old:
            place = jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def _base_schema(self) -> StructType:
        return StructType(list(self.states.fields)).add("settled", BOOLEAN).add("version", BIGINT).add("bucket", BIGINT)

    def _committed(self) -> tuple[int, dict[str, int], int]:
        """Current version, the last batch of each stream in it, and its buckets.

        Read from the commit rows: one per version and checkpoint ever used.
        """
        commits = self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")
        newest = commits.groupBy("version").agg(
            F.collect_list(F.struct("stream", "batch")).alias("folded"), F.max("buckets").alias("buckets")
        )
        rows = newest.orderBy(F.desc("version")).limit(1).collect()
        if not rows:
            return 0, {}, self.buckets
        return rows[0]["version"], {r["stream"]: r["batch"] for r in rows[0]["folded"]}, rows[0]["buckets"]

    def _all_changes(self) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/changes", self.states)

    def _changes(self, folded: dict[str, int]) -> DataFrame:
        """Batches after the folded ones; a filter on the partition columns, so only their files are read."""
        return self._all_changes().filter(~up_to(folded))

    def _base_rows(self, version: int) -> DataFrame:
        return self.spark.read.schema(self._base_schema()).parquet(f"{self.path}/base").filter(F.col("version") == version)

    def _base(self, version: int, buckets: int, keys: Sequence[str] | None = None) -> DataFrame:
        base = self._base_rows(version)
        if keys is not None:
            base = base.filter(F.col("bucket").isin([_bucket(F.lit(k), buckets) for k in keys]))
        return base.select(*self.states.names, "settled")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets).cast("bigint"))


def _forget_deleted(states: DataFrame, key: str, before_ms: int) -> DataFrame:
    """Drop all states of keys that are deleted and had no record since ``before_ms``."""
    newest = states.groupBy(key).agg(
        F.max("last_kafka_ms").alias("_seen"),
        F.max_by("is_delete", F.struct("last_kafka_ms", "topic", "partition", "last_offset")).alias("_gone"),
    )
    gone = newest.filter(F.col("_gone") & (F.col("_seen") < before_ms))
    return states.join(gone.select(key), key, "left_anti")
