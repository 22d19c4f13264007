"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings, all changeable on a running session.
SETTINGS = {
    # Epoch milliseconds and rendered times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Longer methods are never JIT-compiled by HotSpot; past this size Spark's
    # per-operator projections, which split their code, are much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Parsing is work for the processor: smaller splits of the log spread it evenly over the cores.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Persisted results are coalesced too, so writing them makes few files.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session and return it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str | int = 8, app: str = "tidelog", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the checkpoint directory the cluster names in ``spark.checkpoint.dir``.

    Where the session names none, the warehouse serves: it is shared as well.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tidelog/{purpose}-{uuid.uuid4().hex}"
