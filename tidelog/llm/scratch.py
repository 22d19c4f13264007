"""What driver and executors share: intermediate tables, and this package's code."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`. Unset, a temporary folder serves, but in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidelog-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Writes `frame` once and reads it back: what follows is cut off from its lineage and survives lost executors."""
    path = shared(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once for each context."""
    context = spark.sparkContext
    if getattr(context, "_tidelog_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="tidelog-code-")) / "tidelog.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tidelog").rglob("*.py")):
            out.write(file, file.relative_to(root).as_posix())
    context.addPyFile(str(archive))
    context._tidelog_shipped = True
