"""A stored log is parsed on all cores."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidelog.plans import catalog
from tidelog.schemas import CHANGE_RECORD
from tidelog.sources import fixtures


def test_a_large_file_of_the_log_has_several_row_groups(spark, sf_dir, tmp_path):
    log = fixtures.order_log(spark, sf_dir)
    many = log.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(20))))
    many = many.withColumn("value", F.concat("value", F.sha2(F.concat("value", F.col("_n").cast("string")), 512).cast("binary"))).drop("_n")
    catalog._store_log(many.coalesce(1), str(tmp_path / "log"))
    (stored,) = glob.glob(str(tmp_path / "log" / "*.parquet"))
    groups = pq.ParquetFile(stored).metadata.num_row_groups
    # As many as let several tasks share the file, and the records are all there.
    assert groups >= 2
    back = spark.read.schema(CHANGE_RECORD).parquet(str(tmp_path / "log"))
    assert back.count() == many.count()
