"""Stage outputs: written once to the folder that all executors share, so that later steps start from there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset a session on one machine (tests) gets
    a new local folder; on a cluster nobody else could read that, so it is an error."""
    held = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not held:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isEmpty() and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        held = known.get() if known.isDefined() else tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(held)
    return held


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: short lineage, and nothing is lost with an executor."""
    path = f"{shared_dir(df.sparkSession)}/docgrain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, key: str, out: str = "rank") -> DataFrame:
    """``df`` with the place of each row, from 0, in order of a unique ``key``, without gathering it in one task.

    Rows are dealt by ranges of the key and numbered inside each; a range starts where those before it end. The table of
    ranges has one row a partition, which bounds its broadcast. The dealing is written first, so that all parts see the same.
    """
    dealt = stage(df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return dealt.join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + inside).drop("_part", "_start")
