"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the size of a document counts it, and what stands between.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it again: the lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docgrain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def uniform(*cols: Column) -> Column:
    """A reproducible number in [0, 1) from the hash of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def expand_counted(df: DataFrame, count: str, index: str, chunk: int = 10_000) -> DataFrame:
    """One row for each of the ``count`` equal rows that ``df`` has collapsed, numbered from 0 in ``index``.

    A large count is cut into chunks first, so that no row carries an array longer than ``chunk``.
    """
    n = F.col(count)
    firsts = F.when(n <= chunk, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(chunk).cast("long")))
    cut = df.withColumn("_first", F.explode(firsts))
    last = F.least(F.col("_first") + chunk - 1, n - 1)
    return cut.withColumn(index, F.explode(F.sequence(F.col("_first"), last))).drop("_first")
