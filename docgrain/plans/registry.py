"""The registry of queries: each takes (spark, sf_dir); SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def spread(df: DataFrame) -> DataFrame:
    """Rows for work that is heavy for its bytes: a table in fewer files than there are cores would be read by few tasks, so
    its rows are dealt out first; tables of more files stay where they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
