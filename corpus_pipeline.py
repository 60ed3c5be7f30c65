"""The corpus pipeline: quality, near duplicates, decontamination, mixing, sharding, in this order.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps with the columns of ``documents``; mixing repeats
rows that the mix takes more than once, and the last stage adds ``shard`` and ``slot``. Nulls, empty tables and extra columns
are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docgrain.llm.common import materialize, read_table
from docgrain.llm.decontaminate import clean_rows
from docgrain.llm.jaccard import first_of_each_class
from docgrain.llm.mixing import mixed_rows
from docgrain.llm.quality import good_rows
from docgrain.llm.sharding import sharded_rows


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_rows(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of links stays."""
    return first_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of the benchmark occurs go."""
    return clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it."""
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and slot."""
    return sharded_rows(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A fitted classifier and a randomised join have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
