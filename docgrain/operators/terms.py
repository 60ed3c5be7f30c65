"""Terms: exact lookup, misses, pending lists, dictionary growth; survey of pages by host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgrain.sources.stages import ranked


def lookup(terms: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms with their translation, misses with counts). The seed wins over learnt translations (``src_rank``)."""
    first = dictionary.groupBy("term").agg(F.min_by("translation", "src_rank").alias("translation"))
    joined = terms.join(first, "term", "left")
    return joined, joined.where("translation IS NULL").groupBy("term").agg(F.count("*").alias("count"))


def add_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("term").agg(F.sum("count").alias("count"))


def pending(misses: DataFrame, dictionary: DataFrame, limit: int | None = None) -> DataFrame:
    """Misses without a translation, most frequent first."""
    rows = misses.join(dictionary.select("term").distinct(), "term", "left_anti").orderBy(F.desc("count"), "term")
    return rows if limit is None else rows.limit(limit)


def batches(rows: DataFrame, size: int, order: list[Column]) -> DataFrame:
    """``batch`` of each row in a stated order: a list to be sent out, a bounded report."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size).cast("int"))


def words(texts: DataFrame, key: list[str], text: str, pattern: str) -> DataFrame:
    return texts.select(*key, F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(pattern), F.lit(0))).alias("term"))


def residual_count(rows: DataFrame, fields: list[str], script: str) -> DataFrame:
    """Cells that are still in source script, by field."""
    item = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return rows.select(item.alias("x")).groupBy("x.field").agg(F.count_if(F.col("x.value").rlike(f"[{script}]")).alias("cells"))


def host_profile(pages: DataFrame, host: str, page: str, order: str) -> DataFrame:
    """Pages of each host and the first of them; hosts of one page are marked."""
    return pages.groupBy(host).agg(F.count("*").alias("pages"), F.min_by(page, order).alias("first_page"), (F.count("*") == 1).alias("is_single"))


def top_pages(pages: DataFrame, host: str, score: str, tie: str, k: int = 3) -> DataFrame:
    order = Window.partitionBy(host).orderBy(F.desc(score), tie)
    return pages.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def systematic_sample(rows: DataFrame, order: str, most: int) -> DataFrame:
    """Every n-th row in order, n being rows div ``most``; at most ``most`` rows: a sample for people to read."""
    numbered = ranked(rows, order)
    step = F.broadcast(numbered.agg(F.greatest(F.lit(1), F.floor(F.count("*") / most)).cast("int").alias("_step")))  # one row
    picked = numbered.join(step).where("rank % _step = 0").withColumn("pick", (F.col("rank") / F.col("_step")).cast("int"))
    return picked.where(F.col("pick") < most).drop("rank", "_step")
