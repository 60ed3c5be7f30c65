"""Sharding by a Feistel permutation with cycle walking over global row numbers (DataFrame functions only).

Rows get a global number 0..n-1 that depends on their content alone: equal rows are counted, the distinct ones are
numbered inside hash buckets of bounded size by a window, and each bucket starts where the buckets before it end: these
starts are summed in groups of buckets, and the groups by themselves, so no sum spans all buckets.
A keyed Feistel network over Z_a x Z_b (a*b just above n) permutes the numbers; a value outside 0..n-1 is permuted
again until it falls inside (cycle walking). ``shard = permuted mod shards``, ``slot = permuted div shards``: row
counts of shards differ by one at most, slots have no gaps, and both can be computed from the row number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import expand_counted, read_table, text_or_empty

ROWS_PER_BUCKET = 50_000
BUCKETS_PER_GROUP = 4_096
ROUNDS = 6
#: a*b - n < a, so a walk leaves 0..n-1 with odds under 1/sqrt(n) a step.
WALKS = 64


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """The keyed permutation of 0..a*b-1: halves ``x div b`` in Z_a and ``x mod b`` in Z_b take turns."""
    start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    even = lambda s: F.struct(F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], s["i"], F.lit(seed)), F.lit(a)), F.lit(a)).alias("l"), s["r"].alias("r"))
    odd = lambda s: F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], s["i"], F.lit(seed)), F.lit(b)), F.lit(b)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        keyed = {"l": s["l"], "r": s["r"], "i": i}
        return F.when(i % 2 == 0, even(keyed)).otherwise(odd(keyed))

    out = F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)
    return out["l"] * F.lit(b) + out["r"]


def permuted(row_number: Column, n: int, seed: int = 0) -> Column:
    """Where row ``row_number`` of ``n`` stands after the shuffle; walks until the value is inside 0..n-1."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    once = feistel(row_number, a, b, seed)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once, lambda v, _: F.when(v < n, v).otherwise(feistel(v, a, b, seed)))
    value = F.when(once < n, once).otherwise(walked)
    return F.when(value < n, value).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def row_number_starts(rows: DataFrame, n: int) -> DataFrame:
    """The distinct rows of ``rows`` with ``_copies`` and ``_start``: their numbers of 0..n-1 are _start, _start + 1, ...

    The same rows get the same numbers, however they are partitioned. Only columns that hash and order are allowed. No
    window spans more than a bucket or a group of buckets, but the one over groups, which has a row for some 200 million
    rows. Buckets grow in number with the table.
    """
    cols = rows.columns
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    counted = rows.groupBy(*cols).agg(F.count("*").alias("_copies")).withColumn("_bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)))
    group = F.floor(F.col("_bucket") / F.lit(BUCKETS_PER_GROUP)).alias("_group")
    totals = counted.groupBy("_bucket", group).agg(F.sum("_copies").alias("_total"))
    before = lambda w: F.coalesce(F.sum("_total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = totals.groupBy("_group").agg(F.sum("_total").alias("_total")).select("_group", before(Window.orderBy("_group")).alias("_first"))
    near = totals.withColumn("_near", before(Window.partitionBy("_group").orderBy("_bucket")))
    offsets = near.join(groups, "_group").select("_bucket", (F.col("_first") + F.col("_near")).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(offsets, "_bucket")
    return placed.select(*cols, "_copies", (F.col("_offset") + F.col("_before")).alias("_start"))


def _narrow(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def _places(at: Column, shards: int) -> tuple[Column, Column]:
    return F.pmod(at, F.lit(shards)).cast("int").alias("shard"), F.floor(at / shards).cast("long").alias("slot")


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number of every row of ``docs``.

    Law ``rows``: counts of shards are at most one apart. Null text has size 1 and the checksum of the empty text; null
    ids are ordinary values; equal rows get numbers of their own; an empty table gives an empty result; other columns
    are ignored. Groups of equal texts are dealt like any other rows, so no group makes a shard larger.
    """
    n = docs.count()
    rows = expand_counted(row_number_starts(_narrow(docs), n), "_copies", "_copy").withColumn("row_number", F.col("_start") + F.col("_copy"))
    placed = rows.withColumn("_at", permuted(F.col("row_number"), n, seed))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), *_places(F.col("_at"), shards), F.lit(None).cast("int").alias("grown_shard"), "row_number")


def sharded_rows(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot``, as ``shard_documents`` deals them; columns of these names are replaced."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    n = docs.count()
    starts = row_number_starts(_narrow(docs), n).select(F.struct("doc_id", "size", "text_crc32").alias("__sh_k"), F.col("_start").alias("__sh_start"))
    text = text_or_empty()
    key = F.struct(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keyed = docs.withColumn("__sh_key", key)
    same = Window.partitionBy("__sh_key").orderBy(F.lit(0))
    joined = keyed.join(starts, F.col("__sh_key") == F.col("__sh_k"))
    placed = joined.withColumn("__sh_at", permuted(F.col("__sh_start") + F.row_number().over(same) - 1, n, seed))
    return placed.select(*[F.col(c) for c in kept], *_places(F.col("__sh_at"), shards))


def op8_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))
