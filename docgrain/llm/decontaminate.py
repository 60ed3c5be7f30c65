r"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Tokens are shingles of up to five words. One pass over the texts leaves, of all shingles of all documents, those that the
benchmark has: a sieve of bounded size (the slots that hashes of its shingles fall in) sifts them in the scan, an exact join
on the words follows. They are counted, and
the shingles of each window of the benchmark are ordered by rarity; the rarest one is its prefix (for exact containment the
necessary prefix is one token long), and a window with a shingle that no document has drops out. Occurrences of prefixes
are joined with their windows; where a window would stick out of its document the pair goes (positional and length bounds);
the other shingles that cover the window's words are then looked up at their places, which is exact containment.

No row carries a text, and nothing but the sieve is sent to all tasks by this code: joins are Spark's choice by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table, text_or_empty

WINDOW_WORDS = 10
SHINGLE = 5
#: What is not a word, before lower-casing: fixed by the definition of words, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after it.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The sieve has 16 slots of a byte a shingle between these bounds (at most 4 MB); beyond, it only sifts less.
LEAST_SLOTS, MOST_SLOTS = 1 << 14, 1 << 22


def words_of(text: Column) -> Column:
    """The words of a text as they are written; lower-case them to compare."""
    return F.array_remove(F.split(text, NOT_WORD), "")


def lowered(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """item (struct(id), so that a null id has a place), words: the windows of all items."""
    words = benchmark.select(F.struct(F.col("item_id").cast("string").alias("id")).alias("item"), F.transform(words_of(text_or_empty()), lowered).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words")).distinct()


def window_tables(benchmark: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """(window, item) of all items, and (window, length, offset, shingle): the shingles of each window, named by their words."""
    cut = materialize(benchmark_windows(benchmark, window).withColumn("window", F.array_join("words", " ")), "bench-windows")
    width = F.least(F.size("words"), F.lit(SHINGLE))
    offsets = F.sequence(F.lit(0), F.size("words") - width)
    shingles = cut.dropDuplicates(["window"]).select("window", F.size("words").alias("length"), "words", width.alias("width"), F.explode(offsets).alias("offset"))
    named = shingles.select("window", "length", "offset", F.array_join(F.slice("words", F.col("offset") + 1, F.col("width")), " ").alias("shingle"), "width")
    return cut.select("window", "item"), materialize(named, "bench-shingles")


def document_key() -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64(text_or_empty()).alias("h"))


def _word_hash(word: Column) -> Column:
    # Spark's lower() maps more letters than A-Z: it lets all matches pass and some more, and the join that follows is exact
    return F.xxhash64(F.lower(word))


def _sieve(shingles: DataFrame, slots: int) -> bytes:
    """One byte a slot, 1 where the hash of a shingle falls; the rows collected are strings of 1,024 slots."""
    hashes = F.transform(F.split("shingle", " "), _word_hash)
    token = F.lit(None).cast("long")
    for n in range(1, SHINGLE + 1):
        token = F.when(F.size("hashes") == n, F.xxhash64(*[F.get("hashes", F.lit(k)) for k in range(n)])).otherwise(token)
    held = shingles.select(hashes.alias("hashes")).select(F.pmod(token, F.lit(slots)).cast("long").alias("slot"), F.lit("1").alias("set")).distinct()
    every = held.sparkSession.range(slots).select(F.col("id").alias("slot"), F.lit("0").alias("set"))
    bits = held.unionByName(every).groupBy("slot").agg(F.max("set").alias("set"))
    parts = bits.groupBy(F.floor(F.col("slot") / 1024).alias("part")).agg(F.array_sort(F.collect_list(F.struct("slot", "set"))).alias("bits"))
    rows = parts.select("part", F.array_join("bits.set", "").alias("bits")).collect()
    return "".join(r.bits for r in sorted(rows, key=lambda r: r.part)).encode()


def _tokens(n: int) -> Column:
    """The hash of each run of ``n`` words."""
    starts = F.when(F.col("n_words") >= n, F.sequence(F.lit(0), F.col("n_words") - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(n)]))


def _places(n: int, sieve: bytes) -> Column:
    """(pos, shingle) of the runs of ``n`` words that the sieve lets pass."""

    def place(token: Column, i: Column) -> Column:
        slot = F.pmod(token, F.lit(len(sieve))).cast("int")
        return F.when(F.substr(F.lit(sieve), slot + 1, F.lit(1)) == F.lit(b"1"), i + 1)

    passed = F.array_compact(F.transform(f"t{n}", place))
    return F.transform(passed, lambda i: F.struct(i.cast("int").alias("pos"), lowered(F.array_join(F.slice("words", i, n), " ")).alias("shingle")))


def benchmark_occurrences(docs: DataFrame, shingles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, n_words) of every row, and (key, n_words, pos, shingle): where documents have a shingle of the benchmark.

    Positions count words from 1. One scan makes both; it leaves the places of shingles that the sieve lets pass.
    """
    distinct = materialize(shingles.select("shingle", "width").distinct(), "bench-distinct")
    widths = {r.width: r.n for r in distinct.groupBy("width").agg(F.count("*").alias("n")).collect()}
    sieve = _sieve(distinct, min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (16 * sum(widths.values())).bit_length())))
    split = docs.select(document_key().alias("key"), words_of(text_or_empty()).alias("words"))
    hashed = split.select("key", F.size("words").alias("n_words"), "words", F.transform("words", _word_hash).alias("hashes"))
    found = [F.array().cast("array<struct<pos:int,shingle:string>>")]
    for n in sorted(widths):  # a handful: items shorter than a shingle are windows of their own length
        hashed = hashed.withColumn(f"t{n}", _tokens(n))
        found.append(_places(n, sieve))
    sifted = materialize(hashed.select("key", "n_words", F.concat(*found).alias("found")), "bench-sifted")
    met = sifted.select("key", "n_words", F.explode("found").alias("f")).select("key", "n_words", "f.pos", "f.shingle")
    return sifted.select("key", "n_words"), materialize(met.join(distinct.select("shingle"), "shingle").select("key", "n_words", "pos", "shingle").distinct(), "bench-occurrences")


def find_windows(occurrences: DataFrame, shingles: DataFrame) -> DataFrame:
    """key, start, stop (word positions, stop exclusive), window: all occurrences of windows in documents."""
    rarity = occurrences.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = shingles.join(rarity, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    needed = F.array_agg(F.when((F.col("offset") % SHINGLE == 0) | (F.col("offset") == F.col("length") - F.col("width")), F.struct("offset", "shingle")))
    prefix = ranked.groupBy("window", "length").agg(F.min(F.struct("n", "shingle", "offset")).alias("p"), F.array_compact(needed).alias("needed"))
    prefix = materialize(prefix.where("p.n > 0").select("window", "length", F.col("p.shingle").alias("shingle"), F.col("p.offset").alias("offset"), "needed"), "bench-prefixes")
    start = F.col("pos") - F.col("offset")
    inside = (start >= 1) & (start + F.col("length") - 1 <= F.col("n_words"))
    pairs = occurrences.join(prefix, "shingle").where(inside)
    checks = pairs.select("key", start.alias("start"), (start + F.col("length")).alias("stop"), "window", F.size("needed").alias("wanted"), F.explode("needed").alias("c"))
    checks = checks.select("key", "start", "stop", "window", "wanted", (F.col("start") + F.col("c.offset")).alias("pos"), F.col("c.shingle").alias("shingle"))
    held = checks.join(occurrences.select("key", "pos", "shingle"), ["key", "pos", "shingle"])
    whole = held.groupBy("key", "start", "stop", "window", "wanted").agg(F.count("*").alias("n"))
    return whole.where("n = wanted").select("key", "start", "stop", "window")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """(key, n_words) of every row, and key, n_hit, n_items, items_sha256 of the documents in which some window occurs.

    Hit words are counted by merging the occurrences from left to right, so long documents need no array of positions.
    """
    items_of, shingles = window_tables(benchmark, window)
    rows, occurrences = benchmark_occurrences(docs, shingles)
    found = materialize(find_windows(occurrences, shingles), "bench-found")
    before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("key", "start", "stop").distinct()
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))))
    hits = spans.withColumn("new", new).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    items = found.select("key", "window").distinct().join(items_of, "window").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    named = items.select("key", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items.id", ","), 256).alias("items_sha256"))
    return rows, hits.join(named, "key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    Null texts have no words; null ids are ordinary values (items without an id count as one item, which the
    digest of names leaves out); equal rows get equal
    results; without a benchmark nothing is hit; an empty table gives an empty result; other columns are ignored.
    """
    rows, hits = contamination(docs, benchmark, window)
    out = rows.select("key", F.col("n_words").cast("long").alias("n_words")).join(hits, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("key.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs; columns unchanged."""
    _, hits = contamination(docs, benchmark, window)
    hits = hits.select(F.col("key.doc_id").alias("__dc_d"), F.col("key.h").alias("__dc_h"))
    on = F.col("doc_id").eqNullSafe(F.col("__dc_d")) & (F.xxhash64(text_or_empty()) == F.col("__dc_h"))
    return docs.join(hits, on, "left_anti")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS s, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
cut AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM pos, lens WHERE i + n - 1 <= len(w)),
hit AS (SELECT cut.r, cut.i, win.n, win.item_id FROM cut JOIN win ON cut.s = win.s AND cut.n = win.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
