"""Suffix-array dedup of passages: longest-previous-factor lengths decide which bytes repeat.

A byte goes if a string of ``least`` bytes over it occurs elsewhere. In suffix order down to that depth, suffixes that
share their first ``least`` bytes stand together in order of position; the previous smaller position of a suffix there is
its earlier match, and its longest previous factor reaches ``least`` just if it has one (the next smaller position only
matters for matches that are shorter). So what has to be known of each position is the class of its ``least``-byte prefix,
the size of the class and its first member.

Classes are found without sorting all positions. Starts of strings are dealt to anchors that depend on nearby bytes alone
(the least hash of the first k-grams), so equal strings have equal anchors at equal offsets. A run of starts with one
anchor is settled as a whole where it can be: no class has two members if what all its strings share around the anchor is
unique, and all have if the bytes of the whole run occur elsewhere. What is left, the ends of repeated passages, is split
to cells of 16 starts and then to single starts. Class sizes and first members are summed up before each shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table, text_or_empty
from docgrain.llm.textblocks import Block, Rolling, blocks

LEAST = 400
GRAM, CELL = 16, 16
_INDEX = np.uint64((1 << 28) - 1)
RUN = "doc_id long, h long, anchor int, lo int, hi int, core long, whole binary"


def _anchors(block: Block, least: int) -> tuple[Rolling, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Runs of starts with one anchor: (hashes, text, anchor, first start, last start), positions in the block."""
    width = _width(least)
    n = len(block.data)
    if n < least:
        return None
    hashes = Rolling(block.data)
    at = np.arange(n - GRAM + 1)
    tagged = (hashes.of(at, at + GRAM) & ~_INDEX) | at.astype(np.uint64)
    m = len(tagged) - width + 1
    rows = np.concatenate([tagged, np.full(-len(tagged) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:m]
    least_of = np.minimum(ahead, np.minimum.accumulate(rows, axis=1).ravel()[width - 1 : width - 1 + m])
    whole = np.zeros(n + 1, np.int32)  # starts whose string ends in the same text
    fits = block.sizes >= least
    np.add.at(whole, block.at[:-1][fits], 1)
    np.add.at(whole, block.at[1:][fits] - least + 1, -1)
    start = np.flatnonzero(np.cumsum(whole)[:m])
    if not len(start):
        return None
    anchor = (least_of[start] & _INDEX).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]
    first = np.flatnonzero(new)
    lo, hi = start[first], start[np.r_[first[1:], len(start)] - 1]
    return hashes, np.searchsorted(block.at, lo, side="right") - 1, anchor[first], lo, hi


def _width(least: int) -> int:
    return max(1, min(256, least * 5 // 8) - GRAM + 1)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _runs(docs: DataFrame, least: int) -> DataFrame:
    """The runs of all documents; ``core`` hashes what their strings share, ``whole`` the bytes of the run."""
    width = _width(least)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, limit=1 << 19):
                found = _anchors(block, least)
                if not found:
                    continue
                hashes, text, anchor, lo, hi = found
                core = hashes.of(anchor, anchor + least - width + 1).view(np.int64)
                raw = memoryview(np.ascontiguousarray(block.data))
                whole = [_digest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + least).tolist())]
                ids = [batch.column(k).slice(block.first, block.n).take(pa.array(text)) for k in (0, 1)]
                own = block.at[text]
                cols = [pa.array((x - own).astype(np.int32)) for x in (anchor, lo, hi)]
                yield pa.RecordBatch.from_arrays([*ids, *cols, pa.array(core), pa.array(whole, pa.binary())], ["doc_id", "h", "anchor", "lo", "hi", "core", "whole"])

    return _keyed(docs).mapInArrow(of, RUN)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _settle(rows: DataFrame, keep_first: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled rows whose strings all go, rows to split: those still open and one partner for each content)."""
    own = F.struct("doc_id", "h", "lo")
    # the classes are written before they are joined: so both sides of the join have a shuffle of their own, and one core
    # that a third of all rows have is split among tasks
    core = rows.groupBy("core").agg(F.count("*").alias("n_core"), F.max("open").alias("wanted"), *([F.min(own).alias("first_core")] if keep_first else []))
    core = materialize(core.where("n_core > 1 AND wanted").drop("wanted"), f"{name}-cores")
    live = materialize(rows.join(core, "core"), f"{name}-live")
    whole = materialize(live.groupBy("whole").agg(F.count("*").alias("n_whole"), F.min(own).alias("first_whole")), f"{name}-wholes")
    seen = live.join(whole, "whole")
    leads = own == F.col("first_whole")
    goes = ~leads if keep_first else F.col("n_whole") > 1
    possible = own != F.col("first_core") if keep_first else F.lit(True)
    seen = seen.withColumn("goes", F.col("open") & goes).withColumn("left", F.col("open") & ~goes & possible).withColumn("leads", leads)
    seen = materialize(seen.select("doc_id", "h", "anchor", "lo", "hi", "core", "goes", "left", "leads"), f"{name}-seen")
    cores = seen.where("left").select("core").distinct()
    split = seen.where("left OR leads").join(cores, "core", "left_semi").select("doc_id", "h", "anchor", "lo", "hi", F.col("left").alias("open"))
    return seen.where("goes").select("doc_id", "h", "lo", "hi"), split


def _snippets(docs: DataFrame, split: DataFrame, least: int) -> DataFrame:
    """The rows to split with their bytes."""
    per = split.groupBy("doc_id", "h").agg(F.array_distinct(F.collect_list(F.struct("anchor", "lo", "hi", "open"))).alias("runs"))
    keyed, per = _keyed(docs), per.withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    texts = keyed.join(per, keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["h"] == F.col("_h"))).select("doc_id", "h", F.encode("text", "UTF-8").alias("text"), "runs")
    cut = texts.select("doc_id", "h", "text", F.explode("runs").alias("r"))
    return cut.select("doc_id", "h", "r.*", F.substr(F.col("text"), F.col("r.lo") + 1, F.col("r.hi") - F.col("r.lo") + F.lit(least)).alias("data"))


def _cells(snippets: DataFrame, least: int) -> DataFrame:
    """Each run cut to cells of starts at fixed distances from the anchor."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchor, los, his, core, whole = [], [], [], [], [], []
            cols = [batch.column(k).to_pylist() for k in (2, 3, 4, 6)]
            for i, (a, lo, hi, data) in enumerate(zip(*cols)):
                for g in range((a - hi) // CELL, (a - lo) // CELL + 1):
                    top = a - CELL * g
                    first, last = max(lo, top - CELL + 1), min(hi, top)
                    rows.append(i)
                    anchor.append(a)
                    los.append(first)
                    his.append(last)
                    shared = hashlib.blake2b(data[top - lo : top - CELL + 1 - lo + least], digest_size=8, salt=g.to_bytes(4, "little")).digest()
                    core.append(int.from_bytes(shared, "little", signed=True))
                    whole.append(_digest(data[first - lo : last - lo + least]))
            take = pa.array(rows, pa.int32())
            ints = [pa.array(x, pa.int32()) for x in (anchor, los, his)]
            ids = [batch.column(k).take(take) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, *ints, batch.column(5).take(take), pa.array(core, pa.int64()), pa.array(whole, pa.binary())], ["doc_id", "h", "anchor", "lo", "hi", "open", "core", "whole"])

    return snippets.mapInArrow(of, "doc_id long, h long, anchor int, lo int, hi int, open boolean, core long, whole binary")


def _singles(snippets: DataFrame, split: DataFrame, least: int) -> DataFrame:
    """Each start of the cells to split, with the digest of its string."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, start, whole = [], [], []
            for i, (base, lo, hi, data) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 6)))):
                for p in range(lo, hi + 1):
                    rows.append(i)
                    start.append(p)
                    whole.append(_digest(data[p - base : p - base + least]))
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in (0, 1, 5)), pa.array(start, pa.int32()), pa.array(whole, pa.binary())], ["doc_id", "h", "open", "lo", "whole"])

    names = {"doc_id": "_d", "h": "_h", "anchor": "_a", "lo": "first", "hi": "last", "open": "wanted"}
    on = snippets["doc_id"].eqNullSafe(F.col("_d")) & (snippets["h"] == F.col("_h")) & (snippets["anchor"] == F.col("_a")) & F.col("first").between(snippets["lo"], snippets["hi"])
    met = snippets.join(split.withColumnsRenamed(names), on).select("doc_id", "h", "lo", "first", "last", "wanted", "data")
    return met.mapInArrow(of, "doc_id long, h long, open boolean, lo int, whole binary")


def repeated_spans(docs: DataFrame, least: int = LEAST, keep_first: bool = False) -> DataFrame:
    """doc_id, h, spans: byte ranges (start, stop; they may overlap) over which a string of ``least`` bytes occurs elsewhere.

    With ``keep_first`` only strings that have an earlier occurrence count, in order of doc_id, hash of the text and position.
    """
    runs = materialize(_runs(docs, least), "sub-runs").withColumn("open", F.lit(True))
    goes, split = _settle(runs, keep_first, "sub-runs")
    snippets = materialize(_snippets(docs, split, least), "sub-snippets")
    cells_go, split = _settle(_cells(snippets, least), keep_first, "sub-cells")
    singles = materialize(_singles(snippets, split, least), "sub-singles")
    own = F.struct("doc_id", "h", "lo")
    classes = singles.groupBy("whole").agg(F.count("*").alias("n"), F.min(own).alias("first"))
    repeats = own != F.col("first") if keep_first else F.col("n") > 1
    singles_go = singles.where("open").join(classes, "whole").where(repeats).select("doc_id", "h", "lo", F.col("lo").alias("hi"))
    spans = goes.unionByName(cells_go).unionByName(singles_go)
    span = F.struct(F.col("lo").alias("start"), (F.col("hi") + least).alias("stop"))
    return spans.groupBy("doc_id", "h").agg(F.collect_set(span).alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["start"], s["stop"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def dedup_substrings(docs: DataFrame, least: int = LEAST, keep_first: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``.

    Null texts are empty; null ids are ordinary values; without ``keep_first`` equal rows are copies of each other, with it
    they count as one document; texts below ``least`` bytes stay; an empty table gives an empty result; other columns are
    ignored. A removed run may end inside a character: lengths and digests are those of bytes.
    """
    spans = repeated_spans(docs, least, keep_first).withColumnsRenamed({"doc_id": "_d", "h": "_h"})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, digest, size = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                merged = _merged(runs) if runs else []
                kept, at = hashlib.sha256(), 0
                for start, stop in merged:
                    kept.update(data[at:start])
                    at = stop
                kept.update(data[at:])
                size.append(len(data))
                removed.append(sum(e - s for s, e in merged))
                count.append(len(merged))
                digest.append(kept.hexdigest())
            longs = [pa.array(x, pa.int64()) for x in (size, removed, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    keyed = _keyed(docs)
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["h"] == F.col("_h")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(of, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents"))


#: Every window of 400 bytes by its digest; slow on large tables (some 25 s for 1,000 documents).
OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT *, length(h) // 2 AS n FROM d),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS m FROM (SELECT r, h, unnest(range(0, greatest(n - 399, 0))) AS i FROM n)),
s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
b AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM s),
g AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM b),
spans AS (SELECT r, min(i) AS a, max(i) + 400 AS z FROM g GROUP BY r, k),
gaps AS (SELECT r, coalesce(lag(z) OVER o, 0) AS a, a AS z FROM spans WINDOW o AS (PARTITION BY r ORDER BY a) UNION ALL SELECT n.r, coalesce(max(spans.z), 0), any_value(n.n) FROM n LEFT JOIN spans ON n.r = spans.r GROUP BY n.r),
kept AS (SELECT gaps.r, string_agg(substr(h, 2 * gaps.a + 1, 2 * (gaps.z - gaps.a)), '' ORDER BY gaps.a) AS h FROM gaps JOIN n ON n.r = gaps.r GROUP BY gaps.r),
told AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM n JOIN kept ON kept.r = n.r LEFT JOIN told ON told.r = n.r
"""
