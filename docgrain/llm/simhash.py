"""SimHash near-dedup by Golay-code fuzzy hashing.

A fingerprint of 64 bits falls into three segments of at most 23 bits. The binary Golay code of length 23 is perfect: each
word of 23 bits lies within 3 bits of exactly one codeword, its home, and a word at 3 bits from its home lies at 4 bits
from five more. A segment's keys are the indices of these one or six codewords. Of two segments that differ in one bit at
most, each has the other's home among its keys, as one bit moves a word from 3 to 4 bits at most.

Pigeonhole: where two fingerprints differ in 3 bits at most, either some segment is equal and another differs in one bit at
most, or each of the three differs in exactly one bit, and then one half of the last segment is equal. So a pair meets under
the bits of an equal segment with a Golay key of another (six choices), or under Golay keys of the first two segments with
a half of the last (two choices). A fingerprint is filed under its homes, 8 rows, and sought under its keys, 88 or so; some
34 bits of key leave few strangers together, and every pair that meets is compared.

Rows of one key with few homes are joined. Where more than ``FEW_HOMES`` fingerprints share a home, as in a large group of
near copies, the rows are dealt into blocks, every block of homes meets every block of seekers, and a block pair returns
what is connected in it as a star, so that links are never listed pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table, text_or_empty
from docgrain.llm.components import connected_components

WIDTH, SEED, BITS = 3, 42, 3
#: First bit and width of each segment; the last one's halves likewise.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALVES = ((43, 10), (53, 11))
#: Generator polynomial of the Golay code; a fixed value.
GENERATOR = 0b101011100011
FEW_HOMES, BLOCK = 64, 4096
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The SimHash of a whole text: each bit that more than half of the shingles' hashes have. No words: zero."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z alone, and white space as x09-x0D and x20
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    stops = starts[min(width, len(words)) :]
    ones = np.zeros(64, np.int64)
    for first in range(0, n, HASHES_AT_ONCE):
        spans = zip(starts[first : min(n, first + HASHES_AT_ONCE)], stops[first : first + HASHES_AT_ONCE])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """The rest by the generator of each 12 high bits, and the errors of each syndrome: its own one, then those of weight 4."""
    high = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        high ^= np.where(high >> bit & 1, GENERATOR << (bit - 11), 0)
    errors, held = np.full((1 << 11, 6), -1, np.int64), np.zeros(1 << 11, int)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            syndrome = int(high[error >> 11]) ^ (error & 0x7FF)
            errors[syndrome, held[syndrome]] = error
            held[syndrome] += 1
    return high, errors


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of words of 23 bits, six columns, the home first; -1 where there is none."""
    high, errors = golay_tables()
    found = errors[high[words >> 11] ^ (words & 0x7FF)]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> 11)


def _field(prints: np.ndarray, at: tuple[int, int]) -> np.ndarray:
    return (prints >> np.uint64(at[0])).astype(np.int64) & ((1 << at[1]) - 1)


def print_keys(prints: np.ndarray, homes: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, and for each the place of its fingerprint: only homes, or all codewords nearby."""
    golay = [golay_keys(_field(prints, s))[:, : 1 if homes else None] for s in SEGMENTS]
    parts = []
    for i, s in enumerate(SEGMENTS):
        for j, near in enumerate(golay):
            if i != j:
                parts.append(np.where(near < 0, -1, _field(prints, s)[:, None] << 12 | near))
    both = np.where((golay[0] < 0)[:, :, None] | (golay[1] < 0)[:, None, :], -1, golay[0][:, :, None] << 12 | golay[1][:, None, :]).reshape(len(prints), -1)
    parts += [np.where(both < 0, -1, _field(prints, half)[:, None] << 24 | both) for half in HALVES]
    keys = np.concatenate([np.where(p < 0, -1, family << 40 | p) for family, p in enumerate(parts)], axis=1)
    at = np.nonzero(keys >= 0)
    return keys[at], at[0]


def _keyed(prints: DataFrame, homes: bool) -> DataFrame:
    """key, print: the rows under which fingerprints are filed, or sought."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for first in range(0, len(values), BLOCK):
                some = values[first : first + BLOCK]
                keys, at = print_keys(some.view(np.uint64), homes)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(some[at])], ["key", "print"])

    return prints.select("print").mapInArrow(of, "key long, print long")


def _stars(homes: pd.DataFrame, seekers: pd.DataFrame) -> pd.DataFrame:
    """a, b: each fingerprint of a block pair that has a link there, with the least one of those it is connected with."""
    h, s = (np.sort(x["print"].to_numpy().view(np.uint64)) for x in (homes, seekers))
    if not len(h) or not len(s):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    near = np.empty((len(s), len(h)), bool)
    for first in range(0, len(s), 512):
        near[first : first + 512] = np.bitwise_count(s[first : first + 512, None] ^ h[None, :]) <= BITS
    none = len(h)
    label, joined = np.arange(len(h)), near.any(0)
    while True:
        of_s = np.concatenate([np.where(near[f : f + 512], label[None, :], none).min(1) for f in range(0, len(s), 512)])
        new = np.minimum(label, np.min([np.where(near[f : f + 512], of_s[f : f + 512, None], none).min(0) for f in range(0, len(s), 512)], axis=0))
        if (new == label).all():
            break
        label = new
    a = np.concatenate([h[joined], s[of_s < none]])
    b = np.concatenate([h[label[joined]], h[of_s[of_s < none]]])
    apart = a != b
    return pd.DataFrame({"a": a[apart].view(np.int64), "b": b[apart].view(np.int64)})


def _dense_links(homes: DataFrame, seekers: DataFrame, dense: DataFrame) -> DataFrame:
    """a, b: what is connected under the keys ``dense`` (key, n_h homes)."""
    sought = materialize(seekers.join(dense, "key").select("key", "print"), "simhash-sought")  # keys are made anew in each use
    sizes = sought.groupBy("key").agg(F.count("*").alias("n_s"))
    parts = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    plan = materialize(dense.join(sizes, "key").select("key", parts("n_h").alias("p_h"), parts("n_s").alias("p_s")), "simhash-dense")

    def spread(df: DataFrame, own: str, other: str, a: str, b: str) -> DataFrame:
        dealt = df.join(plan, "key").withColumn(a, F.pmod(F.xxhash64("print"), F.col(own)).cast("int"))
        return dealt.withColumn(b, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("key", "h", "s", "print")

    block = ["key", "h", "s"]
    left, right = spread(homes, "p_h", "p_s", "h", "s"), spread(sought, "p_s", "p_h", "s", "h")
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(lambda x, y: _stars(x, y), "a long, b long")


def linked_prints(prints: DataFrame) -> DataFrame:
    """a, b: edges that connect different fingerprints (``print``, each once) as links of at most ``BITS`` bits do."""
    homes, seekers = _keyed(prints, True), _keyed(prints, False)
    dense = materialize(homes.groupBy("key").agg(F.count("*").alias("n_h")).where(F.col("n_h") > FEW_HOMES), "simhash-keys")
    some = not dense.isEmpty()
    few = homes.join(dense, "key", "left_anti") if some else homes
    met = seekers.join(few.withColumnRenamed("print", "home"), "key")
    links = met.where((F.col("print") != F.col("home")) & (F.bit_count(F.col("print").bitwiseXOR(F.col("home"))) <= BITS)).select(F.col("print").alias("a"), F.col("home").alias("b"))
    return links.unionByName(_dense_links(homes, seekers, dense)) if some else links


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (its 64 bits as a long) of every row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(of, "doc_id long, print long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs``.

    Texts are taken whole. Null, empty and blank texts have fingerprint zero and are linked like any other; equal rows stay
    and share a component; the component is the least id among its rows, null where none has one; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = materialize(fingerprints(docs), "simhash-prints")
    firsts = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = connected_components(linked_prints(firsts)).withColumnRenamed("node", "print")
    of = materialize(firsts.join(labels, "print", "left").select("print", "first", F.coalesce("label", "print").alias("label")), "simhash-labels")
    least = of.groupBy("label").agg(F.min("first").alias("component_id"))
    named = of.join(least, "label").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
