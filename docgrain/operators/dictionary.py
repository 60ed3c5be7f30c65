"""Dictionaries as tables: an inverted index on the first characters of terms meets the places of texts.

Terms are a table however many they are, and no literal of a plan. Each term is filed under its first ``KEY`` bytes. All
places of a text are looked up, as vectors over Arrow batches, in a table of the lengths of terms by their first ``PREFIX``
bytes, then in a sieve of the first ``HEAD`` bytes and, for each length that is left, in a sieve of whole keys of that length.
The bytes that pass are joined with the terms by equality, so a text is searched again only for terms longer than a key. The
sieves grow with the dictionary up to 8 and 32 MB, which hold some ten million terms well; beyond that more places pass, and
the join with the terms sorts them out. A task holds what it found in a few MB of texts, however large the dictionary is.

A dictionary of a measured size below ``BROADCAST_BYTES`` is sent to the tasks, so texts are matched where they are read. Of a
larger one the terms whose keys were met in texts are picked out first, by a sieve of those keys, so that it is never shuffled
whole. The most frequent of them, as many as may be broadcast, are sent to the tasks; what was met of the others is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgrain.functions import domain
from docgrain.functions.text import CJK, clean, clean_literal, sentence_around, strip
from docgrain.sources.stages import stage

HEAD = 7
KEY = 64
LEAST_BITS, MOST_HEAD_BITS, MOST_BITS = 20, 26, 28
#: Lengths of terms are listed by so many first bytes, in a table of 2^PREFIX_BITS words with a bit a length.
PREFIX, PREFIX_BITS = 4, 18
#: Places in the sieve of whole keys for a term, and the least for a length.
PLACES, LEAST_PLACES = 64, 1 << 16
#: Words of a sieve that go in one row.
CHUNK = 1 << 10
#: Sieves of heads up to this size are looked up a byte a place, larger ones a bit a place.
UNPACKED_BITS = 23
SLICE = 1 << 18
BROADCAST_BYTES = 16 << 20
#: Keys are hashed as polynomials at an odd number, modulo 2^64, so that prefix sums give the hash of every stretch.
BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _head_bit(head: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The place in the sieve of heads of ``n`` bytes, given as numbers."""
    return ((head | n << 8 * HEAD).astype(np.uint64) * np.uint64(BASE) >> np.uint64(64 - bits)).astype(np.int64)


def _key_bits(h: np.ndarray, places: int) -> list[np.ndarray]:
    """The two places out of so many, up to 2^32, of keys with these hashes."""
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return [((x >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64) for x in (mixed, (mixed ^ (mixed >> np.uint64(32))) * np.uint64(BASE))]


def _length_bits(sizes: list[int]) -> np.int64:
    return np.bitwise_or.reduce(np.left_shift(np.int64(1), np.array(sizes, np.int64) - 1), initial=np.int64(0))


def _held(words: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (words[bit >> 6] >> (bit & 63)) & 1 == 1


def _raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of large strings or binaries."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    held = values.buffers()[2]
    return np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8), offsets


def _by_size(keys: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of keys: the length, where its keys are, their bytes and their hashes."""
    power = _powers(BASE, KEY)
    raw, offsets = _raw(keys.cast(pa.large_binary()))
    size = np.diff(offsets)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        part = raw[offsets[at][:, None] + np.arange(n)]
        yield n, at, part, ((part.astype(np.uint64) + np.uint64(1)) * power[:n]).sum(axis=1, dtype=np.uint64)


def _sieve_rows(head_bits: int, bits: int, regions: dict[int, tuple[int, int]] | None = None):
    """For mapInArrow over keys: (kind, word, bits) of kind 0 for heads, 1 for whole keys, 2 for the lengths of keys by their
    first bytes. ``regions``: the first place and the places that keys of a length have in the sieve of whole keys, else all
    have the same 2^bits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, _, part, hashed in _by_size(batch.column(0)):
                first, places = regions[n] if regions else (0, 1 << bits)
                head = prefix = np.zeros(len(part), np.int64)
                for j in range(min(n, HEAD)):
                    head = head << 8 | part[:, j]
                    prefix = head if j < PREFIX else prefix
                at = [_head_bit(head, min(n, HEAD), head_bits), first + np.concatenate(_key_bits(hashed, places)), np.unique(_head_bit(prefix, min(n, PREFIX), PREFIX_BITS)) << 6 | n - 1]
                kind, bit = np.repeat([0, 1, 2], [len(a) for a in at]), np.concatenate(at)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int8()), pa.array(bit >> 6, pa.int32()), pa.array(np.left_shift(np.int64(1), bit & 63), pa.int64())], ["kind", "word", "bits"])

    return of


def _sieve_parts(words: list[int], head_bits: int, regions: dict[int, tuple[int, int]]):
    """For mapInArrow over keys: (kind, chunk, packed), what the keys of a task put into each sieve, of so many words, in packed
    chunks. A task holds its sieves, not the rows of its keys."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(n, np.int64) for n in words]
        for batch in _sieve_rows(head_bits, 0, regions)(batches):
            kind, word, value = (c.to_numpy() for c in batch.columns)
            for k, sieve in enumerate(held):
                np.bitwise_or.at(sieve, word[kind == k], value[kind == k])
        for k, sieve in enumerate(held):
            starts = np.arange(0, len(sieve), CHUNK)
            full = starts[np.bitwise_or.reduceat(sieve, starts) != 0].tolist()
            yield _chunk_rows([(k, i // CHUNK, sieve[i : i + CHUNK]) for i in full])

    return of


def _sieve_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over chunks that lie together by kind and number: each once."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = np.frombuffer(zlib.decompress(packed), np.int64)
            held[kind, chunk] = held[kind, chunk] | words if (kind, chunk) in held else words
    yield _chunk_rows([(*k, words) for k, words in held.items()])


def _chunk_rows(chunks: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array([c[0] for c in chunks], pa.int8()), pa.array([c[1] for c in chunks], pa.int32()), pa.array([zlib.compress(c[2].tobytes(), 1) for c in chunks], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "chunk", "packed"])


class Sieve(NamedTuple):
    """Words of 64 bits of the sieves of heads and of whole keys, lengths of keys by their first bytes (a bit a length), and the
    places of each length in the sieve of whole keys."""

    head: np.ndarray
    whole: np.ndarray
    prefixes: np.ndarray
    regions: dict[int, tuple[int, int]]


def _sieve(keys: DataFrame, sizes: dict[int, int]) -> Sieve:
    """The sieve of a table of keys; ``sizes`` says how many there are of each length. What comes to the driver are the sieves
    in packed chunks, 43 MB at most, as ``MOST_BITS`` and ``MOST_HEAD_BITS`` bound them."""
    n = sum(sizes.values())
    head_bits = min(MOST_HEAD_BITS, max(LEAST_BITS, (32 * n).bit_length()))
    regions, end = {}, 0
    for size, count in sorted(sizes.items()):
        regions[size] = end, max(LEAST_PLACES, min(PLACES * count, (count << MOST_BITS) // n))
        end += regions[size][1] + 63 & ~63
    words = [1 << head_bits - 6, max(1, end >> 6), 1 << PREFIX_BITS]
    schema = "kind byte, chunk int, packed binary"
    parts = keys.mapInArrow(_sieve_parts(words, head_bits, regions), schema).repartition("kind", "chunk").mapInArrow(_sieve_merged, schema).toArrow()
    held = [np.zeros(n, np.int64) for n in words]
    for kind, chunk, packed in zip(*(parts.column(c).to_pylist() for c in ("kind", "chunk", "packed")), strict=True):
        got = np.frombuffer(zlib.decompress(packed), np.int64)
        held[kind][chunk * CHUNK : chunk * CHUNK + len(got)] = got
    return Sieve(*held, regions)


def _passing(rows: DataFrame, sieve: Sieve) -> DataFrame:
    """The rows whose ``_key`` passes the sieve of whole keys."""
    column, (_, whole, _, regions) = rows.columns.index("_key"), sieve

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.zeros(batch.num_rows, bool)
            for n, at, _, hashed in _by_size(batch.column(column)):
                if n in regions:
                    one, two = _key_bits(hashed, regions[n][1])
                    held[at] = _held(whole, regions[n][0] + one) & _held(whole, regions[n][0] + two)
            yield batch.filter(pa.array(held))

    return rows.mapInArrow(of, rows.schema)


def _once(owner: np.ndarray, what: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each pair of text and bytes once, in order of texts."""
    coded = what.dictionary_encode()
    pair = np.unique(owner * len(coded.dictionary) + coded.indices.to_numpy())
    return pair // max(1, len(coded.dictionary)), coded.dictionary.take(pa.array(pair % max(1, len(coded.dictionary)), pa.int64()))


def _keys_in(raw: np.ndarray, offsets: np.ndarray, in_heads: Callable, head_bits: int, whole: np.ndarray, lengths: list[int], power: np.ndarray, inverse: np.ndarray, regions: dict[int, tuple[int, int]] | None = None, prefixes: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array]:
    """The text and the bytes, each pair once and in order of texts, that pass all sieves; text i is offsets[i] to
    offsets[i+1]. Bytes are taken in slices, with what a key may need beyond, so long texts need no more memory. Without
    ``regions`` keys of all lengths share the sieve, without ``prefixes`` any may stand anywhere."""
    regions = regions or dict.fromkeys(lengths, (0, len(whole) << 6))
    prefixes = np.full(2, -1, np.int64) if prefixes is None else prefixes
    owners, found = [np.zeros(0, np.int64)], [pa.array([], pa.binary())]
    for first in range(int(offsets[0]), int(offsets[-1]), SLICE):
        data = raw[first : min(first + SLICE + KEY - 1, int(offsets[-1]))]
        wide, head = data.astype(np.int64), np.zeros(len(data), np.int64)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        for n in range(1, min(HEAD, len(data), max(lengths, default=0)) + 1):
            head = head[: len(wide) - n + 1] << 8 | wide[n - 1 :]
            begun, sized = ([x for x in lengths if min(x, most) == n] for most in (PREFIX, HEAD))
            if begun:
                may = prefixes[_head_bit(head[:SLICE], n, len(prefixes).bit_length() - 1)] & _length_bits(begun)
                near = np.flatnonzero(may)
                may = may[near]
            if not sized:
                continue
            here = np.flatnonzero((may & _length_bits(sized) != 0) & (near < len(head)))
            here = here[in_heads(_head_bit(head[near[here]], n, head_bits))]
            here, sizes = near[here], may[here]
            for size in sized:
                at = here[(sizes >> size - 1 & 1 == 1) & (here + size <= len(data))]
                start, places = regions[size]
                one, two = _key_bits((sums[at + size] - sums[at]) * inverse[at], places)
                once = _held(whole, start + one)
                at = at[once][_held(whole, start + two[once])]
                owner = np.searchsorted(offsets, at + first, side="right") - 1
                inside = at + first + size <= offsets[owner + 1]
                at, owner = at[inside], owner[inside]
                if len(at):
                    same = pa.Array.from_buffers(pa.binary(size), len(at), [None, pa.py_buffer(np.ascontiguousarray(data[at[:, None] + np.arange(size)]))])
                    owner, same = _once(owner, same)
                    owners.append(owner)
                    found.append(same.cast(pa.binary()))
    return _once(np.concatenate(owners), pa.concat_arrays(found))


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last row of runs of texts that together have some ``SLICE`` bytes, a longer text alone."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
        yield first, last
        first = last


def _with_keys(texts: DataFrame, text: str, sieve: Sieve, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``texts`` with the bytes of each text that may be a key of a term. Rows go back a few MB of
    texts at a time, so what a task holds does not grow with what it finds in a batch."""
    column, (head, whole, prefixes, regions) = texts.columns.index(text), sieve
    places, head_bits = [texts.columns.index(c) for c in kept], len(head).bit_length() + 5

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if head_bits <= UNPACKED_BITS:
            in_heads = np.unpackbits(head.view(np.uint8), bitorder="little").astype(bool).__getitem__
        else:
            in_heads = lambda bit: _held(head, bit)
        power, inverse = _powers(BASE, SLICE + KEY), _powers(pow(BASE, -1, 1 << 64), SLICE + KEY)
        for batch in batches:
            values = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
            raw, offsets = _raw(values)
            for first, last in _pieces(offsets):
                owner, found = _keys_in(raw, offsets[first : last + 1], in_heads, head_bits, whole, [*regions], power, inverse, regions, prefixes)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=last - first))])
                rows = [batch.column(i).slice(first, last - first) for i in places]
                yield pa.RecordBatch.from_arrays([*rows, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], [*kept, "_keys"])

    fields = [texts.schema.fields[i] for i in places]
    return texts.mapInArrow(of, T.StructType([*fields, T.StructField("_keys", T.ArrayType(T.BinaryType()))]))


def occurring(texts: DataFrame, text: str, terms: DataFrame, term: str, most_bytes: int = BROADCAST_BYTES, kept: list[str] | None = None, once: bool = False) -> DataFrame:
    """Each row of ``texts`` with each row of ``terms`` whose term its text contains, as it is written.

    Null texts and null or empty terms meet nothing; repeated texts and terms stay rows of their own, but with ``once`` equal
    rows of terms count once. Columns of both sides must differ. ``kept``: the columns of ``texts`` that are returned, all by
    default; where the text is not among them and no term is longer than a key, no text is written or shuffled.
    """
    kept = texts.columns if kept is None else kept
    weight, key = F.octet_length(term) + F.least(F.octet_length(term), F.lit(KEY)) + 64, F.substring(F.col(term).cast("binary"), 1, KEY)
    filed = stage(terms.where(F.col(term) != ""), "dictionary")
    measured = filed.groupBy(F.least(F.octet_length(term), F.lit(KEY)).alias("size")).agg(F.count("*").alias("n"), F.sum(weight).alias("bytes"), F.max(F.octet_length(term)).alias("longest")).collect()
    keyed = filed.withColumn("_key", key)
    sieve = _sieve(keyed.select("_key"), {x.size: x.n for x in measured})
    # a term that is all key stands where its key does
    searched = any(x.longest > KEY for x in measured)
    within = (F.octet_length(term) <= KEY) | (F.position(F.col(term), F.col(text)) > 0) if searched else F.lit(True)
    carried = [*kept, text] if searched and text not in kept else kept
    returned = lambda found: found.where(within).select(*kept, *terms.columns)
    met = lambda sought, columns: sought.select(*columns, F.explode("_keys").alias("_met"))
    same, sought = F.col("_met") == F.col("_key"), texts.where(F.col(text) != "")
    if sum(x.bytes for x in measured) <= most_bytes:
        return returned(met(_with_keys(sought, text, sieve, carried), carried).join(F.broadcast(keyed.distinct() if once else keyed), same))
    numbered = ["_text"] if text in carried else []
    sought = sought.withColumn("_text", F.monotonically_increasing_id()) if numbered else sought
    sought = stage(_with_keys(sought, text, sieve, [*carried, *numbered]).where(F.size("_keys") > 0), "dictionary-texts")
    counted = stage(met(sought, []).groupBy(F.col("_met").alias("_key")).agg(F.length(F.bin(F.count("*"))).alias("_class")), "dictionary-keys")
    keys = counted.groupBy("_class", F.octet_length("_key").alias("size")).agg(F.count("*").alias("n")).collect()
    used = _passing(keyed, _sieve(counted.select("_key"), {x.size: sum(y.n for y in keys if y.size == x.size) for x in keys}))
    used = stage((used.distinct() if once else used).join(counted, "_key"), "dictionary-used")
    # keys by the power of two of the texts that have them: the most frequent classes that, with their terms, may be broadcast
    held = {x["_class"]: x.bytes for x in used.groupBy("_class").agg(F.sum(weight).alias("bytes")).collect()}
    common, total = None, 0
    for c in sorted({x["_class"] for x in keys}, reverse=True):
        total += held.get(c, 0) + sum(x.n * (x.size + 64) for x in keys if x["_class"] == c)
        if total > most_bytes:
            break
        common = c
    if common is None:
        rest, left = used, met(sought, numbered or carried)
    else:
        near = returned(met(sought, carried).join(F.broadcast(used.where(F.col("_class") >= common)), same))
        if common <= min(held, default=common):
            return near
        rest = used.where(F.col("_class") < common)
        # frequent bytes that are no term go here as well
        left = met(sought, numbered or carried).join(F.broadcast(counted.where(F.col("_class") >= common).select("_key")), same, "left_anti")
    far = left.join(rest.hint("merge"), same)
    if numbered:
        far = sought.drop("_keys").join(far.select("_text", *terms.columns).hint("merge"), "_text")
    return returned(far) if common is None else near.unionByName(returned(far))


def dictionary_matches(texts: DataFrame, key: list[str], text: str, terms: DataFrame, term: str, hints: tuple = (), limit: int = 140) -> DataFrame:
    """One row a (text, term) that the cleaned text contains, with all columns of the terms and the sentence around the first.

    Text and terms are cleaned alike. Terms with one of ``hints`` in their sentence are not included.
    """
    flat = texts.select(*key, clean(text).alias("_flat"))
    found = occurring(flat, "_flat", terms.withColumn("_term", clean(term)), "_term")
    out = found.withColumn("sentence", sentence_around(F.col("_flat"), F.col("_term"), limit))
    included = ~F.exists(F.array(*[F.lit(clean_literal(h)) for h in hints]), lambda h: F.contains(F.col("sentence"), h)) if hints else F.lit(True)
    return out.withColumn("is_included", included).drop("_flat", "_term")


def longest_first(found: DataFrame, key: list[str], term: str) -> DataFrame:
    """key, terms: the terms found in each text, the longest first, ties by the term."""
    entry = F.struct((-F.length(term)).alias("n"), F.col(term).alias("t"))
    return found.groupBy(*key).agg(F.array_sort(F.collect_set(entry)).alias("_t")).select(*key, F.transform("_t", lambda x: x["t"]).alias("terms"))


def rewrite_phrases(rows: DataFrame, column: str, out: str, dictionary: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """``rows`` with the phrase of ``column`` rewritten as ``domain.rewrite_phrase`` does, by a table (term, translation).

    Each different phrase is rewritten once: exact translation, else rules, else exact again, else the terms that the ruled
    phrase contains, longest first. Terms are sought in the phrase as the rules leave it; one that only translations put
    together is not. Of equal terms the least translation counts.
    """
    source = F.trim(domain.repair_long_vowels(F.coalesce(column, F.lit(""))))
    words = dictionary.where("term IS NOT NULL").groupBy("term").agg(F.min("translation").alias("translation"))
    keyed = rows.withColumn("_s", source)
    phrases = stage(keyed.select("_s").distinct().where(F.col("_s").rlike(f"[{CJK}]")).withColumn("_ruled", domain.apply_rules(F.col("_s"), rules)), "phrases")
    exact = lambda df, c, name: df.join(words.select(F.col("term").alias(c), F.col("translation").alias(name)), c, "left")
    entry = F.struct((-F.length("term")).alias("n"), F.col("term").alias("k"), F.col("translation").alias("v"))
    found = occurring(phrases, "_ruled", words, "term").groupBy("_s").agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    joined = exact(exact(phrases, "_s", "_e1"), "_ruled", "_e2").join(found, "_s", "left")
    put = F.aggregate(F.coalesce("_found", F.array().cast("array<struct<n:int,k:string,v:string>>")), F.col("_ruled"), lambda a, t: F.replace(a, t["k"], t["v"]))
    spaced = strip(domain.spaced(put), " ・,")
    done = joined.select("_s", F.coalesce("_e1", "_e2", F.nullif(spaced, F.lit("")), "_s").alias("_done"))
    return keyed.join(done, "_s", "left").withColumn(out, F.coalesce("_done", "_s")).drop("_s", "_done")
