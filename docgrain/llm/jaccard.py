"""N-gram Jaccard join by chosen paths.

Texts become sets of five-word shingles. A chosen path samples a token that similar sets are likely to share: the token of
a set that is least under a random order (sets of similarity J agree on it with probability J). A run splits all sets by
one such token; a bucket that is still large is split again by further ones, each set following several, until it is small
or its sets are alike; small buckets are compared by brute force, large ones of like sets in blocks. Runs are repeated so
that a pair at the threshold is missed by all of them with odds of about 1 - ``recall``.

Pairs that sketches of the sampled tokens leave possible are verified on the whole sets. Links are counted where a pair
meets first, so each is counted once and none is ever written out; only one link from each set to the least one of its
component in a bucket goes on to the connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import materialize, read_table, text_or_empty
from docgrain.llm.components import connected_components
from docgrain.llm.textblocks import blocks, shingles, word_hashes

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.99999
#: Sampled tokens of a set: the first of each run, those of deeper levels, and all of them as its sketch.
COORDINATES = 48
SMALL = 256
#: Sets of a bucket that one task compares with each other at once.
BLOCK = 1024
#: Whole sets that a task holds beside its last part, in bytes, and values of sets that it compares in one pass.
GROUP_BYTES, VALUES_AT_ONCE = 32 << 20, 2_000_000
DEPTH, CHILDREN = 8, 2
#: A bucket in which so many share one more sampled token is not split further: its sets are alike.
DENSE = 0.6

_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold is missed with odds of at most 1 - recall, at one level."""
    return max(1, math.ceil(math.log(max(1e-12, 1 - recall)) / math.log(1 - threshold)))


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, th (digest of the text), n (size of its set), sketch (sampled tokens) of each row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                values, owner = shingles(*word_hashes(block), block.n, WIDTH)
                n = np.bincount(owner, minlength=block.n)
                sketch = np.zeros((block.n, COORDINATES), np.uint32)
                full = np.flatnonzero(n)
                if len(full):
                    first = np.searchsorted(owner, full)
                    for c, seed in enumerate(_SEEDS):
                        sketch[full, c] = np.minimum.reduceat((values * seed) >> np.uint64(32), first)
                ids, th = (batch.column(k).slice(block.first, block.n) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, th, pa.array(n), pa.array([x.tobytes() for x in sketch], pa.binary())], ["doc_id", "th", "n", "sketch"])

    text = text_or_empty()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("th"), text.alias("text"))
    return narrow.mapInArrow(of, "doc_id long, th binary, n long, sketch binary")


def _coordinate(c) -> F.Column:
    """Sampled token ``c`` of a set, as four bytes."""
    return F.substring("sketch", 1 + 4 * c, 4)


def chosen_buckets(classes: DataFrame, runs: int) -> DataFrame:
    """bucket, part, th: the final buckets of at least two sets, those of equal members once.

    Parts are pairs of blocks of a large bucket of like sets: every two members meet in one part.
    """
    rows = classes.where("n > 0").select("th", "sketch", F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.xxhash64(F.lit(r), _coordinate(r)).alias("path")) for r in range(runs)])).alias("s"))
    level, final = rows.select("th", "s.run", "s.path"), []
    sketches = classes.select("th", "sketch")
    for depth in range(DEPTH + 1):
        counts = level.groupBy("path").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("th")).alias("sum")).where("size > 1")
        # buckets of equal members are one: the path of the least is kept
        counts = materialize(counts.groupBy("size", "sum").agg(F.min("path").alias("path")).select("path", "size"), "join-buckets")
        here = level.join(counts, "path")
        if depth == DEPTH:
            final.append(here.select("path", "size", "th"))
            break
        final.append(here.where(F.col("size") <= SMALL).select("path", "size", "th"))
        if counts.where(F.col("size") > SMALL).isEmpty():
            break
        large = materialize(here.where(F.col("size") > SMALL).join(sketches, "th"), "join-large")
        base = F.pmod(F.col("run") * 5 + depth * CHILDREN, F.lit(COORDINATES - runs)) + runs
        child = lambda c: _coordinate_at(F.pmod(base - runs + c, F.lit(COORDINATES - runs)) + runs)  # noqa: B023, E731
        most = large.groupBy("path", child(0).alias("token")).agg(F.count("*").alias("k")).groupBy("path").agg((F.max("k") >= DENSE * F.sum("k")).alias("dense"))
        most = materialize(most, "join-dense")
        marked = large.join(most, "path")
        final.append(marked.where("dense").select("path", "size", "th"))
        paths = F.explode(F.array(*[F.xxhash64("path", F.lit(depth), F.lit(c), child(c)) for c in range(CHILDREN)]))
        level = materialize(marked.where("NOT dense").select("th", "run", paths.alias("path")), "join-level")
    out = final[0]
    for more in final[1:]:
        out = out.unionByName(more)
    g = F.ceil(F.col("size") / (BLOCK // 2)).cast("int")
    own = F.pmod(F.xxhash64("th", "path"), g).cast("int")
    pairs = F.when(F.col("size") <= BLOCK, F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(F.sequence(F.lit(0), g - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    )
    side = F.when(F.col("size") <= BLOCK, F.lit(0)).otherwise(own)
    parted = out.select(F.col("path").alias("bucket"), "th", side.alias("side"), F.explode(pairs).alias("p"))
    return parted.select("bucket", F.xxhash64("bucket", "p.x", "p.y").alias("part"), "side", (F.col("p.x") != F.col("p.y")).alias("crossed"), "th")


def _coordinate_at(c) -> F.Column:
    return F.substring(F.col("sketch"), (F.lit(1) + c * 4).cast("int"), F.lit(4))


def _groups(batches: Iterator[pa.RecordBatch], rows: int = 2048, limit: int = GROUP_BYTES) -> Iterator[pa.Table]:
    """Tables of whole parts, from batches in order of ``part``: as soon as ``rows`` rows or ``limit`` bytes are held, all but the last part."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        size += batch.nbytes
        if n >= rows or size >= limit:
            table = pa.Table.from_batches(held)
            part = table["part"].to_numpy()
            cut = int(np.searchsorted(part, part[-1]))  # the last part may go on
            if cut:
                yield table.slice(0, cut)
            held, n = table.slice(cut).combine_chunks().to_batches(), len(part) - cut
            size = sum(x.nbytes for x in held)
    if n:
        yield pa.Table.from_batches(held)


def _meets(part: np.ndarray, side: np.ndarray, crossed: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of rows to compare, at each distance in turn: same part, sizes that allow the threshold."""
    k = 1
    while True:
        i = np.flatnonzero(part[:-k] == part[k:]) if k < len(part) else np.zeros(0, int)
        if not len(i):
            return
        ok = (np.minimum(n[i], n[i + k]) >= THRESHOLD * np.maximum(n[i], n[i + k])) & (~crossed[i] | (side[i] != side[i + k]))
        yield i[ok], i[ok] + k
        k += 1


def _possible(members: DataFrame) -> DataFrame:
    """The members of parts whose sketch leaves a link to another member possible."""
    least = int(COORDINATES * THRESHOLD - 5 * math.sqrt(COORDINATES * THRESHOLD * (1 - THRESHOLD)))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint32).reshape(-1, COORDINATES)
            keep = np.zeros(len(table), bool)
            for i, j in _meets(*(table[c].to_numpy() for c in ("part", "side", "crossed", "n"))):
                like = (sketch[i] == sketch[j]).sum(1) >= least
                keep[i[like]] = keep[j[like]] = True
            yield from table.filter(pa.array(keep)).select(["bucket", "part", "side", "crossed", "th"]).to_batches()

    ordered = members.select("bucket", "part", "side", "crossed", "th", "n", "sketch").repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(of, "bucket long, part long, side int, crossed boolean, th binary")


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    # both are sorted and hold no value twice
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= THRESHOLD * (len(x) + len(y) - common)


def _verify(members: DataFrame) -> DataFrame:
    """th, links, least: for each member of a part its links that are counted here and the least set it links to here."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 1024):
            part, side, crossed, n, bucket = (table[c].to_numpy() for c in ("part", "side", "crossed", "n", "bucket"))
            th = np.array([int.from_bytes(x, "big") for x in table["th"].to_pylist()], object)
            values = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
            met = table["met"].combine_chunks()
            at, ids = met.offsets.to_numpy(), met.values.to_numpy()
            met = [ids[at[k] : at[k + 1]] for k in range(len(table))]
            links, root = np.zeros(len(table), np.int64), np.arange(len(table))
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            for s, e in zip(starts.tolist(), np.r_[starts[1:], len(part)].tolist()):
                common = _common(values[s:e])
                linked = common >= THRESHOLD * (n[s:e, None] + n[None, s:e] - common)
                np.fill_diagonal(linked, False)
                if crossed[s]:
                    linked &= side[s:e, None] != side[None, s:e]
                if not linked.any():
                    continue
                # a pair is counted in the least of the buckets in which both are
                earlier = _common([x[x < bucket[s]] for x in met[s:e]]) > 0
                links[s:e] = (linked & ~earlier).sum(1)
                rank = np.argsort(np.argsort(th[s:e]))
                label = rank.copy()
                while True:
                    lower = np.minimum(label, np.where(linked, label[None, :], e - s).min(1))
                    if (lower == label).all():
                        break
                    label = lower
                root[s:e] = s + np.argsort(rank)[label]
            rows = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
            own = table["th"].combine_chunks()
            yield pa.RecordBatch.from_arrays([own.take(pa.array(rows)), pa.array(links[rows]), own.take(pa.array(root[rows]))], ["th", "links", "least"])

    ordered = members.repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(of, "th binary, links long, least binary")


def _common(sets: list[np.ndarray], limit: int = VALUES_AT_ONCE) -> np.ndarray:
    """How many values each two of the sets share: products of 0/1 rows over the values that two or more sets hold.

    Many values are dealt to passes by their remainder, so that the vectors of a pass hold about ``limit`` values.
    """
    passes = 1 + sum(len(v) for v in sets) // limit
    common = np.zeros((len(sets), len(sets)), np.float32)
    for r in range(passes):
        common += _common_once(sets if passes == 1 else [v[v % v.dtype.type(passes) == r] for v in sets])
    return common


def _common_once(sets: list[np.ndarray]) -> np.ndarray:
    common = np.zeros((len(sets), len(sets)), np.float32)
    uniq, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    column = np.full(len(uniq), -1)
    column[shared] = np.arange(len(shared))
    owner, col = np.repeat(np.arange(len(sets)), [len(v) for v in sets]), column[at]
    for c in range(0, len(shared), 4096):
        inside = (col >= c) & (col < c + 4096)
        rows = np.zeros((len(sets), min(4096, len(shared) - c)), np.float32)
        rows[owner[inside], col[inside] - c] = 1
        common += rows @ rows.T
    return common


def _tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """th, tokens (the whole set) of the wanted texts (th, rep: the document to read it from)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                values, owner = shingles(*word_hashes(block), block.n, WIDTH)
                cut = np.searchsorted(owner, np.arange(block.n + 1))
                own = pa.array([values[cut[t] : cut[t + 1]].tobytes() for t in range(block.n)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), own], ["th", "tokens"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), F.unhex(F.md5(text)).alias("th"), text.alias("text"))
    one = rows.join(wanted, rows["rep"].eqNullSafe(wanted["rep"]) & (rows["th"] == wanted["th"]), "left_semi").select("th", "text")
    return one.mapInArrow(of, "th binary, tokens binary").dropDuplicates(["th"])


def similarity_classes(docs: DataFrame, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (doc_id, th) of documents; classes (th, rep, n_links, label), one for each distinct text."""
    sets = materialize(_sets(docs), "join-sets")
    classes = sets.groupBy("th").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialize(classes, "join-classes")
    members = chosen_buckets(classes, runs_for(recall)).join(classes.select("th", "n", "sketch"), "th")
    possible = materialize(_possible(members), "join-possible")
    met = possible.groupBy("th").agg(F.array_sort(F.collect_set("bucket")).alias("met"))
    wanted = classes.join(met, "th", "left_semi").select("th", "rep", "n")
    tokens = materialize(_tokens(docs, wanted.select("th", "rep")), "join-tokens")
    known = wanted.drop("rep").join(met, "th").join(tokens, "th")
    found = materialize(_verify(possible.join(known, "th")), "join-found")
    links = found.groupBy("th").agg(F.sum("links").alias("n_links"))
    labels = connected_components(found.where("th <> least").select(F.col("th").alias("a"), F.col("least").alias("b")))
    out = classes.select("th", "rep").join(links, "th", "left").join(labels.withColumnRenamed("node", "th"), "th", "left")
    return sets.select("doc_id", "th"), out.select("th", "rep", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "th").alias("label"))


def jaccard_join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, copy_id, n_links of every row of ``docs``.

    ``copy_id`` is the least id among equal texts, ``class_id`` among all texts that links connect, ``n_links`` the number of
    other distinct texts of similarity 0.8 or more. Null texts are empty; texts without words link to nothing but are copies
    of equal ones; null ids count only where there is no other; equal rows get equal results; an empty table gives an empty
    result; other columns are ignored.
    """
    rows, classes = similarity_classes(docs, recall)
    classes = materialize(classes, "join-labels")
    least = classes.groupBy("label").agg(F.min("rep").alias("class_id"))
    named = classes.join(least, "label").select("th", "class_id", F.col("rep").alias("copy_id"), "n_links")
    return rows.join(named, "th").select("doc_id", "class_id", "copy_id", "n_links")


def first_of_each_class(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class is kept, the one of least id; columns unchanged."""
    rows, classes = similarity_classes(docs, recall)
    order = F.struct(F.col("rep").isNull(), F.col("rep"), F.col("th"))
    kept = materialize(classes.groupBy("label").agg(F.min_by(F.struct("rep", "th"), order).alias("k")).select(F.col("k.rep").alias("__jj_rep"), F.col("k.th").alias("__jj_th")), "join-kept")
    on = F.col("doc_id").eqNullSafe(F.col("__jj_rep")) & (F.unhex(F.md5(text_or_empty())) == F.col("__jj_th"))
    out = docs.join(kept, on, "left_semi")
    if rows.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        return out
    same = Window.partitionBy("doc_id", F.md5(text_or_empty())).orderBy(F.lit(0))
    return out.withColumn("__jj_n", F.row_number().over(same)).where("__jj_n = 1").drop("__jj_n")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))
