"""Line dedup: a suffix array over sequences of line ids, by distributed prefix doubling.

A line that occurs once in the corpus can be part of no repeated run: it ends one, as the end of its document does, and its
position needs no rank. Every other position is a suffix that reaches to the next such end. Ids of lines are their ranks;
at depth d all positions that agree in d lines have one rank, which counts the positions that sort before them, so it names
the interval of common prefix d by its left end. The ranks of a position and of those d, 2d and 3d lines further on give its
rank at depth 4d: two doublings in one round (up to ``least``, which is one of the depths, rounds double once). A position
whose rank is its own, or whose suffix ends within the depth, is in its final place; a document in which all are goes into
no further round, so the work shrinks, and the number of rounds is half the logarithm of the longest repeated run.

Positions that share an interval of depth ``least`` share a run of so many lines; the first, in order of document and line,
is the copy that stays, and runs that begin later overlap to the stretches that are deleted. Neighbours in suffix order
that parted after depth d share d lines or more; how many, the ranks of that depth and the smaller ones tell, the largest
first. Where the lines before two neighbours are neighbours as well, they share one line more, so only the first of such a
chain is looked up.

Of rows that are equal in id and text two take part: what holds of the second holds of every later one.

Ranks are summed over ranges of sorted rows, and neighbours are found inside ranges; what passes from one range to the
next is one row a range. No rank, interval or document needs to fit in one task but the lines of a document itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import WORD_PATTERN, expand_counted, materialize, read_table, text_or_empty

LEAST = 2
#: Words of a line from which on a later copy of it goes even where the lines beside it are not repeated.
ALONE = 5

ROW = ["doc_id", "h", "copy"]
POSITION = [*ROW, "line"]


def _split_intervals(classes: DataFrame, name: str, key: str = "next") -> DataFrame:
    """``classes`` (rank, ``key``, n positions) with ``place``: the rank of each inside the interval of its old rank.

    Classes are dealt by ranges of (rank, key). A range starts where those before it end; an interval that begins in an
    earlier range is the last one of that range. Both tables have one row a range, which bounds their broadcast.
    """
    dealt = materialize(classes.repartitionByRange("rank", key).withColumn("_part", F.spark_partition_id()), f"lines-{name}-classes")
    before = Window.partitionBy("_part").orderBy("rank", key).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_c", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_b", F.min("_c").over(Window.partitionBy("_part", "rank")))
    ends = dealt.groupBy("_part", "rank").agg(F.sum("n").alias("n")).groupBy("_part").agg(F.sum("n").alias("_n"), F.max(F.struct("rank", "n")).alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ends.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    carried = parts.groupBy(F.col("_last.rank").alias("rank")).agg(F.min(F.col("_start") + F.col("_n") - F.col("_last.n")).alias("_carry"))
    found = inside.join(F.broadcast(parts.select("_part", "_start")), "_part").join(F.broadcast(carried), "rank", "left")
    begin = F.least(F.col("_start") + F.col("_b"), F.coalesce("_carry", F.lit((1 << 63) - 1)))
    return found.withColumn("place", F.col("rank") + F.col("_start") + F.col("_c") - begin).drop("_part", "_c", "_b", "_start", "_carry")


def _line_ranks(docs: DataFrame, alone: int | None) -> DataFrame:
    """Positions of repeated lines: rank, first (the first position of the line), single (whether it counts by itself)."""
    text = text_or_empty()
    long_enough = F.lit(False) if alone is None else F.col("whole") | (F.regexp_count("words", F.lit(WORD_PATTERN)) >= alone)
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("line", "words"), (F.instr(text, "\n") == 0).alias("whole"))
    named = lines.select("doc_id", "h", "line", F.unhex(F.md5("words")).alias("name"), long_enough.alias("single"))
    # names are counted before the shuffle, and written before they are joined: both sides then have a shuffle of their own,
    # and the positions of one very common line are split among tasks
    first = F.min(F.struct("doc_id", "h", F.lit(0).alias("copy"), "line")).alias("first")
    classes = named.groupBy("name").agg(F.count("*").alias("n"), first).where("n > 1")
    ranks = _split_intervals(classes.withColumn("rank", F.lit(0).cast("long")), "1", "name").select("name", "first", F.col("place").alias("rank"))
    found = named.join(materialize(ranks, "lines-1-ranks"), "name")
    equal = found.groupBy("doc_id", "h", "line", "rank", "first", "single").agg(F.count("*").alias("n"))
    return materialize(equal.withColumn("copy", F.explode(F.when(F.col("n") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select(*POSITION, "rank", "first", "single"), "lines-1")


def _followed(known: DataFrame, step: int, pieces: int) -> DataFrame:
    """Positions of documents with live ones; the live ones (``on``) with ``next``, the ranks that stand 1 to ``pieces``
    steps further on (-1 from the end of a suffix, or behind a rank that is final), and ``ends``."""
    row = Window.partitionBy(*ROW)
    met = [F.first(F.struct("rank", "ends", "on")).over(row.orderBy("line").rangeBetween(k * step, k * step)).alias(f"m{k}") for k in range(1, pieces + 1)]
    live = known.select("*", *met, F.bool_or("on").over(row).alias("live")).where("live")
    goes_on, ranks, ends = F.lit(True), [], F.lit(None).cast("long")
    for k in range(1, pieces + 1):
        ranks.append(F.when(goes_on, F.coalesce(f"m{k}.rank", F.lit(-1))).otherwise(-1).cast("long"))
        goes_on = goes_on & F.coalesce(f"m{k}.on", F.lit(False))
    for k in range(pieces, 0, -1):
        ends = F.when(F.col(f"m{k}").isNull(), F.lit(k * step).cast("long")).when(F.col(f"m{k}.on"), ends).otherwise(F.col(f"m{k}.ends") + k * step)
    return live.select(*POSITION, "rank", "level", F.when(F.col("on"), F.array(*ranks)).alias("next"), F.when(F.col("on"), ends).otherwise(F.col("ends")).alias("ends"), "on")


def suffix_array(docs: DataFrame, least: int = LEAST, alone: int | None = None) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """The levels of the doubling, as (depth, positions that share their rank there), and the final order.

    A level has doc_id, h, copy, line, rank and first, the first position of the interval (at depths 1 and ``least``, else
    null). The order has rank, level (the last one that a position shares with its predecessor, null for none) and ends, the
    lines up to the end of a suffix that ended among equal ones.
    """
    base = _line_ranks(docs, alone)
    known = base.select(*POSITION, "rank", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("ends"), F.lit(True).alias("on"))
    levels, final, depth = [(1, base.select(*POSITION, "rank", "first", "single"))], [], 1
    while True:
        step, pieces = (min(depth, least - depth), 1) if depth < least else (depth, 3)
        paired = materialize(_followed(known, step, pieces), f"lines-{depth}-pairs")
        live = paired.where("on").drop("on")
        depth += step * pieces
        firsts = [F.min(F.struct(*POSITION)).alias("first")] if depth == least else []
        placed = _split_intervals(live.groupBy("rank", "next").agg(F.count("*").alias("n"), *firsts), str(depth))
        shared = (F.col("n") > 1) & F.col("ends").isNull()
        moved = F.when(F.col("place") == F.col("rank"), F.col("level")).otherwise(F.lit(len(levels) - 1))
        first = F.col("first") if firsts else F.lit(None).cast(base.schema["first"].dataType)
        going_on = Observation()
        split = live.join(placed, ["rank", "next"]).select(*POSITION, F.col("place").alias("rank"), moved.cast("int").alias("level"), "ends", shared.alias("on"), first.alias("first"))
        split = materialize(split.observe(going_on, F.count_if("on").alias("n")), f"lines-{depth}")
        final.append(split.where("NOT on"))
        levels.append((depth, split.where("on").select(*POSITION, "rank", "first")))
        if depth >= least and not going_on.get["n"]:
            return levels, reduce(DataFrame.unionByName, [x.select(*POSITION, "rank", "level", "ends") for x in final])
        known = split.drop("first").unionByName(paired.where("NOT on").drop("next"))


def common_prefixes(levels: list[tuple[int, DataFrame]], order: DataFrame) -> DataFrame:
    """doc_id, h, copy, line and other (the position before it in suffix order), lcp (lines that both share), where lcp > 0.

    Of a chain of positions whose neighbours stand side by side as well only the first is returned: its common prefix
    covers those of the others.
    """
    at = ["rank", *POSITION]
    dealt = materialize(order.repartitionByRange(*at).withColumn("_part", F.spark_partition_id()), "lines-order")
    entry = F.struct(*at)
    inner = F.lag(entry).over(Window.partitionBy("_part").orderBy(*at))
    lasts = dealt.groupBy("_part").agg(F.max(entry).alias("_last")).withColumn("_last", F.lag("_last").over(Window.orderBy("_part")))
    found = dealt.withColumn("_before", inner).join(F.broadcast(lasts), "_part").withColumn("other", F.coalesce("_before", "_last"))
    tied = F.col("other.rank") == F.col("rank")
    pairs = found.where(F.col("other").isNotNull() & (tied | F.col("level").isNotNull()))
    back = F.first("other").over(Window.partitionBy(*ROW).orderBy("line").rangeBetween(-1, -1))
    goes_on = F.col("back.doc_id").eqNullSafe(F.col("other.doc_id")) & (F.col("back.h") == F.col("other.h")) & (F.col("back.copy") == F.col("other.copy")) & (F.col("back.line") == F.col("other.line") - 1)
    heads = pairs.withColumn("back", back).where(F.col("back").isNull() | ~goes_on)
    depths = [d for d, _ in levels]
    known = F.when(tied, F.col("ends")).otherwise(F.element_at(F.array(*map(F.lit, depths)), F.col("level") + 1)).cast("long")
    heads = materialize(heads.select(*POSITION, "other", F.when(~tied, F.col("level")).alias("level"), known.alias("lcp")), "lines-heads")
    top = heads.agg(F.max("level")).first()[0]
    done, open_rows = [heads.where("level IS NULL")], None
    for k in range(-1 if top is None else top, -1, -1):
        new = heads.where(F.col("level") == k)
        open_rows = new if open_rows is None else open_rows.unionByName(new)
        open_rows = materialize(_longer(open_rows, levels[k][1], depths[k], -(-depths[k + 1] // depths[k]) - 1), f"lines-lcp-{k}")
    if open_rows is not None:
        done.append(open_rows)
    return reduce(DataFrame.unionByName, done).select(*POSITION, "other", "lcp")


def _longer(pairs: DataFrame, level: DataFrame, depth: int, tries: int) -> DataFrame:
    """``pairs`` with lcp raised by ``depth`` as often as the ranks behind it agree, up to ``tries`` times."""
    ahead = lambda p, k: (F.col(p + "line") + F.col("lcp") + k * depth).cast("int").alias("line")
    places = [F.struct(F.lit(f"{side}{k}").alias("side"), *[F.col(p + c).alias(c) for c in ROW], ahead(p, k)) for k in range(tries) for side, p in (("a", ""), ("b", "other."))]
    asked = pairs.withColumn("_at", F.explode(F.array(*places)))
    ranks = level.select(*[F.col(c).alias(f"_{c}") for c in [*POSITION, "rank"]])
    same = F.col("_at.doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_at.h") == F.col("_h")) & (F.col("_at.copy") == F.col("_copy")) & (F.col("_at.line") == F.col("_line"))
    told = [F.max(F.when(F.col("_at.side") == s + str(k), F.col("_rank"))).alias(f"_{s}{k}") for k in range(tries) for s in "ab"]
    found = asked.join(ranks, same, "left").groupBy(*POSITION, "other", "level", "lcp").agg(*told)
    more = F.lit(0)
    for k in range(tries - 1, -1, -1):
        more = F.when(F.col(f"_a{k}") == F.col(f"_b{k}"), more + depth).otherwise(0)
    return found.select(*POSITION, "other", "level", (F.col("lcp") + more).cast("long").alias("lcp"))


def later_copies(levels: list[tuple[int, DataFrame]], least: int, alone: int | None, base: DataFrame) -> DataFrame:
    """doc_id, h, copy, line, length: runs of ``least`` lines, and single lines if ``alone`` is given, that have an earlier copy."""
    later = F.struct(*POSITION) > F.col("first")
    runs = next(x for depth, x in levels if depth == least).where(later).select(*POSITION, F.lit(least).alias("length"))
    return runs if alone is None else runs.unionByName(base.where("single").where(later).select(*POSITION, F.lit(1).alias("length")))


def dedup_lines(docs: DataFrame, least: int = LEAST, alone: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, longest_run, longest_match, kept_sha256 of every row of ``docs``.

    Lines end at line feeds; those kept are joined by line feeds again. The first copy of a run, in order of doc_id, hash of
    the text and line, stays. With ``alone``, a later copy of a line of so many words or more, or of a line that is a whole
    document, goes also when no line beside it is repeated along with it. ``n_runs`` and ``longest_run`` count the deleted
    stretches and the lines of the longest one; ``longest_match`` is the most lines in a row that start anywhere in the document and
    stand, in that order, at another place, in this document or another. Null texts are one empty line, as empty ones are;
    null ids come first; of rows with equal id and text one is the first and the others are its later copies; an empty table
    gives an empty result; other columns are ignored.
    """
    levels, order = suffix_array(docs, least, alone)
    starts = later_copies(levels, least, alone, levels[0][1])
    shared = common_prefixes(levels, order)
    ends = shared.select(*ROW, "lcp").unionByName(shared.select(*[f"other.{c}" for c in ROW], "lcp"))
    none = F.lit(None)
    both = starts.withColumn("lcp", none.cast("long")).unionByName(ends.select(*ROW, none.cast("int").alias("line"), none.cast("int").alias("length"), "lcp"))
    start = F.when(F.col("line").isNotNull(), F.struct("line", "length"))
    found = both.groupBy(*ROW).agg(F.collect_set(start).alias("starts"), F.max("lcp").alias("longest_match")).withColumnsRenamed({"doc_id": "_d", "h": "_h", "copy": "_c"})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_lines", "n_removed", "n_runs", "longest_run"]
        for batch in batches:
            out: dict[str, list] = {k: [] for k in [*names, "kept_sha256"]}
            for text, starts in zip(batch.column(1), batch.column(2).to_pylist()):
                lines = text.as_py().split("\n")
                gone = {s["line"] + k for s in starts or () for k in range(s["length"])}
                runs = [x for x in sorted(gone) if x - 1 not in gone]
                longest = max((next(n for n in range(1, len(lines) + 1) if x + n not in gone) for x in runs), default=0)
                kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
                for k, v in zip(out, (len(lines), len(gone), len(runs), longest, hashlib.sha256(kept.encode()).hexdigest())):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), *(pa.array(out[k], pa.int64()) for k in names), pa.array(out["kept_sha256"], pa.string())], ["doc_id", "longest_match", *out])

    text = text_or_empty()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    numbered = _numbered(keyed, levels[0][1].where("copy = 1").select("doc_id", "h").distinct())
    joined = numbered.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col("copy") == F.col("_c")), "left")
    return joined.select("doc_id", "text", "starts", F.coalesce("longest_match", F.lit(0)).alias("longest_match")).mapInArrow(of, "doc_id long, longest_match long, n_lines long, n_removed long, n_runs long, longest_run long, kept_sha256 string")


def _numbered(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``keyed`` with ``copy``: 1 for all but one of the rows that are equal, else 0."""
    if repeated.isEmpty():
        return keyed.withColumn("copy", F.lit(0))
    marked = keyed.join(repeated.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.lit(True).alias("_many")), keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["h"] == F.col("_h")), "left").drop("_d", "_h")
    counted = marked.where("_many").groupBy("doc_id", "h", "text").agg(F.count("*").alias("_n"))
    many = expand_counted(counted, "_n", "_i").select("doc_id", "h", "text", F.least(F.col("_i"), F.lit(1)).cast("int").alias("copy"))
    return marked.where("_many IS NULL").select("doc_id", "h", "text", F.lit(0).alias("copy")).unionByName(many)


def op1_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents"), alone=ALONE)


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS i, ls FROM d),
w AS (SELECT r, i, ls[i] AS a, ls[i + 1] AS b FROM l WHERE i < len(ls)),
later AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY a, b ORDER BY r, i) AS k FROM w) WHERE k > 1),
alone AS (SELECT r, i FROM (SELECT r, i, ls, row_number() OVER (PARTITION BY ls[i] ORDER BY r, i) AS k FROM l) WHERE k > 1 AND (len(ls) = 1 OR len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) >= 5)),
gone AS (SELECT DISTINCT r, i FROM (SELECT r, i FROM later UNION ALL SELECT r, i + 1 FROM later UNION ALL SELECT r, i FROM alone)),
islands AS (SELECT r, count(*) AS n FROM (SELECT r, i - row_number() OVER (PARTITION BY r ORDER BY i) AS g FROM gone) GROUP BY r, g),
runs AS (SELECT r, count(*) AS n_runs, max(n) AS longest_run FROM islands GROUP BY r),
suffixes AS (SELECT r, i, ls[i:] AS s FROM l),
neighbours AS (SELECT r, s, coalesce(lag(s) OVER o, []) AS p, coalesce(lead(s) OVER o, []) AS q FROM suffixes WINDOW o AS (ORDER BY s, r, i)),
common AS (SELECT r, coalesce(list_min(list_filter(range(1, least(len(s), len(p)) + 1), lambda x: s[x] <> p[x])) - 1, least(len(s), len(p)), 0) AS a,
  coalesce(list_min(list_filter(range(1, least(len(s), len(q)) + 1), lambda x: s[x] <> q[x])) - 1, least(len(s), len(q)), 0) AS b FROM neighbours),
longest AS (SELECT r, max(greatest(a, b)) AS n FROM common GROUP BY r)
SELECT any_value(l.doc_id) AS doc_id, any_value(longest.n)::BIGINT AS longest_match, count(*) AS n_lines, count(gone.i) AS n_removed, coalesce(any_value(runs.n_runs), 0)::BIGINT AS n_runs,
  coalesce(any_value(runs.longest_run), 0)::BIGINT AS longest_run,
  sha256(coalesce(string_agg(ls[l.i], chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
FROM l JOIN longest ON l.r = longest.r LEFT JOIN gone ON l.r = gone.r AND l.i = gone.i LEFT JOIN runs ON l.r = runs.r GROUP BY l.r
"""
