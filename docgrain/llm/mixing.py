"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A source's target over its size is the number of copies that each of its documents should have on average. The whole
part is kept; the fractional part is rounded by the pivotal method: two documents meet, mass (in words) moves at random
from one to the other until one of the two fractions is 0 or 1, and the other one goes on. Blocks of bounded size fold
their documents to one residual each, blocks of residuals fold again, and so on up a reduction tree.

Documents are rounded by classes of length, the longest first. The residual of a class then meets all shorter documents of
its source as one partner, whose fractions move together; so a long residual is made whole by shorter documents, and only
the residual of the class of the shortest tenth is rounded by a coin. The words taken from a source thus differ from its
target by less than one of its shortest tenth (where these are too few to take up what is left, by less than the document
that is left), and each document keeps its expected number of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.llm.common import WORD_PATTERN, expand_counted, materialize, read_table, uniform
from docgrain.sources.stages import ranked

FAN_IN = 128
#: Fixed values of the mix: weights repeat over the sources, which share this part of all words, each up to a cap.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


#: Where the classes of length of a source end, as shares of its documents.
CLASS_ENDS = (0.1, 0.5, 0.9, 0.99)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, docs, target: shares by weight, stopped at ``cap`` times the source, the excess reshared.

    Sources take their weights in order of code points, null last; they are ranked by ranges. Resharing goes in rounds, each
    one sum over all sources: those above their cap are full, and the level of the others rises, until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    per = ranked(per.withColumn("_order", F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))), "_order", "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    per = materialize(per.select("source", "source_size", "docs", weight.alias("_w"), (F.col("source_size") * F.lit(cap)).alias("_cap")), "mix-sources")
    words = per.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("_w") * level > F.col("_cap")
        now = per.agg(F.count_if(above).alias("n"), F.sum(F.when(above, F.col("_cap")).otherwise(0.0)).alias("given"), F.sum(F.when(above, 0.0).otherwise(F.col("_w"))).alias("left")).first()
        if now.n == full or not now.left:
            break
        full, level = now.n, (share * words - now.given) / now.left
    target = F.least(F.col("_cap"), F.col("_w") * F.lit(level)) if level is not None else F.col("_cap")
    return per.select("source", "source_size", "docs", target.alias("target"))


def _let(value: str, name: str, then: str) -> str:
    return f"transform(array({value}), {name} -> {then})[0]"


def _meeting(c: str, x: str, seed: int) -> str:
    """SQL of struct(done, carry): of two documents that meet the settled one, and the one that goes on. Documents are
    struct(order, key, doc_id, copy, size, base, p). Text is planned much faster than columns of this depth."""
    rooms = "struct(b.c, b.x, (1 - b.c.p) * double(b.c.size) AS room_c, b.c.p * double(b.c.size) AS has_c, (1 - b.x.p) * double(b.x.size) AS room_x, b.x.p * double(b.x.size) AS has_x)"
    chance = f"double(pmod(xxhash64(m.c.key, m.x.key, {seed}), {1 << 52}L)) / double({1 << 52}L)"
    gains = f"struct(m, {chance} * (least(m.room_c, m.has_x) + least(m.has_c, m.room_x)) < least(m.has_c, m.room_x) AS to_c)"
    new_c = "if(g.to_c, if(g.m.room_c <= g.m.has_x, 1D, g.m.c.p + g.m.has_x / double(g.m.c.size)), if(g.m.has_c <= g.m.room_x, 0D, g.m.c.p - g.m.room_x / double(g.m.c.size)))"
    new_x = "if(g.to_c, if(g.m.has_x <= g.m.room_c, 0D, g.m.x.p - g.m.room_c / double(g.m.x.size)), if(g.m.room_x <= g.m.has_c, 1D, g.m.x.p + g.m.has_c / double(g.m.x.size)))"
    now = lambda d: "named_struct(" + ", ".join(f"'{f}', n.m.{d}.{f}" for f in ("order", "key", "doc_id", "copy", "size", "base")) + f", 'p', n.new_{d})"
    ends = f"if(n.new_c = 0D OR n.new_c = 1D, struct({now('c')} AS done, {now('x')} AS carry), struct({now('x')} AS done, {now('c')} AS carry))"
    met = _let(f"struct(g.m, {new_c} AS new_c, {new_x} AS new_x)", "n", ends)
    return _let(f"struct({c} AS c, {x} AS x)", "b", _let(rooms, "m", _let(gains, "g", met)))


def _fold(units: DataFrame, seed: int) -> DataFrame:
    """source, block, done (array of settled documents) and carry, of the documents of each block."""
    # long documents first: short ones are left to round them, so the residual is small against the source
    item = F.struct((-F.col("size")).alias("order"), "key", "doc_id", "copy", "size", "base", "p")
    blocks = units.groupBy("source", "block").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = blocks.schema["items"].dataType.elementType.simpleString()
    start = f"struct(cast(array() AS array<{kind}>) AS done, element_at(items, 1) AS carry)"
    meet = _let(_meeting("s.carry", "i", seed), "r", f"struct(cast(concat(s.done, array(r.done)) AS array<{kind}>) AS done, cast(r.carry AS {kind}) AS carry)")
    folded = F.expr(f"aggregate(slice(items, 2, size(items)), {start}, (s, i) -> {meet})")
    return blocks.select("source", "block", folded.alias("f")).select("source", "block", "f.done", "f.carry")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _by_class(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``units`` with their class of length, and source, class, docs, mass, rest (the mass of the shorter classes)."""
    counted = units.groupBy("source", "size").agg(F.count("*").alias("n"))  # one row a length of a source
    up_to = Window.partitionBy("source").orderBy("size")
    shares = counted.withColumn("_share", F.sum("n").over(up_to) / F.sum("n").over(Window.partitionBy("source")))
    ends = shares.groupBy("source").agg(*[F.min(F.when(F.col("_share") >= q, F.col("size"))).alias(f"_e{i}") for i, q in enumerate(CLASS_ENDS)])
    ends = materialize(ends.withColumnRenamed("source", "_s"), "mix-ends")
    number = sum(((F.col("size") > F.col(f"_e{i}")).cast("int") for i in range(len(CLASS_ENDS))), F.lit(0))
    classed = lambda df: df.join(ends, _same("source", "_s")).withColumn("class", number).drop("_s", *[f"_e{i}" for i in range(len(CLASS_ENDS))])
    per = classed(counted).groupBy("source", "class").agg(F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size")).alias("mass"))
    shorter = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    return classed(units), materialize(per.withColumn("rest", F.coalesce(F.sum("mass").over(shorter), F.lit(0)).cast("double")), "mix-classes")


def _settled(folded: DataFrame) -> DataFrame:
    return folded.select("source", F.explode("done").alias("d")).select("source", "d.*").drop("order")


def _fold_class(level: DataFrame, most: int, seed: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(settled documents of each level but the last, the last level: one block a source, not yet written)."""
    height, left = 1, -(-most // (FAN_IN // 2))
    while left > 1:
        height, left = height + 1, -(-left // FAN_IN)
    settled = []
    for k in range(height - 1):
        folded = materialize(_fold(level, seed + k), f"mix-{name}-{k}")
        settled.append(_settled(folded))
        level = folded.select("source", F.floor(F.col("block") / FAN_IN).cast("long").alias("block"), "carry.*").drop("order")
    return settled, _fold(level, seed + height - 1)


def _met(state: DataFrame, last: DataFrame, rest: DataFrame, seed: int) -> DataFrame:
    """The residual of a class meets the shorter documents of its source: both fractions after that, q and p, beside the
    documents that the last level has settled (null where a source has none of the class)."""
    r = last.select(F.col("source").alias("_s"), "done", "carry.key", "carry.doc_id", "carry.copy", "carry.size", F.col("carry.p").alias("q"))
    rows = state.join(r, _same("source", "_s"), "left").drop("_s").join(rest.select(F.col("source").alias("_s"), "rest"), _same("source", "_s"), "left").drop("_s")
    w, m, p, q = F.col("size").cast("double"), F.coalesce("rest", F.lit(0.0)), F.col("p"), F.col("q")
    room_q, has_q, room_p, has_p = (1 - q) * w, q * w, (1 - p) * m, p * m
    up, down = F.least(room_q, has_p), F.least(has_q, room_p)
    gains = uniform(F.col("key"), F.lit(seed), F.lit("class")) * (up + down) < down
    bounded = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
    new_q = F.when(up + down == 0, q).when(gains, F.when(room_q <= has_p, 1.0).otherwise(q + up / w)).otherwise(F.when(has_q <= room_p, 0.0).otherwise(q - down / w))
    new_p = F.when(q.isNull() | (up + down == 0), p).when(gains, F.when(has_p <= room_q, 0.0).otherwise(p - up / m)).otherwise(F.when(room_p <= has_q, 1.0).otherwise(p + down / m))
    return rows.select("source", "base", "done", "key", "doc_id", "copy", "size", bounded(new_q).alias("q"), bounded(new_p).alias("p"))


def pivotal_copies(sizes: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """source, doc_id, copy, size, copies: how often the mix takes each row of ``sizes`` (doc_id, source, size).

    Equal rows are told apart by ``copy``. Rows of size 0 are never taken. The folds depend on the rows alone, so reruns agree.
    """
    counted = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    every = expand_counted(counted, "n", "copy").drop("n")
    units, classes = _by_class(every.where("size > 0"))
    units = materialize(units.withColumn("key", F.xxhash64("doc_id", "size", "copy", F.lit(seed))), "mix-units")
    rate = F.col("target") / F.col("source_size")
    base = F.least(F.floor(rate), F.lit(int(CAP))).cast("int")
    state = materialize(targets.where("source_size > 0").select("source", base.alias("base"), F.greatest(F.lit(0.0), rate - base).alias("p")), "mix-state")
    settled = []
    # at most one row a class
    for c, most in sorted(((r["class"], r.most) for r in classes.groupBy("class").agg(F.max("docs").alias("most")).collect()), reverse=True):
        here = classes.where(F.col("class") == c)
        now = state.select(F.col("source").alias("_s"), "base", "p").join(here.select(F.col("source").alias("_t"), "docs"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
        wide = units.where(F.col("class") == c).join(now, _same("source", "_s"))
        level = wide.withColumn("block", F.pmod("key", F.ceil(F.col("docs") / (FAN_IN // 2)).cast("long"))).select("source", "block", "key", "doc_id", "copy", "size", "base", "p")
        done, last = _fold_class(level, most, seed, f"class-{c}")
        met = materialize(_met(state, last, here, seed), f"mix-met-{c}")
        coin = F.when((F.col("q") == 1.0) | ((F.col("q") > 0.0) & (uniform(F.col("key"), F.lit(seed), F.lit("last")) < F.col("q"))), 1.0).otherwise(0.0)
        settled += [*done, _settled(met), met.where("key IS NOT NULL").select("source", "key", "doc_id", "copy", "size", "base", coin.alias("p"))]
        state = met.select("source", "base", "p")
    taken = every.where("size = 0").select("source", "doc_id", "copy", "size", F.lit(0).alias("copies"))
    for part in settled:
        taken = taken.unionByName(part.select("source", "doc_id", "copy", "size", (F.col("base") + F.col("p")).cast("int").alias("copies")))
    return taken


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"))


def mix_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies of every row of ``docs``.

    Null text has size 0 and is not taken; null sources are one source, the last; equal rows are rounded one by one; an
    empty table gives an empty result; other columns are ignored. The table of sources (one row each) is joined by what
    Spark finds best for its size.
    """
    sizes = materialize(document_sizes(docs), "mix-sizes")
    targets = materialize(source_targets(sizes), "mix-targets")
    copies = pivotal_copies(sizes, targets, seed)
    named = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return copies.join(named, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "copies"
    )


def mixed_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns unchanged.

    Rows that agree in doc_id, source and size are numbered and matched to the copies drawn for them.
    """
    sizes = materialize(document_sizes(docs), "mix-sizes")
    targets = materialize(source_targets(sizes), "mix-targets")
    drawn = pivotal_copies(sizes, targets, seed).where("copies > 0")
    drawn = drawn.select(F.col("doc_id").alias("__mix_d"), F.col("source").alias("__mix_s"), F.col("size").alias("__mix_n"), F.col("copy").alias("__mix_c"), F.col("copies").alias("__mix_k"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = docs.withColumn("__mix_size", size)
    alike = not sizes.groupBy("doc_id", "source", "size").count().where("count > 1").isEmpty()
    same = Window.partitionBy("doc_id", "source", "__mix_size").orderBy(F.xxhash64("text"))
    numbered = sized.withColumn("__mix_copy", (F.row_number().over(same) - 1).cast("long") if alike else F.lit(0).cast("long"))
    on = F.col("doc_id").eqNullSafe(F.col("__mix_d")) & F.col("source").eqNullSafe(F.col("__mix_s")) & (F.col("__mix_size") == F.col("__mix_n")) & (F.col("__mix_copy") == F.col("__mix_c"))
    return numbered.join(drawn, on).withColumn("__mix_i", F.explode(F.sequence(F.lit(1), F.col("__mix_k")))).select(*[F.col(c) for c in docs.columns])


def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))
