"""Typed records: coercion with rejects, sanitising, coalescing merge, keys, foreign keys, provenance.

Both sides of the joins here grow with the records. They ask for a merge: what Spark estimates of a few columns of a well
compressed table is far below what its rows take, and a broadcast would gather them in the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgrain.functions.text import true_word

CONFIDENCE_RANK = {"high": 3, "medium": 2, "low": 1}


def project(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The declared columns in order; absent ones are null."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def coerce(c: Column, kind: str, vocabulary: list[str] | None = None) -> Column:
    """A text as ``kind`` (str, float, int, bool, enum, list), or null if it is none."""
    if kind == "enum":
        return F.when(F.trim(c).isin(vocabulary or []), F.trim(c))
    if kind == "float":
        return F.trim(c).try_cast("double")
    if kind == "int":
        return F.round(F.trim(c).try_cast("double")).cast("long")
    if kind == "bool":
        return true_word(c)
    if kind == "list":
        return F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    return F.nullif(F.trim(c), F.lit(""))


def coerced(df: DataFrame, kinds: dict[str, tuple]) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """``df`` with its columns coerced, and for each the condition (on the input) of a reject."""
    out = {name: coerce(F.col(name), *how) for name, how in kinds.items()}
    rejects = [(name, F.col(name).isNotNull() & (F.trim(name) != "") & out[name].isNull()) for name in kinds]
    return df.withColumns(out), rejects


def reject_warnings(df: DataFrame, key: str, kinds: dict[str, tuple]) -> DataFrame:
    """key, field, raw of every value that is not of its kind."""
    _, rejects = coerced(df, kinds)
    items = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("raw"))) for name, bad in rejects]))
    return df.select(key, F.explode(items).alias("w")).select(key, "w.field", "w.raw")


def unknown_fields(raw: DataFrame, key: str, fields: str, declared: list[str]) -> DataFrame:
    """Fields of a map column that the schema does not know."""
    return raw.select(key, F.explode(F.array_except(F.map_keys(fields), F.array(*[F.lit(x) for x in declared]))).alias("field"))


def one_provenance(provenance: DataFrame, key: list[str], filled: DataFrame) -> DataFrame:
    """Of each filled field exactly one evidence row, the first; the confidence is medium if it is not one of the three."""
    rows = provenance.withColumn("confidence", F.when(F.col("confidence").isin(*CONFIDENCE_RANK), F.col("confidence")).otherwise("medium"))
    kept = rows.join(filled.select(*key, "field").distinct(), [*key, "field"], "left_semi")
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy(*key, "field").orderBy("ord"))).where("_n = 1").drop("_n")


def coalesce_merge(rows: DataFrame, key: list[str], fields: list[str], order: list[str], provenance: str | None = None, first: str | None = None) -> DataFrame:
    """One row a key: of each field the first value that is not null, with the evidence that came with it; ``first`` names a
    column for the place of the key's first row."""
    rank = F.struct(*order)
    pick = [F.min(rank).alias(first)] if first else []
    for f in fields:
        ord_ = F.when(F.col(f).isNotNull(), rank)
        pick.append(F.min_by(f, ord_).alias(f))
        if provenance:
            pick.append(F.min_by(provenance, ord_).alias(f"{f}_{provenance}"))
    keyed = rows.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k, t in rows.dtypes if k in key and t == "string"})
    return keyed.groupBy(*key).agg(*pick) if pick else keyed.select(*key).distinct()


def unique_keys(rows: DataFrame, base: str, order: list[str], out: str) -> DataFrame:
    """Repeated keys get _2, _3, ... in order: the first row of a key keeps it, each further one gets the next number whose
    name is no real key. Made keys of different bases never meet, as the name before the number tells them apart."""
    numbered = rows.withColumn("_k", F.row_number().over(Window.partitionBy(base).orderBy(*order)))
    several = rows.groupBy(base).count().where("count > 1").select(F.col(base).alias("_b"))
    part = lambda k: F.regexp_extract(base, r"(?s)^(.*)_([1-9]\d{0,8})$", k)
    real = rows.select(base).distinct().select(part(1).alias("_b"), part(2).try_cast("int").alias("_i")).where("_i >= 2")
    taken = real.join(several.hint("merge"), "_b").groupBy("_b").agg(F.array_sort(F.collect_list("_i")).alias("_taken"))
    joined = numbered.join(taken.hint("merge"), numbered[base] == F.col("_b"), "left")
    number = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_k"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    return joined.withColumn(out, F.when(F.col("_k") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), number))).drop("_k", "_b", "_taken")


def resolve_foreign_key(rows: DataFrame, code: str, targets: DataFrame, target_code: str, target_id: str, order: str, scope: list[str] | None = None) -> DataFrame:
    """``target_id`` of each row by its code: exact (the last of equal codes), else in lower case without blanks around."""
    scope = scope or []
    exact = targets.groupBy(*scope, F.col(target_code).alias("_code")).agg(F.max_by(target_id, order).alias("_exact"))
    loose = targets.groupBy(*scope, F.lower(F.trim(target_code)).alias("_low")).agg(F.max_by(target_id, order).alias("_loose"))
    keyed = rows.withColumn("_code", F.col(code)).withColumn("_low", F.lower(F.trim(code)))
    joined = keyed.join(exact.hint("merge"), [*scope, "_code"], "left").join(loose.hint("merge"), [*scope, "_low"], "left")
    return joined.withColumn(target_id, F.coalesce("_exact", "_loose")).drop("_code", "_low", "_exact", "_loose")


def override(rows: DataFrame, better: DataFrame, key: list[str]) -> DataFrame:
    """``better`` and those of ``rows`` whose key, compared null-safe, it does not have."""
    other = better.select(*[F.col(k).alias(f"_o_{k}") for k in key]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in key])
    return rows.join(other.hint("merge"), same, "left_anti").unionByName(better, allowMissingColumns=True)


def fallback(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``rows`` and, for keys that have none, those of ``other``."""
    return rows.unionByName(other.join(rows.select(key).distinct().hint("merge"), key, "left_anti"), allowMissingColumns=True)


def file_index(sources: DataFrame) -> DataFrame:
    """file, url, accessed_at: a source answers for its text, raw, screenshot and floor-plan files."""
    files = F.filter(F.concat(F.array("text_file", "raw_file", "shot_file"), F.coalesce("floorplan_files", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != ""))
    return sources.select("building_id", F.explode(files).alias("file"), "url", "accessed_at")


def with_source(provenance: DataFrame, index: DataFrame) -> DataFrame:
    """Evidence with its URL: by the exact path, else by the file's name."""
    exact = index.groupBy("building_id", "file").agg(F.first("url").alias("_u1"), F.first("accessed_at").alias("_a1"))
    named = index.withColumn("_base", F.element_at(F.split("file", "/"), -1)).groupBy("building_id", "_base").agg(F.first("url").alias("_u2"), F.first("accessed_at").alias("_a2"))
    rows = provenance.withColumn("_base", F.element_at(F.split("source_file", "/"), -1)).join(exact.withColumnRenamed("file", "source_file"), ["building_id", "source_file"], "left")
    joined = rows.join(named, ["building_id", "_base"], "left")
    return joined.withColumn("source_url", F.coalesce("_u1", "_u2")).withColumn("accessed_at", F.coalesce("_a1", "_a2")).drop("_base", "_u1", "_u2", "_a1", "_a2")


def filled_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, value of every field that holds something."""
    item = F.array_compact(F.array(*[F.when(F.nullif(F.trim(F.col(f).cast("string")), F.lit("")).isNotNull(), F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))) for f in fields]))
    return rows.select(key, F.explode(item).alias("x")).select(key, "x.field", "x.value")


def resolve_ids(queries: DataFrame, overrides: DataFrame, index: DataFrame, saved: DataFrame, slug: Column) -> DataFrame:
    """building_id of each query: given by hand, processed before, saved with its sources, else its slug."""
    named = lambda df, c: df.select("query", F.col("building_id").alias(c)).dropDuplicates(["query"])
    joined = queries.join(named(overrides, "_a"), "query", "left").join(named(index, "_b"), "query", "left").join(named(saved, "_c"), "query", "left")
    return joined.withColumn("building_id", F.coalesce("_a", "_b", "_c", slug)).drop("_a", "_b", "_c")


def run_selection(ids: DataFrame, only: DataFrame | None, done: DataFrame, key: str = "building_id") -> DataFrame:
    """key, state of every id that is wanted: ``run``, ``done``, or ``absent`` where it was asked for and never crawled.

    The three lists meet in one sum of marks by id; without ``only`` all ids are wanted.
    """
    marked = lambda df, n: df.select(key, *[F.lit(i == n).alias(c) for i, c in enumerate(("_known", "_asked", "_done"))])
    marks = [marked(ids, 0), marked(ids if only is None else only, 1), marked(done, 2)]
    summed = reduce(DataFrame.unionByName, marks).groupBy(key).agg(*[F.max(c).alias(c) for c in ("_known", "_asked", "_done")])
    state = F.when(~F.col("_known"), "absent").when(F.col("_done"), "done").otherwise("run")
    return summed.where("_asked").select(key, state.alias("state"))


def select_run(ids: DataFrame, only: DataFrame | None, done: DataFrame, limit: int | None, key: str = "building_id") -> DataFrame:
    """Wanted rows of ``ids`` that are not done, in order, at most ``limit``; ``run_selection`` also tells which are done or absent."""
    rows = ids if only is None else ids.join(only.select(key).distinct(), key, "left_semi")
    rows = rows.join(done.select(key).distinct(), key, "left_anti").orderBy(key)
    return rows if limit is None else rows.limit(limit)


def is_done(ok: Column, needed: int, exists: Column) -> Column:
    return F.coalesce(exists, F.lit(False)) | (F.coalesce(ok, F.lit(0)) >= F.greatest(F.lit(1), F.lit(needed)))
