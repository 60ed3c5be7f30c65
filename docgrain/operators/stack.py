"""The stacked output: union of tables with evidence, carrying over, folding of entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.functions.text import blank_to_null, name_key
from docgrain.sources.sinks import as_cells


def stack(tables: dict[str, DataFrame], labels: dict[str, Column], short: dict[str, str], keys: dict[str, str]) -> DataFrame:
    """One row a record of any table, with its table, key and label; columns are the union of all, as cells."""
    parts = []
    for name, rows in tables.items():
        head = [F.lit(short[name]).alias("bang"), F.lit(name).alias("bang_ten"), F.col(keys[name]).cast("string").alias("record_key"), labels[name].alias("record_label")]
        parts.append(as_cells(rows.select(*head, *rows.columns)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def record_label(*parts: Column) -> Column:
    return F.concat_ws(" · ", *[blank_to_null(p.cast("string")) for p in parts])


def with_type_label(rows: DataFrame, types: DataFrame) -> DataFrame:
    """The code of a row's type for its label; the whole building without one."""
    named = types.select("unit_type_id", F.col("type_code").alias("type_label"))
    return rows.join(named, "unit_type_id", "left").withColumn("type_label", F.coalesce("type_label", F.lit("whole building")))


def stack_order(column: str = "bang") -> Column:
    """Position of a table in the stack; unknown ones come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for _, s in schemas.STACK.values()]), F.col(column)), F.lit(0)), F.lit(len(schemas.STACK) + 1))


def evidence_rollup(provenance: DataFrame, key: list[str]) -> DataFrame:
    """Of each record the weakest confidence, the distinct sources, and the evidence of each field as JSON (the last counts)."""
    rank = F.coalesce(*[F.when(F.col("confidence") == c, F.lit(r)) for c, r in (("high", 3), ("medium", 2), ("low", 1))], F.lit(0))
    last = provenance.withColumn("_n", F.row_number().over(Window.partitionBy(*key, "field").orderBy(F.desc("ord")))).where("_n = 1")
    weakest = provenance.groupBy(*key).agg(F.min_by("confidence", rank).alias("confidence"), F.array_join(F.array_sort(F.collect_set(blank_to_null("source_url"))), "; ").alias("source_urls"))
    entry = F.struct(F.col("field").alias("key"), F.struct("source_url", "snippet", "confidence").alias("value"))
    fields = last.groupBy(*key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("evidence_json"))
    return weakest.join(fields, key)


def with_evidence(records: DataFrame, rollup: DataFrame, key: list[str]) -> DataFrame:
    return records.join(rollup, key, "left")


def carry_over(old: DataFrame, new: DataFrame, key: str = "building_id", drop: tuple = ("evidence_json",)) -> DataFrame:
    """New rows and the old ones of ids that are not rebuilt; unknown old columns stay, at the end."""
    kept = old.drop(*drop).join(new.select(key).distinct(), key, "left_anti")
    return new.drop(*drop).unionByName(kept, allowMissingColumns=True)


def richness(columns: list[str]) -> Column:
    """How many cells of a row hold something."""
    return reduce(lambda a, b: a + b, [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull().cast("int") for c in columns])


def fold(rows: DataFrame, group: str, fields: list[str], rank: list) -> DataFrame:
    """One row a group: the richest as base, its blanks filled from the next ones in order of richness."""
    order = F.struct(*rank)
    return rows.groupBy(group).agg(*[F.min_by(F.col(f), F.when(F.nullif(F.trim(F.col(f).cast("string")), F.lit("")).isNotNull(), order)).alias(f) for f in fields], F.count("*").alias("versions"))


def fold_children(children: DataFrame, bases: DataFrame, key: str) -> DataFrame:
    """Children under the key of their group's base (key, base), distinct rows only."""
    return children.join(bases, key).drop(key).withColumnRenamed("base", key).dropDuplicates()


def fold_buildings(buildings: DataFrame, children: dict[str, DataFrame], fields: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Folding by id, then by normalised name: the richest version is the base and gives the id."""
    ranked = buildings.withColumn("_r", -richness(fields))
    by_id = fold(ranked.select("building_id", "_r", *[f for f in fields if f != "building_id"]), "building_id", [f for f in fields if f != "building_id"], ["_r"])
    named = by_id.withColumn("name_key", F.coalesce(blank_to_null(name_key("building_name")), F.col("building_id"))).withColumn("_r", -richness(fields))
    folded = fold(named.drop("versions"), "name_key", fields, ["_r", "building_id"])
    base = F.min_by("building_id", F.struct("_r", "building_id")).over(Window.partitionBy("name_key"))
    bases = named.select("building_id", base.alias("base"))
    return folded, {name: fold_children(rows, bases, "building_id") for name, rows in children.items()}


def orphans(rows: DataFrame, buildings: DataFrame, key: str = "building_id") -> DataFrame:
    """Ids that have rows but no building, with the reason why they are rejected."""
    return rows.select(key).distinct().join(buildings.select(key).distinct(), key, "left_anti").select(key, F.lit("no building record").alias("reason"))


def report_page(rows: DataFrame, sort: list[Column], page: int = 0, size: int = 50) -> DataFrame:
    """A page of a report: rows in the wanted order, ties by completeness, then by name."""
    ordered = rows.orderBy(*sort, F.desc("completeness"), F.lower("building_name"))
    return ordered.offset(page * size).limit(size)


def newest_stamp(rows: DataFrame, column: str = "extracted_at") -> DataFrame:
    return rows.agg(F.max(column).alias("newest"))
