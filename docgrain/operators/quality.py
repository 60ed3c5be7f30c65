"""Data-quality rules: each gives rows (building_id, rule, record, message) and repairs nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgrain.functions.numbers import floors_in_range

#: Fields of buildings and the range that each must lie in.
BUILDING_RANGES = {"latitude": (-90, 90), "longitude": (-180, 180), "num_floors_above": (1, 200), "height_m": (3, 1000), "building_density_pct": (0, 100), "window_wall_ratio_pct": (0, 100)}
MANDATORY_PRICE = ["market", "currency", "price_unit", "price_basis", "period"]


def warning(rows: DataFrame, rule: str, bad: Column, record: str, *message, key: str = "building_id") -> DataFrame:
    parts = [m if isinstance(m, Column) else F.lit(m) for m in message]
    text = F.concat(*[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return rows.where(bad).select(F.col(key).alias("building_id"), F.lit(rule).alias("rule"), F.col(record).cast("string").alias("record"), text.alias("message"))


def key_problems(rows: DataFrame, key: str) -> DataFrame:
    """V1 for a whole table: rows, empty keys, surplus rows of repeated keys."""
    held = F.nullif(F.trim(F.col(key).cast("string")), F.lit(""))
    return rows.agg(F.count("*").alias("rows"), F.count_if(held.isNull()).alias("empty"), (F.count(held) - F.count_distinct(held)).alias("duplicate"))


def repeated_keys(rows: DataFrame, key: str, owner: str = "building_id") -> DataFrame:
    counted = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n"), F.min(owner).alias("_owner"))
    return warning(counted, "V1", F.col("_key").isNull() | (F.col("n") > 1), "_key", "key empty or repeated, rows: ", F.col("n"), key="_owner")


def sums_against(parts: DataFrame, key: str, value: Column) -> DataFrame:
    return parts.groupBy(key).agg(F.sum(value).alias("total"), F.count("*").alias("n"))


def room_rules(types: DataFrame, rooms: DataFrame) -> DataFrame:
    """V2 rooms larger than gross, V3 wall share outside 5 to 15 %, V4 bedrooms other than declared."""
    per = rooms.groupBy("unit_type_id").agg(F.sum("area_m2").alias("rooms_m2"), F.count_if(F.col("room_type").startswith("phong_ngu")).alias("beds"), F.count("*").alias("n"))
    rows = types.join(per, "unit_type_id")
    gap = (F.col("area_gross_m2") - F.col("rooms_m2")) / F.nullif(F.col("area_gross_m2"), F.lit(0.0)) * 100
    over = F.col("rooms_m2") > F.col("area_gross_m2")
    found = [
        warning(rows, "V2", over, "unit_type_id", "rooms ", F.round("rooms_m2", 1), " > gross ", F.col("area_gross_m2")),
        warning(rows, "V3", ~over & ~gap.between(5, 15), "unit_type_id", "walls ", F.round(gap, 1), " %"),
        warning(rows, "V4", (F.col("beds") > 0) & (F.col("beds") != F.col("bedrooms")), "unit_type_id", "bedrooms ", F.col("beds"), " of ", F.col("bedrooms")),
    ]
    return reduce(DataFrame.unionByName, found)


def total_rules(buildings: DataFrame, types: DataFrame, plates: DataFrame) -> DataFrame:
    """V5 units against the total (2 %), V6 shares against 100 (5), V7 floors times units against the total (15 %)."""
    t = types.groupBy("building_id").agg(F.sum("num_units_of_type").alias("units"), F.sum("share_of_total_pct").alias("share"))
    p = plates.groupBy("building_id").agg(F.sum(floors_in_range(F.col("floor_range")) * F.col("units_per_floor")).alias("by_floor"))
    rows = buildings.join(t, "building_id", "left").join(p, "building_id", "left")
    total = F.nullif(F.col("num_units_total"), F.lit(0))
    # sums of nothing are no statement
    off = lambda c, part: F.abs(F.nullif(F.col(c), F.lit(0)) - total) / total > part
    found = [
        warning(rows, "V5", off("units", 0.02), "building_id", "units ", F.col("units"), " of ", F.col("num_units_total")),
        warning(rows, "V6", F.abs(F.nullif(F.col("share"), F.lit(0)) - 100) > 5, "building_id", "shares sum to ", F.round("share", 1)),
        warning(rows, "V7", off("by_floor", 0.15), "building_id", "units by floor ", F.col("by_floor"), " of ", F.col("num_units_total")),
    ]
    return reduce(DataFrame.unionByName, found)


def type_rules(types: DataFrame) -> DataFrame:
    """V8 basis missing, V9 net over gross, V13 net areas of some types only."""
    some = types.groupBy("building_id").agg(F.count_if(F.col("area_net_m2").isNotNull()).alias("net"), F.count("*").alias("n"))
    found = [
        warning(types, "V8", F.col("area_basis_reported").isNull(), "unit_type_id", "area basis missing"),
        warning(types, "V9", F.col("area_net_m2") > F.col("area_gross_m2"), "unit_type_id", "net ", F.col("area_net_m2"), " > gross ", F.col("area_gross_m2")),
        warning(some, "V13", (F.col("net") > 0) & (F.col("net") < F.col("n")), "building_id", "net area of ", F.col("net"), " of ", F.col("n"), " types"),
    ]
    return reduce(DataFrame.unionByName, found)


def missing_fields(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """key, field of every mandatory field that is empty."""
    empty = F.filter(F.array(*[F.when(F.nullif(F.trim(F.col(f).cast("string")), F.lit("")).isNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return rows.select(*key, F.explode(empty).alias("field"))


def price_rules(prices: DataFrame) -> DataFrame:
    """V10 mandatory fields, V11 no value at all."""
    missing = missing_fields(prices, ["building_id", "price_id"], MANDATORY_PRICE)
    none = F.coalesce("price_min", "price_max", "price_avg").isNull()
    return warning(missing, "V10", F.lit(True), "price_id", "missing: ", F.col("field")).unionByName(warning(prices, "V11", none, "price_id", "no price"))


def out_of_range(rows: DataFrame, key: str, ranges: dict[str, tuple]) -> DataFrame:
    """key, field, value of every value outside its range."""
    item = F.array_compact(F.array(*[F.when(~F.col(f).between(lo, hi), F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value"))) for f, (lo, hi) in ranges.items()]))
    return rows.select(key, F.explode(item).alias("x")).select(key, "x.field", "x.value")


def building_rules(buildings: DataFrame) -> DataFrame:
    return warning(out_of_range(buildings, "building_id", BUILDING_RANGES), "V12", F.lit(True), "building_id", F.col("field"), " = ", F.col("value"))


def evidence_coverage(filled: DataFrame, provenance: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """V14: (filled fields without evidence, totals)."""
    proven = provenance.select(*key, "field").distinct()
    missing = filled.join(proven, [*key, "field"], "left_anti")
    marked = filled.select(*key, "field").distinct().join(proven.withColumn("_e", F.lit(1)), [*key, "field"], "left")
    totals = marked.agg(F.count("*").alias("filled"), F.count("_e").alias("proven"), F.round(F.try_divide(F.count("_e"), F.count("*")) * 100, 1).alias("pct"))
    return missing, totals


def assembly_warnings(dropped: DataFrame, unmatched: DataFrame, from_plans: DataFrame, buildings: DataFrame) -> DataFrame:
    """V15: types without a code, plans without a type, plates read from plans, buildings of several records."""
    several = buildings.groupBy("building_id").agg(F.count("*").alias("n"))
    found = [
        warning(dropped, "V15", F.lit(True), "building_id", "type without code dropped"),
        warning(unmatched, "V15", F.lit(True), "matched_type_code", "plan matches no type, rooms: ", F.size("rooms")),
        warning(from_plans, "V15", F.lit(True), "floor_range", "floor plate read from a plan"),
        warning(several, "V15", F.col("n") > 1, "building_id", "building records: ", F.col("n")),
    ]
    return reduce(DataFrame.unionByName, found)


def empty_notes(cells: DataFrame, records: DataFrame, pages: DataFrame) -> DataFrame:
    """V17: buildings whose sources only give ranges, and so no types, with what they say."""
    ranged = cells.where(F.contains("label", F.lit("専有面積")) & F.col("value").rlike("[~〜]")).groupBy("building_id").agg(F.min_by("value", F.struct("page_idx", "kv_idx")).alias("value"))
    bare = pages.select("building_id").distinct().join(records.select("building_id").distinct(), "building_id", "left_anti")
    return warning(bare.join(ranged, "building_id"), "V17", F.lit(True), "building_id", "only a range is published: ", F.left("value", F.lit(60)))


def drift(observed: DataFrame, declared: DataFrame, key: list[str]) -> DataFrame:
    """key, side: values seen but not declared (extra) and declared but not seen (missing)."""
    o, d = observed.select(*key).distinct().withColumn("_o", F.lit(1)), declared.select(*key).distinct().withColumn("_d", F.lit(1))
    return o.join(d, key, "full_outer").where("_o IS NULL OR _d IS NULL").select(*key, F.when(F.col("_d").isNull(), "extra").otherwise("missing").alias("side"))


KEYS = (("building", "building_id"), ("unit_type", "unit_type_id"), ("unit_room", "room_id"), ("floor_plate", "floor_plate_id"), ("handover_item", "handover_id"), ("amenity", "amenity_id"), ("price_obs", "price_id"))


def check(tables: dict[str, DataFrame]) -> DataFrame:
    """All rules over the assembled tables, as one plan.

    A table that is no file yet is read once for each rule that it has a part in; write it first. Keys of all tables are
    counted in one shuffle; rooms, which have no building of their own, are told without one.
    """
    owner = lambda t: "building_id" if "building_id" in tables[t].columns else None
    keys = reduce(DataFrame.unionByName, [tables[t].select(F.lit(t).alias("_table"), F.col(k).alias("_key"), (F.col(owner(t)) if owner(t) else F.lit(None).cast("string")).alias("building_id")) for t, k in KEYS])
    counted = keys.groupBy("_table", "_key").agg(F.count("*").alias("n"), F.min("building_id").alias("building_id"))
    held = F.nullif(F.trim(F.col("_key").cast("string")), F.lit(""))
    keyed = warning(counted, "V1", held.isNull() | (F.col("n") > 1), "_key", "key empty or repeated, rows: ", F.col("n"))
    rooms = room_rules(tables["unit_type"], tables["unit_room"])
    totals = total_rules(tables["building"], tables["unit_type"], tables["floor_plate"])
    return reduce(DataFrame.unionByName, [keyed, rooms, totals, type_rules(tables["unit_type"]), price_rules(tables["price_obs"]), building_rules(tables["building"])])
