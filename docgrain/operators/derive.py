"""Derived columns and rollups: area bounds, dominant class, bedroom mix, price indices, counts, completeness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weight(units: str, share: str, otherwise: float) -> Column:
    """Units, else share, else a constant; zero counts as missing."""
    return F.coalesce(F.nullif(F.col(units).cast("double"), F.lit(0.0)), F.nullif(F.col(share).cast("double"), F.lit(0.0)), F.lit(otherwise))


def bounds_with_fallback(rows: DataFrame, key: str, main: str, other: str) -> DataFrame:
    """Least and largest ``main``; those of ``other`` only where a key has no ``main`` at all."""
    return rows.groupBy(key).agg(F.coalesce(F.min(main), F.min(other)).alias("lo"), F.coalesce(F.max(main), F.max(other)).alias("hi"))


def weighted_mode(rows: DataFrame, key: str, value: str, by: Column, order: Column | str) -> DataFrame:
    """The value of the largest total weight; ties go to the one seen first."""
    totals = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(by).alias("_w"), F.min(order).alias("_first"))
    return totals.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_w"), F.col("_first"))).alias("mode"))


def mix_percent(rows: DataFrame, key: str, part: str, by: Column) -> DataFrame:
    """key, part, pct: shares of the weight, to one place; keys without weight have none."""
    totals = rows.where(F.col(part).isNotNull()).groupBy(key, part).agg(F.sum(by).alias("_w"))
    total = F.sum("_w").over(Window.partitionBy(key))
    return totals.withColumn("pct", F.round(F.try_divide(F.col("_w"), total) * 100, 1)).where("pct IS NOT NULL").select(key, part, "pct")


def mix_map(mix: DataFrame, key: str, part: str) -> DataFrame:
    entry = F.struct(F.col(part).cast("string").alias("key"), F.col("pct").alias("value"))
    return mix.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("mix"))


def distinct_list(c: str | Column) -> Column:
    """Sorted distinct values; null instead of none."""
    values = F.array_sort(F.collect_set(c))
    return F.when(F.size(values) > 0, values)


def highlights(order: str, name: str, most: int = 8) -> Column:
    """The first names in order. The order keeps at most ``most`` rows of a key before they are gathered: use ``top_rows``."""
    return F.transform(F.slice(F.array_sort(F.collect_list(F.struct(order, name))), 1, most), lambda s: s[name])


def top_rows(rows: DataFrame, key: list[str], order: list, k: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def child_counts(parent: DataFrame, key: str, children: dict[str, DataFrame]) -> DataFrame:
    """How many rows each child has of a key; children are counted before the join."""
    counted = reduce(lambda df, c: df.join(c[1].groupBy(key).agg(F.count("*").alias(c[0])), key, "left"), children.items(), parent)
    return counted.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in children})


def usd_per_m2(rows: DataFrame, fx: DataFrame) -> DataFrame:
    """Rates are joined by currency; only prices a square metre become dollars a square metre."""
    joined = rows.join(fx.withColumnRenamed("usd_rate", "fx_rate_to_usd"), "currency", "left")
    value = F.when(F.col("price_unit") == "per_m2", F.round(F.col("price_avg") * F.nullif(F.col("fx_rate_to_usd"), F.lit(0.0)), 2))
    return joined.withColumn("price_usd_per_m2", value)


def exact_ratio(part: Column, whole: Column, places: int) -> Column:
    """``part / whole`` of whole numbers, rounded half up to ``places`` in whole numbers too, so ties do not hang on the last bit."""
    of = F.nullif(F.abs(whole), F.lit(0).cast("decimal(38,0)"))
    size = F.call_function("div", F.abs(part) * F.lit(2 * 10**places) + of, of * 2)
    return F.when(F.signum(part) * F.signum(whole) < 0, -size).otherwise(size) / 10**places


def price_index(rows: DataFrame, key: str, primary: str = "so_cap", secondary: str = "thu_cap") -> DataFrame:
    """Mean dollars of both markets, and the premium of the second where both have one and the same basis and tax.

    Prices are summed as whole millionths of a dollar, so no order of summing changes a mean; what is no finite number, or has
    more than 15 digits before its point, is no price.
    """
    price = F.nullif(F.col("price_usd_per_m2"), F.lit(0.0)).try_cast("decimal(21,6)")
    priced, millionths = price.isNotNull(), (price * 1_000_000).cast("decimal(21,0)")
    of = lambda f, m: f(F.when(F.col("market") == m, millionths)).cast("decimal(38,0)")
    kinds = F.count_distinct(F.when(priced & F.col("market").isin(primary, secondary), F.struct("price_basis", "includes_vat")))
    agg = rows.groupBy(key).agg(*[of(f, m).alias(c) for m, cs in ((primary, ("_p", "_np")), (secondary, ("_s", "_ns"))) for f, c in zip((F.sum, F.count), cs)], kinds.alias("_k"))
    dollars = lambda total, n: exact_ratio(F.col(total), F.col(n) * 1_000_000, 1)
    base = F.col("_p") * F.col("_ns")
    premium = F.when(F.col("_k") == 1, exact_ratio((F.col("_s") * F.col("_np") - base) * 100, base, 1))
    return agg.select(key, dollars("_p", "_np").alias("usd_primary"), dollars("_s", "_ns").alias("usd_secondary"), premium.alias("premium_pct"))


def growth_yoy(rows: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Change of the yearly mean in percent, of the last year, only if the year before it is there."""
    yearly = rows.groupBy(key, year).agg(F.avg(value).alias("_m"))
    order = Window.partitionBy(key).orderBy(year)
    before = yearly.withColumn("_y0", F.lag(year).over(order)).withColumn("_m0", F.lag("_m").over(order))
    last = before.groupBy(key).agg(F.max_by(F.struct(F.col(year).alias("y"), "_m", "_y0", "_m0"), year).alias("l"))
    change = F.when(F.col("l.y") - F.col("l._y0") == 1, F.round((F.try_divide(F.col("l._m"), F.col("l._m0")) - 1) * 100, 1))
    return last.select(key, F.col("l.y").alias("last_year"), change.alias("growth_pct"))


def manifest_rollup(sources: DataFrame) -> DataFrame:
    return sources.groupBy("building_id").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.sum(F.greatest(F.lit(0), F.size(F.coalesce("floorplan_files", F.array().cast("array<string>"))))).alias("images"))


def completeness(filled: Column, fields: int, children: dict[str, tuple[str, int]], conf: Column) -> Column:
    """0 to 100: 45 % key fields, 35 % children against their targets, 20 % confidence (1.0, 0.6, 0.25)."""
    reached = [F.least(F.col(c).cast("double") / target, F.lit(1.0)) for c, target in children.values()]
    level = F.when(conf == "high", 1.0).when(conf == "medium", 0.6).when(conf == "low", 0.25).otherwise(0.0)
    return F.round(45 * filled / fields + 35 * reduce(lambda a, b: a + b, reached) / len(reached) + 20 * level, 1)


def usage_rollup(calls: DataFrame, cost: Column) -> DataFrame:
    """Totals of each step (the label before the colon) and, with step null, of all; largest traffic first."""
    step = F.substring_index("label", ":", 1)
    out = calls.withColumn("step", step).withColumn("cost", cost).rollup("step")
    return out.agg(*[F.sum(c).alias(c) for c in ("calls", "secs", "tokens_in", "tokens_out")], F.round(F.sum("cost"), 4).alias("cost"), F.grouping("step").cast("int").alias("is_total"))
