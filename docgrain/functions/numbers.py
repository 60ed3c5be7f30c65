"""Numbers, areas, money and ratios in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgrain.functions.text import clean, clean_literal, let, with_clean

#: The patterns of numbers and of the marks of a range.
NUMBER = r"[-+]?\d[\d,]*(?:\.\d+)?"
RANGE_MARK = r"[~〜～]|\bto\b|—|–"
#: Square metres in one unit of area.
AREA_UNITS = {
    "m2": 1.0, "㎡": 1.0, "m²": 1.0, "平米": 1.0, "平方メートル": 1.0, "sqm": 1.0,
    "坪": 3.30579, "평": 3.30579,
    "帖": 1.62, "畳": 1.62, "j": 1.62,
    "sqft": 0.092903, "sq ft": 0.092903, "ft2": 0.092903, "ft²": 0.092903,
}
#: Money words of further markets, as a table to join (unit, currency, factor).
MONEY_UNITS = [("億円", "JPY", 1e8), ("万円", "JPY", 1e4), ("円", "JPY", 1.0), ("억원", "KRW", 1e8), ("万元", "CNY", 1e4), ("tỷ", "VND", 1e9), ("triệu/m²", "VND", 1e6)]


def to_number(s: Column) -> Column:
    return F.replace(s, F.lit(","), F.lit("")).try_cast("double")


def nums(c: Column | str, cleaned: bool = False) -> Column:
    s = c if cleaned else clean(c)
    return F.filter(F.transform(F.regexp_extract_all(s, F.lit(NUMBER), F.lit(0)), to_number), lambda x: x.isNotNull())


def num(c: Column | str, index: int = 0) -> Column:
    return F.get(nums(c), F.lit(index))


def int_of(c: Column | str, index: int = 0) -> Column:
    return F.round(num(c, index)).cast("int")


def _area_units() -> list[tuple[str, float]]:
    """Words and factors, longest word first."""
    return [(clean_literal(u).lower(), AREA_UNITS[u]) for u in sorted(AREA_UNITS, key=lambda u: -len(u))]


def _area(s: Column) -> Column:
    units = F.array(*[F.struct(F.lit(word).alias("word"), F.lit(factor).alias("factor")) for word, factor in _area_units()])

    def of(low: Column) -> Column:
        # units are looked for as plain text; numbers only before those that are there
        held = F.filter(units, lambda u: F.instr(low, u["word"]) > 1)
        before = lambda u: F.try_element_at(nums(F.substr(low, F.lit(1), F.instr(low, u["word"]) - 1), cleaned=True), F.lit(-1))
        found = F.array_compact(F.transform(held, lambda u: F.round(before(u) * u["factor"], 2)))
        return F.coalesce(F.get(found, F.lit(0)), F.get(nums(s, cleaned=True), F.lit(0)))

    return let(F.lower(s), of)


def area_m2(c: Column | str) -> Column:
    """Square metres: the number before the longest unit that has one; without a unit the first number."""
    return let(clean(c), _area)


def with_area_m2(rows: DataFrame, name: str, text: Column) -> DataFrame:
    """``area_m2`` of a text as a column, for large tables: in steps of plain expressions, which Spark compiles, unlike functions
    over arrays. The longest unit held decides; only a text without a number before it needs the whole rule."""
    units, low, unit = _area_units(), F.col("_low"), F.col("_unit")
    held = F.coalesce(*[F.when(F.contains(low, F.lit(word)), i) for i, (word, _) in enumerate(units)])
    words, factors = (F.array(*[F.lit(u[k]) for u in units]) for k in (0, 1))
    before = F.coalesce(F.call_function("substring_index", low, F.get(words, unit), F.lit(1)), low)
    x = to_number(F.try_element_at(F.regexp_extract_all(before, F.lit(NUMBER), F.lit(0)), F.when(unit.isNull(), 1).otherwise(-1)))
    rows = with_clean(rows, "_low", text).withColumn("_low", F.lower("_low")).withColumn("_unit", held).withColumn("_x", x)
    value = F.when(unit.isNull(), F.col("_x")).otherwise(F.coalesce(F.round(F.col("_x") * F.get(factors, unit), 2), _area(low)))
    return rows.withColumn(name, value).drop("_low", "_unit", "_x")


def _range(parts: Column, parse) -> Column:
    values = F.filter(F.transform(F.filter(parts, lambda p: F.trim(p) != ""), parse), lambda v: v.isNotNull())
    return let(values, lambda v: F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi")))


def area_range_m2(c: Column | str) -> Column:
    return _range(F.split(clean(c), RANGE_MARK), lambda p: let(F.trim(p), _area))


def _money(s: Column) -> Column:
    amount = lambda unit: to_number(F.regexp_extract(s, rf"([\d,]+(?:\.\d+)?)\s*{unit}", 1))
    oku, man = amount("億"), amount("万")
    large = F.round(F.coalesce(oku * 1e8, F.lit(0.0)) + F.coalesce(man * 1e4, F.lit(0.0)), 2)
    return F.when(oku.isNotNull() | man.isNotNull(), large).otherwise(amount("円"))


def money_jpy(c: Column | str) -> Column:
    """Yen: hundred millions and ten thousands add up; else the number before 円."""
    return let(clean(c), _money)


def money_range_jpy(c: Column | str) -> Column:
    return _range(F.split(clean(c), RANGE_MARK), _money)


def percent(part: Column, whole: Column) -> Column:
    """Null for a missing or zero whole."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def per_elevator(units: Column, elevators: Column) -> Column:
    return F.round(F.try_divide(F.nullif(units, F.lit(0)), elevators), 2)


def floors_in_range(c: Column) -> Column:
    """``5-20`` has 16 floors, ``7`` one, words none."""

    def parse(s: Column) -> Column:
        lo, hi = (F.regexp_extract(s, r"^(\d+)\s*[-~]\s*(\d+)$", k).try_cast("int") for k in (1, 2))
        return F.coalesce(F.abs(hi - lo) + 1, F.when(s.rlike(r"^\d+$"), F.lit(1)))

    return let(clean(c), parse)


def average_price(avg: Column, lo: Column, hi: Column) -> Column:
    return F.coalesce(avg, (lo + hi) / 2, lo, hi)


def with_money_factor(rows: DataFrame, unit: str, amount: str) -> DataFrame:
    """``currency`` and ``value`` of amounts by their money word: a join with the table of units, one row a word."""
    units = rows.sparkSession.createDataFrame(MONEY_UNITS, "_unit string, currency string, _factor double")
    joined = rows.join(units, rows[unit] == units["_unit"], "left")
    return joined.withColumn("value", F.col(amount) * F.col("_factor")).drop("_unit", "_factor")
