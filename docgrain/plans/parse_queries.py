"""Queries of the parsers: texts are written from numbers of the tables, so the true value is known."""

from __future__ import annotations

from pyspark.sql import functions as F

from docgrain.functions import domain, numbers, text
from docgrain.operators import records
from docgrain.plans.registry import Tables, query, spread

S = lambda c: c.cast("string")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS first, l_extendedprice AS second, 3::BIGINT AS found, round(l_quantity)::INT AS whole FROM lineitem")
def q_number_parse(spark, sf_dir):
    """Two amounts and a count in a line of text."""
    t = Tables(spark, sf_dir).lineitem
    line = F.concat(F.lit("数量　"), S(F.col("l_quantity")), F.lit(" 個, 金額 "), F.format_number("l_extendedprice", 2), F.lit("円（ー"), S(F.col("l_linenumber")), F.lit("）"))
    rows = t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", line.alias("s"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.num("s").alias("first"), numbers.num("s", 1).alias("second"), F.size(numbers.nums("s")).cast("long").alias("found"), numbers.int_of("s").alias("whole"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 2) AS m2, round(l_quantity * 3.30579, 2) AS tsubo, round(l_quantity * 1.62, 2) AS mats, round(l_quantity * 0.092903, 2) AS feet, round(l_quantity, 2) AS bare FROM lineitem""")
def q_unit_convert(spark, sf_dir):
    t = spread(Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    units = {"m2": "㎡", "tsubo": "坪", "mats": " 帖", "feet": " sq ft", "bare": ""}
    for name, unit in units.items():
        t = numbers.with_area_m2(t, name, F.concat(F.lit("約"), S(F.col("l_quantity")), F.lit(unit)))
    return t.drop("l_quantity")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS lo, l_quantity + 5 AS hi, l_quantity AS one_lo, l_quantity AS one_hi FROM lineitem")
def q_range_parse(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem
    pair = numbers.area_range_m2(F.concat(S(F.col("l_quantity") + 5), F.lit("㎡ 〜 "), S(F.col("l_quantity")), F.lit("㎡")))
    one = numbers.area_range_m2(F.concat(S(F.col("l_quantity")), F.lit("平米")))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", pair.alias("p"), one.alias("o")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"), F.col("o.lo").alias("one_lo"), F.col("o.hi").alias("one_hi"))


@query("""SELECT p_partkey, (p_size::BIGINT * 100000000 + p_partkey % 9000 * 10000)::DOUBLE AS amount, ((p_size + 1) * 10000)::DOUBLE AS small, p_partkey::DOUBLE AS yen,
(p_size * 10000)::DOUBLE AS lo, (p_size::BIGINT * 100000000)::DOUBLE AS hi FROM part""")
def q_money_parse(spark, sf_dir):
    size = F.col("p_size")
    rows = Tables(spark, sf_dir).part.select(
        "p_partkey", F.concat(S(size), F.lit("億"), F.format_number(F.col("p_partkey") % 9000, 0), F.lit("万円")).alias("a"), F.concat(F.format_number(size + 1, 0), F.lit(" 万円台")).alias("b"),
        F.concat(F.format_number("p_partkey", 0), F.lit("円")).alias("c"), F.concat(S(size), F.lit("万円 ～ "), S(size), F.lit("億円")).alias("d"),
    )
    both = numbers.money_range_jpy("d")
    return rows.select("p_partkey", numbers.money_jpy("a").alias("amount"), numbers.money_jpy("b").alias("small"), numbers.money_jpy("c").alias("yen"), both["lo"].alias("lo"), both["hi"].alias("hi"))


@query("""SELECT p_partkey, p_size % 5 + 1 AS bedrooms, CASE p_size % 5 WHEN 0 THEN '1pn' WHEN 1 THEN '2pn' WHEN 2 THEN '3pn' ELSE '4pn_plus' END || CASE WHEN p_partkey % 2 = 1 AND p_size % 5 < 2 THEN '_plus' ELSE '' END AS layout_class,
CASE WHEN p_partkey % 2 = 1 THEN true END AS has_multipurpose_room, CASE WHEN p_partkey % 3 = 0 THEN 'tim_tuong' WHEN p_partkey % 3 = 1 THEN 'thong_thuy' ELSE 'khong_ro' END AS basis FROM part""")
def q_layout_parse(spark, sf_dir):
    code = F.concat(S(F.col("p_size") % 5 + 1), F.lit("ldk"), F.when(F.col("p_partkey") % 2 == 1, " + S").otherwise(""))
    label = F.element_at(F.array(F.lit("壁芯面積"), F.lit("専有面積"), F.lit("面積")), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = Tables(spark, sf_dir).part.select("p_partkey", domain.layout(code).alias("l"), domain.area_basis(label).alias("basis"))
    return rows.select("p_partkey", F.col("l.bedrooms").alias("bedrooms"), F.col("l.layout_class").alias("layout_class"), F.col("l.has_multipurpose_room").alias("has_multipurpose_room"), "basis")


@query("""SELECT o_orderkey, (o_orderkey % 60 + 1)::INT AS above, (o_orderkey % 4 + 1)::INT AS below, year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y-%m') AS period, strftime(o_orderdate, '%Y') || '-01' AS only_year,
CASE WHEN o_orderkey % 3 = 0 THEN 'dang_xay' WHEN year(o_orderdate) <= 1998 THEN 'da_ban_giao' END AS status FROM orders""")
def q_floor_year_period(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    rows = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.concat(F.lit("鉄筋 地上"), S(key % 60 + 1), F.lit("階 地下"), S(key % 4 + 1), F.lit("階建")).alias("f"), F.concat(S(F.year(day)), F.lit("年"), S(F.month(day)), F.lit("月"), F.when(key % 3 == 0, "完成予定").otherwise("竣工")).alias("d"),
    )
    out = rows.select("o_orderkey", domain.floors("f").alias("fl"), domain.year("d").alias("year"), domain.period("d").alias("period"), domain.period(F.left("d", F.lit(5))).alias("only_year"), F.col("d"))
    return out.select("o_orderkey", F.col("fl.above").alias("above"), F.col("fl.below").alias("below"), "year", "period", "only_year", domain.status(F.col("year"), F.col("d"), F.lit(1998)).alias("status"))


@query("""SELECT s_suppkey, '株式会社' IS NULL AS unused, 's' || s_suppkey || '株式会社; n' || s_nationkey || '有限会社' AS companies, '第' || (s_suppkey % 23 + 1) || '区' AS district,
CASE WHEN s_nationkey BETWEEN 3 AND 24 THEN s_nationkey * 10.0::DOUBLE WHEN s_nationkey > 0 THEN s_nationkey * 10.0::DOUBLE END AS height_m, CASE WHEN s_nationkey BETWEEN 2 AND 6 THEN s_nationkey::DOUBLE END AS ceiling_m,
round((s_suppkey % 90 + 1) / 30.0, 3) AS parking_ratio FROM supplier""")
def q_building_facts(spark, sf_dir):
    """Company names, district, heights and parking in notices written from each supplier."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    rows = Tables(spark, sf_dir).supplier.select(
        "s_suppkey", F.concat(F.lit("売主/s"), S(key), F.lit("株式会社(免許1) 代理:n"), S(nation), F.lit("有限会社、s"), S(key), F.lit("株式会社")).alias("c"), F.concat(F.lit("東京都 第"), S(key % 23 + 1), F.lit("区中央1-1")).alias("a"),
        F.concat(F.lit("高さ約"), S(nation * 10), F.lit("m")).alias("h"), F.concat(F.lit("天井高："), S(nation * 1000), F.lit("mm")).alias("t"), F.concat(S(key % 90 + 1), F.lit("台")).alias("p"),
    )
    return rows.select("s_suppkey", F.lit(False).alias("unused"), domain.companies("c").alias("companies"), domain.district("a").alias("district"), domain.height_m("h").alias("height_m"), domain.ceiling_m("t").alias("ceiling_m"), domain.parking_ratio("p", F.lit(30)).alias("parking_ratio"))


@query("""WITH k AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS base FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS n FROM k)
SELECT p_partkey, base, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS key FROM n""")
def q_slug_key(spark, sf_dir):
    rows = Tables(spark, sf_dir).part.select("p_partkey", text.slug("p_name").alias("base"))
    return records.unique_keys(rows, "base", ["p_partkey"], "key")


@query("""SELECT event_id, event_type, (props->>'k')::INT AS k, round(value * ((props->>'k')::INT), 2) AS weighted FROM events""")
def q_json_extract(spark, sf_dir):
    """The object inside a sentence, a fence or alone."""
    form = F.col("event_id") % 3
    said = F.when(form == 0, F.col("props")).when(form == 1, F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\n"))).otherwise(F.concat(F.lit("so "), "props", F.lit(" it is")))
    rows = Tables(spark, sf_dir).events.select("event_id", "event_type", "value", text.tolerant_json(said, "k int").alias("j"))
    return rows.select("event_id", "event_type", F.col("j.k").alias("k"), F.round(F.col("value") * F.col("j.k"), 2).alias("weighted"))


@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END AS kind, CASE WHEN event_id % 4 <> 0 THEN round((props->>'k')::INT)::BIGINT END AS k,
CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag, (CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 1 ELSE 0 END + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 3 = 2 THEN 1 ELSE 0 END)::BIGINT AS rejects FROM events""")
def q_coerce_rejects(spark, sf_dir):
    """Texts coerced by kind; what does not fit is a reject, counted for each row."""
    k = F.get_json_object("props", "$.k")
    raw = Tables(spark, sf_dir).events.select(
        "event_id", F.col("event_type").alias("kind"), F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("k"), k)).otherwise(F.concat(F.lit(" "), k)).alias("k"),
        F.element_at(F.array(F.lit("Yes"), F.lit("0"), F.lit("maybe")), (F.col("event_id") % 3 + 1).cast("int")).alias("flag"),
    )
    kinds = {"kind": ("enum", ["click", "view", "purchase"]), "k": ("int",), "flag": ("bool",)}
    out, rejects = records.coerced(raw, kinds)
    counted = records.reject_warnings(raw, "event_id", kinds).groupBy("event_id").agg(F.count("*").alias("rejects"))
    return out.join(counted, "event_id", "left").withColumn("rejects", F.coalesce("rejects", F.lit(0)))
