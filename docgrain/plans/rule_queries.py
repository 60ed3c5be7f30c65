"""Queries of quality rules, warnings, text repairs, ratios and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docgrain.functions import domain, numbers, text
from docgrain.operators import cells, quality, records, stack, terms
from docgrain.plans import buildings
from docgrain.plans.registry import Tables, query
from docgrain.sources import readers, sinks


@query("""WITH t AS (SELECT l_orderkey AS id, sum(l_partkey % 30)::BIGINT AS units, sum(l_partkey % 60)::BIGINT AS share, sum(CASE l_linenumber % 3 WHEN 0 THEN 16 WHEN 1 THEN 1 END * (l_suppkey % 5))::BIGINT AS by_floor FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey AS id, (o_orderkey % 7) * 20 AS total, units, share, by_floor FROM orders LEFT JOIN t ON id = o_orderkey)
SELECT id AS building_id, 'V5' AS rule, id::VARCHAR AS record, 'units ' || units || ' of ' || total AS message FROM r WHERE units <> 0 AND total <> 0 AND abs(units - total) / total::DOUBLE > 0.02
UNION ALL SELECT id, 'V6', id::VARCHAR, 'shares sum to ' || share FROM r WHERE share <> 0 AND abs(share - 100) > 5
UNION ALL SELECT id, 'V7', id::VARCHAR, 'units by floor ' || by_floor || ' of ' || total FROM r WHERE by_floor <> 0 AND total <> 0 AND abs(by_floor - total) / total::DOUBLE > 0.15""")
def q_quality_totals(spark, sf_dir):
    """Orders as buildings, their lines as types and plates: units, shares and units by floor against the total."""
    t = Tables(spark, sf_dir)
    b = t.orders.select(F.col("o_orderkey").alias("building_id"), ((F.col("o_orderkey") % 7) * 20).alias("num_units_total"))
    types = t.lineitem.select(F.col("l_orderkey").alias("building_id"), (F.col("l_partkey") % 30).alias("num_units_of_type"), (F.col("l_partkey") % 60).alias("share_of_total_pct"))
    ranges = F.when(F.col("l_linenumber") % 3 == 0, "5-20").when(F.col("l_linenumber") % 3 == 1, "７").otherwise("mái")
    plates = t.lineitem.select(F.col("l_orderkey").alias("building_id"), ranges.alias("floor_range"), (F.col("l_suppkey") % 5).alias("units_per_floor"))
    return quality.total_rules(b, types, plates)


@query("""WITH r AS (SELECT p_partkey AS id, 'p' || p_partkey AS p, CASE WHEN p_size % 4 = 0 THEN ' ' ELSE 'so_cap' END AS market, CASE WHEN p_size % 9 = 0 THEN NULL ELSE '2026-05' END AS period FROM part)
SELECT id AS building_id, 'V10' AS rule, p AS record, 'missing: market' AS message FROM r WHERE trim(market) = '' UNION ALL SELECT id, 'V10', p, 'missing: period' FROM r WHERE period IS NULL
UNION ALL SELECT id, 'V11', p, 'no price' FROM r WHERE id % 6 = 0""")
def q_quality_prices(spark, sf_dir):
    """Prices without a mandatory field, and those without any value."""
    key = F.col("p_partkey")
    value = lambda k: F.when(key % 6 == k, key.cast("double"))
    rows = Tables(spark, sf_dir).part.select(
        key.alias("building_id"), F.concat(F.lit("p"), key.cast("string")).alias("price_id"), F.when(F.col("p_size") % 4 == 0, " ").otherwise("so_cap").alias("market"), F.lit("JPY").alias("currency"), F.lit("per_unit").alias("price_unit"),
        F.lit("khong_ro").alias("price_basis"), F.when(F.col("p_size") % 9 != 0, "2026-05").alias("period"), F.coalesce(value(1), value(2)).alias("price_min"), F.coalesce(value(2), value(3)).alias("price_max"), F.coalesce(value(4), value(5)).alias("price_avg"),
    )
    return quality.price_rules(rows)


@query("""SELECT p_partkey AS building_id, 'V15' AS rule, p_partkey::VARCHAR AS record, 'type without code dropped' AS message FROM part WHERE p_size % 10 = 0
UNION ALL SELECT p_partkey, 'V15', upper(p_brand) || '?', 'plan matches no type, rooms: ' || (p_size % 4) FROM part WHERE p_size % 10 = 1
UNION ALL SELECT p_partkey, 'V15', p_size::VARCHAR, 'floor plate read from a plan' FROM part WHERE p_size % 10 = 2
UNION ALL SELECT c_nationkey, 'V15', c_nationkey::VARCHAR, 'building records: ' || count(*) FROM customer GROUP BY c_nationkey HAVING count(*) > 1
UNION ALL SELECT -1, 'V1', s, 'key empty or repeated, rows: ' || n FROM (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1)""")
def q_assembly_warnings(spark, sf_dir):
    """What assembling leaves out or doubts, in one list with the keys that repeat."""
    t = Tables(spark, sf_dir)
    part = t.part.withColumn("building_id", F.col("p_partkey"))
    dropped = part.where("p_size % 10 = 0")
    rooms = F.array_repeat(F.lit("r"), F.col("p_size") % 4)
    plans = part.where("p_size % 10 = 1").select("building_id", F.concat(F.upper("p_brand"), F.lit("?")).alias("matched_type_code"), rooms.alias("rooms"))
    types = part.select("building_id", F.col("p_brand").alias("type_code"), F.col("p_partkey").alias("unit_type_id"))
    unmatched = records.resolve_foreign_key(plans, "matched_type_code", types, "type_code", "unit_type_id", "unit_type_id", ["building_id"]).where("unit_type_id IS NULL")
    from_plans = part.where("p_size % 10 = 2").select("building_id", F.col("p_size").alias("floor_range"))
    found = quality.assembly_warnings(dropped, unmatched, from_plans, t.customer.select(F.col("c_nationkey").cast("long").alias("building_id")))
    repeated = quality.repeated_keys(t.customer.select("c_mktsegment", F.lit(-1).cast("long").alias("building_id")), "c_mktsegment")
    return found.unionByName(repeated)


@query("""SELECT p_partkey AS building_id, 'V17' AS rule, p_partkey::VARCHAR AS record, 'only a range is published: ' || p_size || '㎡~' || (p_size + 9) || '㎡' AS message FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 4 = 0""")
def q_quality_empty(spark, sf_dir):
    """Buildings whose cells only publish a range of areas and that have no types."""
    part = Tables(spark, sf_dir).part.withColumn("building_id", F.col("p_partkey"))
    said = F.concat(F.col("p_size").cast("string"), F.lit("㎡"), F.when(F.col("p_partkey") % 4 == 0, "~").otherwise("・"), (F.col("p_size") + 9).cast("string"), F.lit("㎡"))
    shown = part.select("building_id", F.lit("住戸専有面積").alias("label"), said.alias("value"), F.lit(1).alias("page_idx"), F.lit(2).alias("kv_idx"))
    later = part.select("building_id", F.lit("専有面積").alias("label"), F.lit("1㎡~2㎡").alias("value"), F.lit(2).alias("page_idx"), F.lit(0).alias("kv_idx")).where("building_id % 4 = 0")
    return quality.empty_notes(shown.unionByName(later), part.where("p_partkey % 3 = 0"), part)


KANJI_SQL = "CASE WHEN p_size >= 20 THEN substr('一二三四五六七八九', p_size // 10, 1) || '十' WHEN p_size >= 10 THEN '十' ELSE '' END || CASE WHEN p_size % 10 > 0 THEN substr('一二三四五六七八九', p_size % 10, 1) ELSE '' END"


@query(f"""WITH r AS (SELECT p_partkey, p_size, {KANJI_SQL} AS k FROM part)
SELECT p_partkey, '第' || k || '期 ' || p_size || '階 ' || (p_size % 9 + 1) || '丁目' AS digits, 'シャトー' || p_size || '-' || p_partkey AS repaired, p_size || '階' AS floor, p_size || '㎡' AS bare, '（東京）' AS kept,
'a-b_' || p_partkey AS file, CASE WHEN p_size % 3 = 0 THEN '免震;床暖房' WHEN p_size % 3 = 1 THEN '床暖房' END AS features, p_size % 2 = 0 AS is_pdf FROM r""")
def q_text_repairs(spark, sf_dir):
    """Numerals before counters, long vowels, floors near a term, brackets in source script, names of files, features in order, PDF addresses."""
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    digit = lambda n: F.when(n > 0, F.substr(F.lit(domain.KANJI), n, F.lit(1))).otherwise("")
    tens = F.floor(size / 10).cast("int")
    kanji = F.concat(F.when(tens > 1, digit(tens)).otherwise(""), F.when(tens > 0, "十").otherwise(""), digit(size % 10))
    said = F.concat(F.when(size % 3 == 0, "床暖房と免震。").when(size % 3 == 1, "床暖房。").otherwise("なし。"), F.lit("ラウンジは"), size.cast("string"), F.lit("階。"))
    features = domain.terms_present(said, ("免震", "床暖房", "制震"))
    return Tables(spark, sf_dir).part.select(
        "p_partkey", domain.kanji_numbers(F.concat(F.lit("第"), kanji, F.lit("期 "), kanji, F.lit("階 "), digit(size % 9 + 1), F.lit("丁目"))).alias("digits"),
        domain.repair_long_vowels(F.concat(F.lit("シャト-"), size.cast("string"), F.lit("-"), key)).alias("repaired_"), domain.repair_long_vowels(F.concat(F.lit("シャト-ー"), size.cast("string"), F.lit("-"), key)).alias("long_"),
        domain.floor_mention(said).alias("floor"), text.strip_source_terms(F.concat(size.cast("string"), F.lit("㎡（約"), size.cast("string"), F.lit("坪）"))).alias("bare"), text.strip_source_terms(F.lit("（東京）")).alias("kept"),
        text.file_slug(F.concat(F.lit(" a-b/"), key, F.lit("?"))).alias("file"), F.array_join(features, ";").alias("features"), text.is_pdf(F.concat(F.lit("https://x.jp/p"), key, F.when(size % 2 == 0, ".PDF?a=1").otherwise("/pdf"))).alias("is_pdf"),
    ).withColumn("repaired", F.replace("long_", F.lit("ーー"), F.lit("ー"))).drop("repaired_", "long_")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 4 > 0 THEN round((l_partkey % 50)::DOUBLE / (l_suppkey % 4) * 100, 2) END AS pct, CASE WHEN l_partkey % 5 > 0 AND l_suppkey % 4 > 0 THEN round((l_partkey % 5)::DOUBLE / (l_suppkey % 4), 2) END AS per_elevator,
CASE l_linenumber % 3 WHEN 0 THEN (l_partkey % 9) + 1 WHEN 1 THEN 1 END::INT AS floors, (l_partkey % 8)::DOUBLE AS average FROM lineitem""")
def q_ratios(spark, sf_dir):
    """Shares and units per elevator that no zero breaks, floors of a range, average prices."""
    p, s, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    ranged = F.when(line % 3 == 0, F.concat(F.lit("3 - "), (p % 9 + 3).cast("string"))).when(line % 3 == 1, "１２").otherwise("mái")
    return Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.percent(p % 50, s % 4).alias("pct"), numbers.per_elevator(p % 5, s % 4).alias("per_elevator"), numbers.floors_in_range(ranged).alias("floors"),
        numbers.average_price((p % 8).cast("double"), F.lit(0.0), (s % 3).cast("double")).alias("average"),
    )


@query("""SELECT c_custkey, (c_custkey % 4)::VARCHAR AS a, (c_custkey % 7)::VARCHAR AS b FROM customer""")
def q_pairs_to_map(spark, sf_dir):
    """Lists of keys and values as a map; the last value of a key counts, pairs without a key go."""
    key = F.col("c_custkey")
    pair = lambda k, v: F.struct(F.lit(k).cast("string").alias("key"), v.cast("string").alias("value"))
    rows = Tables(spark, sf_dir).customer.select("c_custkey", F.array(pair("a", F.lit(-1)), pair("a", key % 4), pair(None, key), pair("b", key % 7)).alias("pairs"))
    return rows.select("c_custkey", text.pairs_to_map(F.col("pairs")).alias("m")).select("c_custkey", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


@query("""WITH u(i, unit, currency, f) AS (VALUES (0, '億円', 'JPY', 1e8), (1, '万元', 'CNY', 1e4), (2, 'tỷ', 'VND', 1e9), (3, '억원', 'KRW', 1e8), (4, '?', NULL, NULL))
SELECT p_partkey, unit, currency, (p_size * f)::DOUBLE AS value FROM part JOIN u ON p_partkey % 5 = i""")
def q_money_units(spark, sf_dir):
    """Amounts with money words of several markets."""
    unit = F.element_at(F.array(*[F.lit(x) for x in ("億円", "万元", "tỷ", "억원", "?")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    rows = Tables(spark, sf_dir).part.select("p_partkey", unit.alias("unit"), F.col("p_size").cast("double").alias("n"))
    return numbers.with_money_factor(rows, "unit", "n").drop("n")


@query("""SELECT DISTINCT l_suppkey AS base, l_returnflag, l_linestatus FROM lineitem""")
def q_child_union(spark, sf_dir):
    """Lines under the key of their group's base, equal ones once."""
    lines = Tables(spark, sf_dir).lineitem
    bases = lines.select("l_orderkey", "l_linenumber", "l_suppkey").distinct()
    keyed = lines.select(F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("k"), "l_returnflag", "l_linestatus")
    return stack.fold_children(keyed, bases.select(F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("k"), F.col("l_suppkey").alias("base")), "k").withColumnRenamed("k", "base")


@query("""SELECT o_custkey AS building_id, 'no building record' AS reason FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3) GROUP BY 1
UNION ALL SELECT c_custkey, 'no orders' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def q_orphans(spark, sf_dir):
    """Rows without their building, and wanted ids that have no rows."""
    t = Tables(spark, sf_dir)
    known, rows = t.customer.where("c_nationkey <> 3").select(F.col("c_custkey").alias("building_id")), t.orders.select(F.col("o_custkey").alias("building_id"))
    missing = records.select_run(t.customer.select(F.col("c_custkey").alias("building_id")), None, rows, None)
    return stack.orphans(rows, known).unionByName(missing.withColumn("reason", F.lit("no orders")))


@query("""WITH w AS (SELECT p_name AS term, p_partkey FROM part), d AS (SELECT DISTINCT p_name AS term FROM part WHERE p_size % 5 = 0), s AS (SELECT min(p_name) AS term FROM part),
j AS (SELECT w.term, CASE WHEN s.term IS NOT NULL THEN 'seed' WHEN d.term IS NOT NULL THEN upper(d.term) END AS translation FROM w LEFT JOIN d ON w.term = d.term LEFT JOIN s ON w.term = s.term)
SELECT term, translation, count(*) AS n, CASE WHEN translation IS NULL THEN count(*) ELSE 0 END AS missed FROM j GROUP BY 1, 2""")
def q_term_lookup(spark, sf_dir):
    """Terms looked up in a seed and in what was learnt; those found in neither are counted."""
    part = Tables(spark, sf_dir).part
    rows = part.select(F.col("p_name").alias("term"))
    learnt = part.where("p_size % 5 = 0").select(F.col("p_name").alias("term"), F.upper("p_name").alias("translation"), F.lit(1).alias("src_rank"))
    seed = part.agg(F.min("p_name").alias("term")).select("term", F.lit("seed").alias("translation"), F.lit(0).alias("src_rank"))
    found, missed = terms.lookup(rows, learnt.unionByName(seed))
    counted = found.groupBy("term", "translation").agg(F.count("*").alias("n"))
    return counted.join(missed.withColumnRenamed("count", "missed"), "term", "left").withColumn("missed", F.coalesce("missed", F.lit(0)).cast("long"))


@query("""SELECT 'a' AS field, count(*) FILTER (WHERE p_size % 3 = 0) AS cells FROM part UNION ALL SELECT 'b', count(*) FILTER (WHERE p_size % 4 = 0) FROM part UNION ALL SELECT 'c', 0 FROM part LIMIT 3""")
def q_residual_script(spark, sf_dir):
    """Cells that are still in source script, by field."""
    rows = Tables(spark, sf_dir).part.select(F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit("東京"))).otherwise("x").alias("a"), F.when(F.col("p_size") % 4 == 0, "プール").alias("b"), F.col("p_size").alias("c"))
    return terms.residual_count(rows, ["a", "b", "c"], text.CJK)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(CASE WHEN l_partkey % 2 = 0 THEN p_brand END, 'whole building') AS type_label FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def q_type_labels(spark, sf_dir):
    """Lines with the code of their type; the whole building where there is none."""
    t = Tables(spark, sf_dir)
    types = t.part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("unit_type_id"), F.col("p_brand").alias("type_code"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").alias("unit_type_id"))
    return stack.with_type_label(rows, types).drop("unit_type_id")


@query("""WITH r AS (SELECT c_custkey, c_nationkey, CASE c_custkey % 4 WHEN 0 THEN 'B2' WHEN 1 THEN 'B7' WHEN 2 THEN 'B1' ELSE 'Z' END AS bang, CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 7 WHEN 2 THEN 1 ELSE 8 END::BIGINT AS place FROM customer)
SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY place, c_custkey)::INT AS pos FROM r""")
def q_stack_order(spark, sf_dir):
    """Rows of a building in the order of the tables of the stack, unknown ones last."""
    from pyspark.sql import Window

    form = F.col("c_custkey") % 4
    bang = F.when(form == 0, "B2").when(form == 1, "B7").when(form == 2, "B1").otherwise("Z")
    rows = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey", bang.alias("bang")).withColumn("place", stack.stack_order().cast("long"))
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("place", "c_custkey")))


@query("""SELECT c_custkey, lower(c_name) AS name, row_number() OVER (ORDER BY c_mktsegment DESC, round(c_acctbal) DESC, lower(c_name))::INT AS place FROM customer QUALIFY place BETWEEN 41 AND 60""")
def q_report_page(spark, sf_dir):
    """The third page of twenty of a report: by segment, ties by completeness, then by name in lower case."""
    rows = Tables(spark, sf_dir).customer.select("c_custkey", F.upper("c_name").alias("building_name"), "c_mktsegment", F.round("c_acctbal").alias("completeness"))
    page = stack.report_page(rows, [F.desc("c_mktsegment")], page=2, size=20)
    place = F.row_number().over(Window.orderBy(F.desc("c_mktsegment"), F.desc("completeness"), F.lower("building_name"))) + 40  # over the twenty rows of the page
    return page.select("c_custkey", F.lower("building_name").alias("name"), place.cast("int").alias("place"))


@query("SELECT max(o_orderdate)::DATE::VARCHAR AS newest, (SELECT count(*) FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)) AS orders FROM orders")
def q_newest_stamp(spark, sf_dir):
    """The newest order and how many carry its stamp."""
    orders = Tables(spark, sf_dir).orders
    newest = stack.newest_stamp(orders, "o_orderdate")
    return orders.join(F.broadcast(newest), orders["o_orderdate"] == newest["newest"]).groupBy(F.col("newest").cast("date").cast("string").alias("newest")).agg(F.count("*").alias("orders"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 1 ELSE 2 END, l_linenumber, l_partkey, l_suppkey)::INT AS place FROM lineitem""")
def q_source_priority(spark, sf_dir):
    """Sources of a building by priority, then by their number."""
    priority = F.when(F.col("l_returnflag") == "R", 1).otherwise(2)
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", priority.alias("priority"))
    return readers.by_priority(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"]).drop("priority")


@query("""WITH i AS (SELECT page_id, g AS img_idx, (page_id + g) % 4 AS f FROM pages, range(0, 40) r(g))
, ok AS (SELECT page_id, img_idx FROM i WHERE f IN (0, 1)) SELECT page_id, img_idx::INT AS img_idx FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY img_idx) AS n FROM ok) WHERE n <= 12""")
def q_image_candidates(spark, sf_dir):
    """Forty images a page: named plans, large ones of relevant pages, large ones of others, and inline ones."""
    rows = Tables(spark, sf_dir).pages.select("page_id", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("img_idx")).withColumn("f", (F.col("page_id") + F.col("img_idx")) % 4)
    form = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("f") + 1).cast("int"))
    images = rows.select("page_id", "img_idx", form("/Plan.png", "/a.png", "/b.png", "data:plan").alias("src"), F.lit("").alias("alt"), F.lit("c").alias("class"), form(500, 900, 900, 900).alias("width"), form(300, 700, 700, 700).alias("height"), form("x", "floorplan", "news", "floorplan").alias("purpose"))
    return cells.image_candidates(images, ("plan", "madori"), ["floorplan"]).select("page_id", "img_idx")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size || 'm' ELSE p_name END AS value FROM part""")
def q_colon_or_next(spark, sf_dir):
    """The value after a label's colon, else the next line of the block."""
    lines = F.array(F.lit("高さ：old"), F.lit("x"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("高さ："), F.col("p_size").cast("string"), F.lit("m"))).otherwise("高さ："), F.col("p_name"))
    return Tables(spark, sf_dir).part.select("p_partkey", cells.after_colon_or_next(lines, "高さ").alias("value"))


@query("""SELECT l_orderkey, min(l_linenumber * 10000000 + l_partkey) AS first FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_discount > 0.02 GROUP BY 1""")
def q_first_scan(spark, sf_dir):
    """The first line of an order, in order of number and part, whose text matches."""
    t = Tables(spark, sf_dir).lineitem
    rows = t.select("l_orderkey", "l_linenumber", "l_partkey", F.concat("l_returnflag", F.when(F.col("l_discount") > 0.02, " cut").otherwise(" full")).alias("text"))
    found = cells.first_scan(rows, "l_orderkey", "text", "^[AR] cut$", ["l_linenumber", "l_partkey"])
    return found.select("l_orderkey", (F.col("l_linenumber") * F.lit(10000000).cast("long") + F.col("l_partkey")).alias("first"))


@query("""SELECT p_partkey, '東京都' AS source_note, '東京都' AS design_concept, 'Tokyo' AS city, 'x ' || p_size || ' căn' AS units FROM part""")
def q_verbatim_fields(spark, sf_dir):
    """Texts are rewritten, verbatim and commentary fields are left alone."""
    rows = Tables(spark, sf_dir).part.select("p_partkey", F.lit("東京都").alias("source_note"), F.lit("東京都").alias("design_concept"), F.lit("東京都").alias("city"), F.concat(F.lit("x"), F.col("p_size").cast("string"), F.lit("戸")).alias("units"))
    return buildings.rewritten(rows, [("東京", "Tokyo")])[0]


@query("""SELECT s_suppkey, (30.5 + s_nationkey)::DOUBLE AS latitude, (-100.25 - s_nationkey)::DOUBLE AS longitude, (100 + s_nationkey)::DOUBLE AS height_m, (1000 + s_nationkey)::DOUBLE AS height_ft, 'N' || s_nationkey AS country, 'Town' AS city, 1990 + s_nationkey AS year_completed, s_name AS architect FROM supplier""")
def q_infobox(spark, sf_dir):
    """Facts of an infobox written from each supplier."""
    n = F.col("s_nationkey")
    say = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    facts = [("Coordinates", say(n + 30.5, "; ", -n - 100.25)), ("Height (tip)", say(n + 100, " m (", F.format_number(n + 1000, 0), " ft)")), ("Location", say("Street 1, Town, N", n)), ("Completed", say("May ", n + 1990)), ("Architect", F.col("s_name"))]
    item = F.array(*[F.struct(F.lit(i).alias("kv_idx"), F.lit(k).alias("label"), v.alias("value")) for i, (k, v) in enumerate(facts)])
    rows = Tables(spark, sf_dir).supplier.select("s_suppkey", F.explode(item).alias("x")).select("s_suppkey", "x.*")
    return readers.infobox(rows, "s_suppkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 9)::BIGINT END AS num_floors, round(c_acctbal, 2) AS gfa_m2, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_target, nullif(c_mktsegment, '') AS segment FROM customer""")
def q_retyped(spark, sf_dir):
    """Text cells typed by the names of their columns."""
    key = F.col("c_custkey")
    rows = Tables(spark, sf_dir).customer.select(key.cast("string").alias("key"), F.when(key % 2 == 0, (key % 9).cast("string")).otherwise("n/a").alias("num_floors"), F.round("c_acctbal", 2).cast("string").alias("gfa_m2"), F.when(key % 3 == 0, " Yes").when(key % 3 == 1, "0").otherwise("?").alias("is_target"), F.col("c_mktsegment").alias("segment"))
    return readers.retyped(rows).select(F.col("key").cast("long").alias("c_custkey"), "num_floors", "gfa_m2", "is_target", "segment")


@query("""WITH d AS (SELECT 'a' AS field UNION ALL SELECT 'c') SELECT p_partkey, f AS field FROM part, (VALUES ('b'), ('z')) v(f) WHERE f = 'b' OR p_size % 2 = 0""")
def q_unknown_fields(spark, sf_dir):
    """Fields of a record that its schema does not declare."""
    fields = F.map_filter(F.create_map(*[F.lit(x) for x in ("a", "1", "b", "2", "c", "3", "z", "4")]), lambda k, v: (k != "z") | (F.col("p_size") % 2 == 0))
    rows = Tables(spark, sf_dir).part.select("p_partkey", "p_size", fields.alias("fields"))
    return records.unknown_fields(rows, "p_partkey", "fields", ["a", "c"])


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS n, l_returnflag FROM lineitem)
SELECT r.l_orderkey, r.l_returnflag AS field, r.l_linenumber AS ord, CASE WHEN l_suppkey % 4 = 3 THEN 'medium' ELSE ['high', 'low', 'medium'][l_suppkey % 4 + 1] END AS confidence FROM r WHERE n = 1 AND l_returnflag <> 'N'""")
def q_one_provenance(spark, sf_dir):
    """One evidence row a filled field, the first; unknown confidences are medium."""
    level = F.element_at(F.array(*[F.lit(x) for x in ("high", "low", "medium", "sure")]), (F.col("l_suppkey") % 4 + 1).cast("int"))
    t = Tables(spark, sf_dir).lineitem
    rows = t.select("l_orderkey", F.col("l_returnflag").alias("field"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), level.alias("confidence"))
    one = records.one_provenance(rows, ["l_orderkey"], t.where("l_returnflag <> 'N'").select("l_orderkey", F.col("l_returnflag").alias("field")))
    return one.select("l_orderkey", "field", F.col("ord.l_linenumber").alias("ord"), "confidence")


@query("""WITH e AS (SELECT l_orderkey, CASE min(CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 2 ELSE 1 END) WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1)
SELECT o_orderkey, confidence FROM orders LEFT JOIN e ON o_orderkey = l_orderkey""")
def q_with_evidence(spark, sf_dir):
    """Orders with the weakest confidence of their lines' evidence."""
    t = Tables(spark, sf_dir)
    level = F.when(F.col("l_returnflag") == "A", "high").when(F.col("l_returnflag") == "N", "medium").otherwise("low")
    evidence = t.lineitem.where("l_partkey % 3 = 0").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("f").alias("field"), level.alias("confidence"), F.lit("u").alias("source_url"), F.lit("s").alias("snippet"), F.struct("l_linenumber", "l_partkey").alias("ord"))
    return stack.with_evidence(t.orders.select("o_orderkey"), stack.evidence_rollup(evidence, ["o_orderkey"]), ["o_orderkey"]).select("o_orderkey", "confidence")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS type_code, '' AS verified FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size % 2 = 0""")
def q_review_sheet(spark, sf_dir):
    """Rooms with their type's code and an empty column to fill in."""
    t = Tables(spark, sf_dir)
    rooms = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("unit_type_id"))
    return sinks.review_sheet(rooms, t.part.where("p_size % 2 = 0").select(F.col("p_partkey").alias("unit_type_id"), F.col("p_brand").alias("type_code"))).drop("unit_type_id")
