"""The whole way from pages to tables, over pages written from each part, so that the true values are known."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.operators import records
from docgrain.plans import buildings
from docgrain.plans.registry import Tables, query, spread

IDENTITY = "building_id string, building_name string, building_name_local string, project_name string, country string, city string, official_website string, developer string"
VERIFIED = "building_id string, type_code string, room_code string, area_m2 double"


def written_pages(part: DataFrame) -> DataFrame:
    """One official page a part: a table of facts, a list of two types, equipment and amenities in its text."""
    key, size = F.col("p_partkey"), F.col("p_size")
    say = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    html = say(
        "<html><title>t</title><table><tr><th>所在地</th><td>東京都第", key % 23 + 1, "区月島１-１</td><th>総戸数</th><td>", size * 10 + 20, "戸</td></tr><tr><th>構造・階数</th><td>地上", size + 3, "階 地下", size % 3 + 1,
        "階建</td></tr><tr><th>敷地面積</th><td>", F.col("p_retailprice"), "㎡</td></tr><tr><th>竣工</th><td>", size + 2000, "年3月</td></tr><tr><th>販売価格</th><td>", size + 1000, "万円 ～ ", size + 1, "億円</td></tr>",
        "<tr><th>情報更新日</th><td>2026年5月</td></tr></table><dl><dt>タイプ</dt><dd>A-1</dd><dt>間取り</dt><dd>2LDK</dd><dt>専有面積</dt><dd>", size + 30, "㎡</dd><dt>タイプ</dt><dd>A-2</dd><dt>間取り</dt><dd>3LDK</dd><dt>専有面積</dt><dd>", size + 50, "㎡</dd></dl></html>",
    )
    text = F.concat(F.lit("床暖房を標準装備。"), F.when(key % 2 == 0, "ディスポーザーは有償。").otherwise(""), F.when(key % 3 == 0, "スカイラウンジは5階。").otherwise("プール完備。"))
    return part.select(
        F.concat(F.lit("b"), key).alias("building_id"), F.lit(1).alias("page_idx"), F.lit("01.txt").alias("name"), F.lit("https://a.jp/x").alias("url"), F.lit("official_overview").alias("purpose"), F.lit("t").alias("title"), html.alias("html"), text.alias("text")
    )


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The tables from pages alone."""
    found = buildings.extract(written_pages(spread(Tables(spark, sf_dir).part)), "2026-06-01")
    return buildings.assemble(found, spark.createDataFrame([], IDENTITY), spark.createDataFrame([], "building_id string, plan_idx int, " + _plan_fields()), spark.createDataFrame([], VERIFIED), "2026-06-01")


def _full_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The seven tables, with plans, rooms checked by hand and names that the parts give."""
    part = Tables(spark, sf_dir).part
    found = buildings.extract(written_pages(spread(part)), "2026-06-01")
    named = part.select("p_partkey", "p_size", "p_name", F.concat(F.lit("b"), F.col("p_partkey")).alias("building_id"))
    identity = records.project(named.withColumnsRenamed({"p_name": "building_name_local"}).withColumn("developer", F.concat(F.lit("D"), F.col("p_size"))), IDENTITY)
    room = lambda code, area: F.struct(F.lit(code).alias("room_code"), area.cast("double").alias("area_m2"))
    plan = named.withColumn("is_floorplan", F.lit(True)).withColumn("rooms", F.array(room("PN1", F.lit(12)), room("PN2", F.col("p_size"))))
    unit = plan.where("p_partkey % 2 = 0").withColumn("plan_kind", F.lit("unit")).withColumn("matched_type_code", F.when(F.col("p_partkey") % 10 == 0, "Z-9").otherwise("A-1")).withColumn("plan_idx", F.lit(0))
    floor = plan.where("p_partkey % 3 = 0").withColumn("plan_kind", F.lit("floor")).withColumn("floor_range", F.lit("5-20")).withColumn("units_on_floor", F.col("p_size") % 7 + 1).withColumn("plan_idx", F.lit(1))
    schema = "building_id string, plan_idx int, " + _plan_fields()
    shape = "array<struct<" + schema.split("rooms array<struct<", 1)[1].split(">>", 1)[0] + ">>"
    with_rooms = lambda df: df.withColumn("rooms", F.from_json(F.to_json("rooms"), shape))
    plans = records.project(with_rooms(unit), schema).unionByName(records.project(with_rooms(floor), schema))
    verified = named.where("p_partkey % 4 = 0").select("building_id", F.lit("A-1").alias("type_code"), F.lit("PN1").alias("room_code"), F.lit(9.5).alias("area_m2"))
    return buildings.assemble(found, identity, plans, verified, "2026-06-01")


def _plan_fields() -> str:
    return ", ".join(f.replace(":", " ", 1) for f in _split(schemas.FLOORPLANS.removeprefix("plans array<struct<").removesuffix(">>")))


def _split(fields: str) -> list[str]:
    out, depth = [""], 0
    for c in fields:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@query("""SELECT 'b' || p_partkey AS building_id, '第' || (p_partkey % 23 + 1) || '区' AS district, p_size * 10 + 20 AS num_units_total, p_size + 3 AS num_floors_above, p_size % 3 + 1 AS num_basements, round(p_retailprice, 2) AS land_area_m2,
p_size + 2000 AS year_handover, CASE WHEN p_size + 2000 <= 2026 THEN 'da_ban_giao' END AS status, (p_size + 30)::DOUBLE AS unit_area_min_m2, (p_size + 50)::DOUBLE AS unit_area_max_m2, '2pn' AS dominant_layout_class, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS amenity_count FROM part""")
def q_building_table(spark, sf_dir):
    """The building table with its derived columns."""
    rows = _tables(spark, sf_dir)["building"]
    return rows.select("building_id", "district", "num_units_total", "num_floors_above", "num_basements", "land_area_m2", "year_handover", "status", "unit_area_min_m2", "unit_area_max_m2", "dominant_layout_class", "amenity_count")


@query("""SELECT 'price_obs' AS name, 'b' || p_partkey || '__all__so_cap__2026-05' AS record, 'JPY' AS a, ((p_size + 1000) * 10000)::DOUBLE AS lo, (p_size + 1) * 100000000.0::DOUBLE AS hi FROM part
UNION ALL SELECT 'handover_item', 'b' || p_partkey || '__san_suoi', '床暖房を標準装備', 1.0, NULL FROM part UNION ALL SELECT 'handover_item', 'b' || p_partkey || '__may_nghien_rac', 'ディスポ-ザ-は有償', 0.0, NULL FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'unit_type', 'b' || p_partkey || '__' || c, CASE c WHEN 'a_1' THEN '2pn' ELSE '3pn' END, (p_size + CASE c WHEN 'a_1' THEN 30 ELSE 50 END)::DOUBLE, CASE c WHEN 'a_1' THEN 2 ELSE 3 END FROM part, (VALUES ('a_1'), ('a_2')) v(c)""")
def q_building_children(spark, sf_dir):
    """Prices, equipment and types of the buildings under their keys."""
    t = _tables(spark, sf_dir)
    prices = t["price_obs"].select(F.lit("price_obs").alias("name"), F.col("price_id").alias("record"), F.col("currency").alias("a"), F.col("price_min").alias("lo"), F.col("price_max").alias("hi"))
    items = t["handover_item"].select(F.lit("handover_item"), "handover_id", "item_spec", F.col("is_included").cast("int").cast("double"), F.lit(None).cast("double"))
    types = t["unit_type"].select(F.lit("unit_type"), "unit_type_id", "layout_class", "area_net_m2", F.col("bedrooms").cast("double"))
    return prices.union(items).union(types)


@query("""SELECT 'room' AS name, 'b' || p_partkey || '__a_1__' || c AS record, CASE WHEN c = 'pn1' AND p_partkey % 4 = 0 THEN 'manual' ELSE 'floorplan_image' END AS a, CASE WHEN c = 'pn1' THEN CASE WHEN p_partkey % 4 = 0 THEN 9.5 ELSE 12.0 END ELSE p_size END::DOUBLE AS lo
FROM part, (VALUES ('pn1'), ('pn2')) v(c) WHERE p_partkey % 2 = 0 AND (p_partkey % 10 <> 0 OR (c = 'pn1' AND p_partkey % 4 = 0))
UNION ALL SELECT 'plate', 'b' || p_partkey || '__main__5_20', '5-20', (p_size % 7 + 1)::DOUBLE FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'building', 'b' || p_partkey, p_name || ' D' || p_size, NULL FROM part""")
def q_building_rooms(spark, sf_dir):
    """Rooms from plans, those checked by hand in their place; plates from plans; names from the identity."""
    t = _full_tables(spark, sf_dir)
    rooms = t["unit_room"].select(F.lit("room").alias("name"), F.col("room_id").alias("record"), F.col("source_type").alias("a"), F.col("area_m2").alias("lo"))
    plates = t["floor_plate"].select(F.lit("plate"), "floor_plate_id", "floor_range", F.col("units_per_floor").cast("double"))
    named = t["building"].select(F.lit("building"), "building_id", F.concat_ws(" ", "building_name_local", "developer"), F.lit(None).cast("double"))
    return rooms.union(plates).union(named)


def contested_pages(part: DataFrame) -> DataFrame:
    """Pages that contradict one another: an official one of each part, on one of four hosts and in some parts without a
    number of units, and for a third of the parts a resale page with other numbers and a year of its own."""
    key, size = F.col("p_partkey"), F.col("p_size")
    row = lambda label, *xs: F.concat(F.lit(f"<tr><th>{label}</th><td>"), *[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs], F.lit("</td></tr>"))
    host = F.when(key % 4 == 0, "www.site-a.jp").when(key % 4 == 1, "site-b.jp").when(key % 4 == 2, "notsite-a.jp").otherwise("a.jp")
    units = F.when(key % 5 == 0, "").otherwise(row("総戸数", size * 10 + 20, "戸"))
    official = F.concat(F.lit("<table>"), units, row("敷地面積", size + 100, "㎡"), F.lit("</table>"))
    resale = F.concat(F.lit("<table>"), row("総戸数", size * 10 + 21, "戸"), row("敷地面積", size + 900, "㎡"), row("竣工", size + 1990, "年3月"), F.lit("</table>"))
    page = lambda n, h, purpose, html: part.select(
        F.concat(F.lit("b"), key).alias("building_id"), F.lit(n).alias("page_idx"), F.lit(f"0{n}.txt").alias("name"), F.concat(F.lit("https://"), h, F.lit("/"), key).alias("url"), F.lit(purpose).alias("purpose"), F.lit("t").alias("title"), html.alias("html"),
        F.concat(F.lit("units "), size + 5000).alias("text"), "p_size",
    )
    return page(1, host, "official_overview", official).unionByName(page(2, F.lit("resale.jp"), "price_secondary", resale).where("p_size % 3 = 0")).drop("p_size")


def _own_units(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    """A site's extractor: the number of units as its texts say it, where it is even."""
    said = F.regexp_extract("text", r"units (\d+)", 1).cast("int")
    return pages.select("building_id", F.lit(0).alias("trust"), "page_idx", F.lit(0).alias("ord"), F.when(said % 2 == 0, said).alias("num_units_total"))


def _own_launch(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    return cells.groupBy("building_id").agg(F.lit(0).alias("trust"), F.min("page_idx").alias("page_idx"), F.lit(0).alias("ord"), (F.lit(1900) + F.count("*")).cast("int").alias("year_launch"))


@query("""SELECT 'b' || p_partkey AS building_id,
  CASE WHEN p_partkey % 4 = 0 AND p_size % 2 = 0 THEN p_size + 5000 WHEN p_partkey % 5 <> 0 THEN p_size * 10 + 20 WHEN p_size % 3 = 0 THEN p_size * 10 + 21 END AS num_units_total,
  (p_size + 100)::DOUBLE AS land_area_m2, CASE WHEN p_size % 3 = 0 THEN p_size + 1990 END AS year_handover, CASE WHEN p_partkey % 4 = 1 THEN 1901 + CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END END AS year_launch FROM part""")
def q_site_building(spark, sf_dir):
    """Buildings from pages that contradict one another: a site's own values win on its hosts only, official pages before resale
    pages, and what one page lacks another one gives; the second site names the first one's host too, in vain."""
    registry = {"building": list(buildings.EXTRACTORS["building"])}
    buildings.extractor("building", 0, ("site-a.jp",), registry)(_own_units)
    buildings.extractor("building", 0, ("site-b.jp", "site-a.jp"), registry)(_own_launch)
    rows = buildings.extract(contested_pages(spread(Tables(spark, sf_dir).part)), "2026-06-01", registry)["building"]
    return rows.select("building_id", "num_units_total", "land_area_m2", "year_handover", "year_launch")


def _fails_in_a_task(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    return pages.select("building_id", F.lit(0).alias("trust"), "page_idx", F.lit(0).alias("ord"), F.raise_error(F.concat(F.lit("no such page: "), "url")).cast("string").alias("slug"))


def _fails_in_its_plan(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    return pages.select("building_id", "no_such_column")


def _fails_at_once(pages: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    return pages.select("building_id", {}["no such key"])


@query("""SELECT 'amenity' AS name, '_fails_in_a_task' AS extractor, 'site-b.jp' AS hosts, NULL::BIGINT AS n UNION ALL SELECT 'handover_item', '_fails_in_its_plan', '', NULL UNION ALL SELECT 'unit_type', '_fails_at_once', '', NULL
UNION ALL SELECT 'amenity', NULL, NULL, sum(CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END)::BIGINT FROM part UNION ALL SELECT 'handover_item', NULL, NULL, sum(CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END)::BIGINT FROM part
UNION ALL SELECT 'unit_type', NULL, NULL, 0::BIGINT""")
def q_failed_extractor(spark, sf_dir):
    """Extractors that fail in a task, in their plan and at once: an error row each, and whole tables from all others."""
    registry = {t: list(buildings.EXTRACTORS[t]) for t in ("amenity", "handover_item")} | {"unit_type": []}
    buildings.extractor("amenity", 0, ("site-b.jp",), registry)(_fails_in_a_task)
    buildings.extractor("handover_item", 0, None, registry)(_fails_in_its_plan)
    buildings.extractor("unit_type", 0, None, registry)(_fails_at_once)
    pages = written_pages(spread(Tables(spark, sf_dir).part)).withColumn("url", F.when(F.col("building_id").endswith("7"), "https://x.site-b.jp/a").otherwise(F.col("url")))
    tables, errors = buildings.extract_guarded(pages, "2026-06-01", registry)
    none = F.lit(None).cast("string")
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), none.alias("extractor"), none.alias("hosts"), "n") for t, rows in tables.items()]
    told = errors.select(F.col("table").alias("name"), "extractor", "hosts", F.lit(None).cast("long").alias("n"))
    return reduce(DataFrame.unionByName, counts, told)
