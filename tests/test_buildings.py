"""From files of a crawl to the seven tables, their checks, stacking, folding and writing."""

import json

import pytest
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.operators import cells, quality, records, stack
from docgrain.plans import buildings
from docgrain.sources import readers, sinks

PAGE = """<html><head><title>B1 タイプ</title></head><body><table>
<tr><th>所在地</th><td>東京都中央区月島１-１</td><th>総戸数</th><td>462戸</td></tr>
<tr><th>構造・階数</th><td>地上27階 地下1階建</td></tr><tr><th>敷地面積</th><td>1,200.5㎡</td></tr>
<tr><th>竣工</th><td>2027年3月予定</td></tr><tr><th>売主</th><td>住友不動産株式会社</td></tr><tr><th>駐車場</th><td>231台</td></tr>
<tr><th>販売価格</th><td>6,980万円 ~ 2億3,800万円</td></tr><tr><th>情報更新日</th><td>2026年5月</td></tr></table>
<dl><dt>タイプ</dt><dd>A-70</dd><dt>間取り</dt><dd>2LDK+S</dd><dt>専有面積</dt><dd>70.27㎡</dd><dt>タイプ</dt><dd>A-90</dd><dt>間取り</dt><dd>3LDK</dd><dt>専有面積</dt><dd>90㎡</dd></dl>
</body></html>"""
TEXT = "床暖房を標準装備。ディスポーザーはオプション。スカイラウンジは27階。\nS-55E\n2LDK\n専有面積:\n58.13㎡\n価格: 1億5800万円\n天井高：2600mm 免震構造"


@pytest.fixture(scope="module")
def crawl(tmp_path_factory):
    root = tmp_path_factory.mktemp("crawl")
    for b in ("tower_a", "tower_b"):
        d = root / b
        d.mkdir()
        (d / "01.txt").write_text(TEXT if b == "tower_a" else "nothing here")
        (d / "01.html").write_text(PAGE if b == "tower_a" else "<p>nothing</p>")
        good = {"idx": 1, "title": "t", "purpose": "official_overview", "url": f"https://{b}.jp/a", "status": "ok", "text_file": "01.txt", "raw_file": "01.html", "page_title": "B1 タイプ", "floorplan_files": ["f1.png"], "accessed_at": "2026-06-01"}
        bad = {"idx": 2, "title": "u", "purpose": "floorplan", "url": f"https://{b}.jp/b", "status": "http_error", "http_status": 503}
        (d / "manifest.json").write_text(json.dumps({"building_id": b, "accessed_at": "2026-06-01", "total": 2, "ok": 1, "floorplan_images": 1, "sources": [good, bad]}))
        (d / "sources.json").write_text(json.dumps({"query": b, "resolved": {"found": True, "building_name": "Tower A" if b == "tower_a" else "", "developer": "Other"}}))
        room = lambda c, a: {"room_code": c, "room_type": "phong_ngu_2", "area_m2": a}
        plans = [
            {"is_floorplan": True, "plan_kind": "unit", "matched_type_code": " a-70", "rooms": [room("pn1", 40.0), room("pn1", 50.0)]},
            {"is_floorplan": True, "plan_kind": "unit", "matched_type_code": "zzz", "rooms": [room("pn1", 4.0)]},
            {"is_floorplan": True, "plan_kind": "floor", "floor_range": "5-20", "units_on_floor": 10, "floor_label": "dien_hinh"},
        ]
        (d / "extract_floorplan.json").write_text(json.dumps({"plans": plans if b == "tower_a" else []}))
    return str(root)


@pytest.fixture(scope="module")
def tables(spark, crawl):
    manifest = readers.manifests(spark, crawl)
    pages = readers.load_pages(spark, crawl, manifest)
    verified = spark.createDataFrame([("tower_a", "A-90", "pn1", 12.0)], "building_id string, type_code string, room_code string, area_m2 double")
    found = buildings.extract(pages, "2026-06-01")
    out = buildings.assemble(found, readers.resolved_identity(spark, crawl), readers.saved_floorplans(spark, crawl), verified, "2026-06-01")
    return {k: v.cache() for k, v in out.items()}


def test_pages_of_good_status(spark, crawl):
    assert readers.load_pages(spark, crawl, readers.manifests(spark, crawl)).count() == 2


def test_building(tables):
    r = {x.building_id: x for x in tables["building"].collect()}
    a = r["tower_a"]
    assert (a.num_units_total, a.num_floors_above, a.num_basements, a.land_area_m2) == (462, 27, 1, 1200.5)
    assert (a.district, a.year_handover, a.status, a.developer) == ("中央区", 2027, "dang_xay", "住友不動産株式会社")
    assert (a.parking_ratio, a.floor_to_ceiling_m, a.signature_features) == (0.5, 2.6, ["免震構造", "スカイラウンジ"])
    assert (a.unit_area_min_m2, a.unit_area_max_m2, a.units_per_floor_typical) == (58.13, 90.0, 10)
    assert a.mix_by_bedroom_pct == {} or a.mix_by_bedroom_pct is None
    assert a.amenity_count == 2 and r["tower_b"].developer == "Other"


def test_types_and_keys(tables):
    r = {x.type_code: x for x in tables["unit_type"].collect()}
    assert set(r) == {"A-70", "A-90", "S-55E"}
    assert (r["A-70"].bedrooms, r["A-70"].layout_class, r["A-70"].area_net_m2, r["A-70"].area_basis_reported) == (2, "2pn_plus", 70.27, "thong_thuy")
    assert (r["S-55E"].unit_type_id, r["S-55E"].area_net_m2) == ("tower_a__s_55e", 58.13)


def test_rooms_items_prices(tables):
    rooms = {(x.room_id, x.area_m2, x.source_type) for x in tables["unit_room"].collect()}
    assert rooms == {("tower_a__a_70__pn1", 40.0, "floorplan_image"), ("tower_a__a_70__pn1_2", 50.0, "floorplan_image"), ("tower_a__a_90__pn1", 12.0, "manual")}
    items = {x.item_code: x.is_included for x in tables["handover_item"].collect()}
    assert items == {"san_suoi": True, "may_nghien_rac": False}
    assert {x.floor_level for x in tables["amenity"].collect()} == {"27階"}
    prices = {(x.unit_type_id, x.price_min, x.price_max, x.price_avg, x.period) for x in tables["price_obs"].collect()}
    assert prices == {(None, 69800000.0, 238000000.0, 153900000.0, "2026-05"), ("tower_a__s_55e", None, None, 158000000.0, "2026-05")}


def test_schemas_and_checks(tables):
    for name, rows in tables.items():
        assert rows.columns == [c.split()[0] for c in schemas.TABLES[name].split(", ")]
    found = {(r.rule, r.record) for r in quality.check(tables).collect()}
    assert ("V7", "tower_a") in found and ("V1", "tower_a") not in found


def test_evidence_and_rewriting(spark, crawl, tables):
    pages = readers.load_pages(spark, crawl, readers.manifests(spark, crawl))
    rows = {(r.table, r.record_key, r.field): r for r in buildings.evidence(pages, tables).collect()}
    units = rows["building", "tower_a", "num_units_total"]
    assert (units.value, units.snippet, units.confidence, units.source_file) == ("462", "総戸数: 462戸", "high", "01.txt")
    assert rows["handover_item", "tower_a__san_suoi", "item_category"].value == "dieu_hoa_thong_gio"
    assert not any(r.record_key == "tower_b" and r.field == "address" for r in rows.values())
    done, left = buildings.rewritten(tables["building"].select("building_id", "developer", "address"), [("東京", "Tokyo")])
    assert {r.developer for r in done.collect()} == {"住友不動産", "Other"}
    assert {r.term for r in left.collect()} >= {"住友不動産"}


def test_benchmark_and_stack(spark, crawl, tables, tmp_path):
    manifest = readers.manifests(spark, crawl)
    bench = {r.building_id: r for r in buildings.benchmark(tables, manifest, "2026-06-01").collect()}
    assert (bench["tower_a"].num_unit_types, bench["tower_a"].num_rooms_captured, bench["tower_b"].num_amenities, bench["tower_a"].sources_ok) == (3, 3, 0, 1)
    labels = {t: stack.record_label(F.col(k)) for t, (k, _) in schemas.STACK.items()}
    stacked = stack.stack(tables, labels, {t: s for t, (_, s) in schemas.STACK.items()}, {t: k for t, (k, _) in schemas.STACK.items()})
    assert stacked.count() == sum(v.count() for v in tables.values())
    keyed = stacked.withColumn("building_id", F.substring_index(F.coalesce("building_id", "record_key"), "__", 1))
    sinks.write_per_building(keyed, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, multiLine=True, escape='"')
    assert back.count() == keyed.count()


def test_html_cells_and_fallback(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<table><tr><td>a</td><td><table><tr><td>b</td><td>c</td></tr></table></td></tr></table>")], "p int, html string")
    got = cells.html_cells(pages, ["p"]).where("p = 1")
    assert got.where("label = '総戸数'").first().value == "462戸"
    pages.createOrReplaceTempView("nested_pages")
    spark.udtf.register("nested_cells", cells.NestedCells)
    rows = spark.sql("SELECT p, c.* FROM nested_pages, LATERAL nested_cells(html) c WHERE p = 4").collect()
    assert ("b", "c") in {(r.label, r.value) for r in rows} and ("a", "b c") in {(r.label, r.value) for r in rows}


def test_unique_keys_with_a_real_second_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a_2", 3)], "k string, o int")
    got = {r.o: r.out for r in records.unique_keys(rows, "k", ["o"], "out").collect()}
    assert got[1] == "a" and got[3] == "a_2" and len(set(got.values())) == 3


def test_null_safe_override(spark):
    rows = spark.createDataFrame([(None, None, 1), ("a", "x", 2)], "t string, r string, v int")
    better = spark.createDataFrame([(None, None, 9)], "t string, r string, v int")
    assert sorted(r.v for r in records.override(rows, better, ["t", "r"]).collect()) == [2, 9]


def test_folding(spark):
    rows = spark.createDataFrame([("a", "The Tower", None), ("b", "the tower.", "x"), ("c", "Other", "y")], "building_id string, building_name string, city string")
    children = {"amenity": spark.createDataFrame([("a", "gym"), ("b", "gym"), ("c", "pool")], "building_id string, slug string")}
    folded, kids = stack.fold_buildings(rows, children, ["building_id", "building_name", "city"])
    assert {(r.building_id, r.city) for r in folded.collect()} == {("b", "x"), ("c", "y")}
    assert {(r.building_id, r.slug) for r in kids["amenity"].collect()} == {("b", "gym"), ("c", "pool")}
    assert stack.orphans(children["amenity"], rows.where("building_id <> 'c'")).count() == 1


def test_sites_and_failures(spark, crawl):
    """A page belongs to the first site of its host; whatever fails leaves a row, and a table without records if nothing is left."""
    registry = {"building": list(buildings.EXTRACTORS["building"])}
    told = lambda n: lambda pages, cells, as_of: pages.select("building_id", F.lit(0).alias("trust"), "page_idx", F.lit(0).alias("ord"), F.lit(n).alias("num_units_total"))
    buildings.extractor("building", 0, ("tower_a.jp",), registry)(told(7))
    buildings.extractor("building", 0, ("jp", "tower_a.jp"), registry)(told(8))
    slow = F.udf(lambda x: 1 // 0, "int")
    buildings.extractor("amenity", 1, None, registry)(lambda pages, cells, as_of: pages.select("building_id", slow("url").cast("string").alias("slug")))
    pages = readers.load_pages(spark, crawl, readers.manifests(spark, crawl))
    tables, errors = buildings.extract_guarded(pages, "2026-06-01", registry)
    rows = {r.building_id: r for r in tables["building"].collect()}
    assert (rows["tower_a"].num_units_total, rows["tower_b"].num_units_total, rows["tower_a"].land_area_m2) == (7, 8, 1200.5)
    assert tables["amenity"].count() == 0 and [(r.table, "ZeroDivisionError" in r.error) for r in errors.collect()] == [("amenity", True)]


def test_cells_are_shared(spark, crawl, tables):
    pages = readers.load_pages(spark, crawl, readers.manifests(spark, crawl))
    cells_of = buildings.page_cells(pages)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(buildings.evidence(pages, tables, cells_of)) == key(buildings.evidence(pages, tables))


def test_pages_are_cut_once_and_nothing_is_gathered(spark):
    """A record's rows are found once, and no join of tables that grow with the buildings is a broadcast, however small they look."""
    from docgrain.plans import building_queries

    rows = spark.createDataFrame([("b", 0, 1, 1, 0, 7), ("b", 0, 0, 1, 0, None), (None, 0, 0, 1, 0, 3)], "building_id string, src_rank int, trust int, page_idx int, ord int, num_units_total int")
    merged = buildings._merged("building", rows)
    assert [(r.building_id, r.num_units_total, r.ord.trust) for r in merged.collect()] == [("b", 7, 0)]
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
    plans = [df._jdf.queryExecution().executedPlan().toString() for t, df in building_queries._full_tables(spark, "/root/testdata/sf0.001").items() if t != "price_obs"]
    assert not any("BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p for p in plans)
