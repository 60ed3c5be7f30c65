"""Readers and sinks over small files."""

import json

import pytest
from pyspark.sql import functions as F

from docgrain.operators import terms
from docgrain.sources import readers, sinks


def test_names(spark, tmp_path):
    (tmp_path / "n.txt").write_text("# c\nGrand Tower\n\n| # | Name | City |\n|---|:--:|---|\n| 1 | **Blue** | Tokyo |\n| 2 | [Red Tokyo](http://x) | Tokyo |\n")
    got = {r.name for r in readers.building_names(spark, str(tmp_path)).collect()}
    assert got == {"Grand Tower", "Blue, Tokyo", "Red Tokyo"}


def test_source_list(spark, tmp_path):
    (tmp_path / "tower.txt").write_text("# c\nhttps://a.b/c | floorplan | unit plans\n[Site](https://d.e) | what\nno link\n")
    rows = {r.url: r for r in readers.source_list(readers.lines_of(spark, str(tmp_path))).collect()}
    assert set(rows) == {"https://a.b/c", "https://d.e"}
    assert (rows["https://a.b/c"].purpose, rows["https://a.b/c"].expected_content, rows["https://a.b/c"].title) == ("floorplan", "unit plans", "source 2")
    assert (rows["https://d.e"].purpose, rows["https://d.e"].title, rows["https://d.e"].building_id) == ("official_overview", "Site", "tower")
    ids = spark.createDataFrame([("tower",), ("none",)], "building_id string")
    assert [r.building_id for r in readers.missing_sources(ids, readers.source_list(readers.lines_of(spark, str(tmp_path)))).collect()] == ["none"]


def test_stacked_csv(spark, tmp_path):
    (tmp_path / "b1.csv").write_text("﻿bang,record_key,building_id\nB2,tower__a,\nB1,plain,\n", encoding="utf-8")
    got = {r.record_key: r.building_id for r in readers.stacked_csv(spark, str(tmp_path)).collect()}
    assert got == {"tower__a": "tower", "plain": "b1"}


def test_latest_batch_and_index(spark, tmp_path):
    files = spark.createDataFrame([("thread1_20260101.csv",), ("thread2_20260102.csv",), ("x.csv",)], "file_name string")
    assert [r.file_name for r in readers.latest_batch(files).collect()] == ["thread2_20260102.csv"]
    assert readers.latest_batch(files.where("file_name = 'x.csv'")).count() == 1
    assert readers.latest_batch(files, every=True).count() == 3
    (tmp_path / "done.json").write_text(json.dumps({"q": "b"}))
    assert readers.done_index(spark, str(tmp_path)).collect() == [("q", "b")]


def test_verified_rooms(spark, tmp_path):
    (tmp_path / "r.csv").write_text("verified,type_code,room_code,area_m2,width_m,length_m,has_window,is_ensuite\nYes,A,pn1,12.5,,x,1,no\nno,A,pn2,1,,,,\n")
    row = readers.verified_rooms(spark, str(tmp_path)).collect()
    assert len(row) == 1 and (row[0].area_m2, row[0].length_m, row[0].has_window, row[0].is_ensuite) == (12.5, None, True, False)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "B1", "a", ["x", "y"], True), ("b", "B1", "b", None, None)], "building_id string, bang string, record_key string, l array<string>, f boolean")
    assert [tuple(r) for r in sinks.as_cells(rows).orderBy("building_id").collect()] == [("a", "B1", "a", "x; y", "true"), ("b", "B1", "b", "", "")]
    sinks.write_shards(rows, str(tmp_path / "s"), 2, "20260101")
    assert spark.read.parquet(str(tmp_path / "s")).select("shard").distinct().count() == 2
    sinks.write_warnings(spark.createDataFrame([("a", "m")], "building_id string, message string"), str(tmp_path / "w"))
    known = spark.createDataFrame([("a", "A")], "term string, translation string")
    pairs = spark.createDataFrame([("a", "B"), ("b", "b"), ("c", "C"), ("d", " "), ("e", "東")], "term string, translation string")
    assert {tuple(r) for r in sinks.grow_dictionary(known, pairs, "一-鿿").collect()} == {("a", "A"), ("c", "C")}
    old = spark.createDataFrame([("q", "x", 1)], "query string, building_id string, at int")
    assert sinks.upsert(old, old.withColumn("building_id", F.lit("y")).withColumn("at", F.lit(2)), "query", "at").first().building_id == "y"


def test_terms(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",)], "term string")
    dictionary = spark.createDataFrame([("a", "A", 0), ("a", "Z", 1)], "term string, translation string, src_rank int")
    found, missed = terms.lookup(rows, dictionary)
    assert {r.translation for r in found.collect()} == {"A", None}
    assert terms.add_counts(missed, missed).collect() == [("b", 4)]
    assert terms.residual_count(spark.createDataFrame([("東", "x")], "a string, b string"), ["a", "b"], "一-鿿").orderBy("field").collect() == [("a", 1), ("b", 0)]


def test_infobox(spark):
    rows = [(1, 0, "Coordinates", "35.6; 139.7"), (1, 1, "Height", "333 m (1,093 ft)"), (1, 2, "Location", "Minato, Tokyo, Japan"), (1, 3, "Completed", "1958"), (1, 4, "Architect", "T. Naito")]
    r = readers.infobox(spark.createDataFrame(rows, "page_id int, kv_idx int, label string, value string")).first()
    assert (r.latitude, r.longitude, r.height_m, r.height_ft, r.country, r.city, r.year_completed, r.architect) == (35.6, 139.7, 333.0, 1093.0, "Japan", "Tokyo", 1958, "T. Naito")


def test_retyped_and_units(spark, tmp_path):
    rows = spark.createDataFrame([("12", "3.5", "yes", ""), ("x", "y", "z", "n")], "num_units string, gfa_m2 string, is_target string, name string")
    assert [tuple(r) for r in readers.retyped(rows).collect()] == [(12, 3.5, True, None), (None, None, None, "n")]
    from docgrain.functions.numbers import with_money_factor

    money = spark.createDataFrame([("万円", 2.0), ("tỷ", 3.0), ("?", 1.0)], "u string, a double")
    assert {(r.u, r.currency, r.value) for r in with_money_factor(money, "u", "a").collect()} == {("万円", "JPY", 2e4), ("tỷ", "VND", 3e9), ("?", None, None)}
    sinks.write_records({"amenity": spark.createDataFrame([("k", "b")], "amenity_id string, building_id string")}, str(tmp_path / "r"))
    assert readers.saved_records(spark, str(tmp_path / "r"), "amenity").first().amenity_id == "k"


def test_keys_gates_and_shards(spark):
    """Made keys never repeat; equal rows stay; rows without an id get a shard."""
    from docgrain.operators import cells, records

    base = ["a", "a", "a_2", "a_2", "a", "b", "b_2", "b", "b_3", None]
    got = [r.key for r in records.unique_keys(spark.createDataFrame([(x, i) for i, x in enumerate(base)], "base string, ord int"), "base", ["ord"], "key").orderBy("ord").collect()]
    assert got == ["a", "a_3", "a_2", "a_2_2", "a_4", "b", "b_2", "b_4", "b_3", None]
    urls = spark.createDataFrame([("a.x.jp", "/p"), ("a.x.jp", "/p"), ("y.jp", "/q"), (None, None)], "host string, path string")
    policy = spark.createDataFrame([("a.x.jp", 200, 0, "/p", False), ("y.jp", 403, 0, "/", True)], "host string, http_status int, rule_ord int, prefix string, allow boolean")
    assert sorted((r.host or "", r.allowed) for r in cells.host_gate(urls, policy).collect()) == [("", True), ("a.x.jp", False), ("a.x.jp", False), ("y.jp", False)]
    sites = spark.createDataFrame([("s", "x.jp", 1), ("t", "a.x.jp", 0)], "site string, pattern string, site_ord int")
    assert sorted((r.host or "", r.site) for r in cells.host_dispatch(urls, sites).collect()) == [("", None), ("a.x.jp", "t"), ("a.x.jp", "t"), ("y.jp", None)]
    rows = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "building_id string")
    assert sorted((r.building_id or "", r.shard) for r in sinks.shard_of(rows, 2).collect()) == [("", 0), ("", 0), ("a", 1), ("b", 0)]


def test_ranked(spark):
    from docgrain.sources.stages import ranked

    got = ranked(spark.range(1000).repartition(7), "id")
    assert got.where("id <> rank").count() == 0


def test_versions(spark, tmp_path):
    from docgrain.sources.versions import VersionedTable

    schema = "k string, at int, v string"
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], 8)
    assert table.read(schema=spark.createDataFrame([], schema).schema).count() == 0
    rows = lambda *xs: spark.createDataFrame(list(xs), schema)
    state = lambda **how: sorted(map(str, map(tuple, table.read(**how).collect())))
    table.upsert(rows(("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")), "at")
    held = state()
    bad = rows(("a", 2, "y"), ("b", 2, "y")).withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("dies half-way"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies half-way"):
        table.upsert(bad, "at")
    assert state() == held and table.versions() == [1]
    table.upsert(rows(("a", 2, "y"), ("b", 0, "late"), ("c", 1, "x")), "at", {"batch": 7})
    assert state() == sorted(map(str, [("a", 2, "y"), ("b", 1, "x"), ("c", 1, "x"), (None, 1, "x")]))
    assert state(version=1) == held and table.mark("batch") == 7
    table.append(rows(("a", 3, "z")))
    table.compact(1)
    assert table.read().where("k = 'a'").count() == 2 and all(len(v) == 1 for v in table.manifest()["buckets"].values())
    table.replace(table.read().where("k = 'c'"))
    assert [r.k for r in table.read().collect()] == ["c"]
    table.vacuum(1)
    assert [r.k for r in table.read().collect()] == ["c"] and len(table.versions()) == 1


def test_packed_crawl(spark, tmp_path):
    """A packed crawl reads as one of a file a page does, in as few files as the table has."""
    rows = [("a", 1, "ok", "p1.txt", "p1.html", "one\n", "<p>"), ("a", 2, "http_error", "p2.txt", "p2.html", "two", "<b>"), ("b", 1, "ok", "p1.txt", None, "three", None)]
    crawled = spark.createDataFrame(rows, "building_id string, idx int, status string, text_file string, raw_file string, text string, html string").withColumns({"url": F.lit("u"), "title": F.lit("t"), "purpose": F.lit("x"), "accessed_at": F.lit("2026")})
    identity = spark.createDataFrame([("a", "Tower"), ("b", "")], "building_id string, building_name string")
    read = {}
    for packed in (False, True):
        at = str(tmp_path / str(packed))
        sinks.write_crawl(crawled.coalesce(1), identity.coalesce(1), at, packed=packed)
        pages = readers.load_pages(spark, at, readers.manifests(spark, at, packed=packed), packed=packed)
        read[packed] = sorted(pages.collect()), sorted(readers.resolved_identity(spark, at, packed=packed).collect(), key=lambda r: r.building_id)
    assert read[True] == read[False] and len(read[True][0]) == 2
    assert len(list((tmp_path / "True").glob("*.parquet"))) <= 4
