"""Incremental ingest and rebuild."""

from pyspark.sql import functions as F

from docgrain.streaming import ingest


def test_new_urls_only(spark, tmp_path):
    schema = "url string, v int"
    put = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: ingest.ingest_new(ingest.page_stream(spark, str(tmp_path / "in"), "url string, v int"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    put([("http://a/x?utm_source=1", 1), ("http://a/x", 2)], 1)
    run()
    put([("http://a/x#top", 3), ("http://a/y", 4)], 2)
    run()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["http://a/x", "http://a/y"]


def test_rebuild_touched(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 1)], "building_id string, n int").write.parquet(str(tmp_path / "current"))
    pages = spark.createDataFrame([("a",), ("a",), ("b",)], "building_id string")
    pages.where("building_id = 'a'").write.parquet(str(tmp_path / "changes"))
    build = lambda rows: rows.groupBy("building_id").agg(F.count("*").cast("int").alias("n"))
    stream = ingest.page_stream(spark, str(tmp_path / "changes"), "building_id string")
    ingest.rebuild_touched(stream, lambda: pages, build, str(tmp_path / "current"), lambda e: str(tmp_path / f"new{e}"), str(tmp_path / "state")).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "new0")).collect()} == {("a", 2), ("b", 1)}


def test_watermarked(spark, tmp_path):
    spark.sql("SELECT 'http://a/x' AS url, timestamp'2026-01-01' AS at UNION ALL SELECT 'http://a/x#b', timestamp'2026-01-01'").write.parquet(str(tmp_path / "in"))
    rows = ingest.one_per_url_within(ingest.page_stream(spark, str(tmp_path / "in"), "url string, at timestamp"), "at", "1 hour")
    q = rows.writeStream.format("memory").queryName("within").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("within").count() == 1


def _files(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_batches_read_their_buckets_only(spark, tmp_path):
    schema = "url string, host string, v int"
    out = str(tmp_path / "out")
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda state="state": ingest.ingest_new(ingest.page_stream(spark, str(tmp_path / "in"), schema), out, str(tmp_path / state), 32).awaitTermination()
    put([(f"http://h{i % 6}.jp/{i}", "own", i) for i in range(60)])
    run()
    index = ingest.seen_index(spark, out, 32)
    one = ingest.with_bucket_key(spark.createDataFrame([("http://h1.jp/x",), ("http://h1.jp/y",)], "url string"))
    touched = index.buckets_of(one)
    read = index.read(touched).inputFiles()
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read} <= set(touched) and len(read) < len(index.read().inputFiles())
    before = _files(tmp_path / "out-seen")
    put([("http://h1.jp/1#again", "own", 1), ("http://h1.jp/new", "own", 2)])  # a late file, partly of known pages
    run()
    after = _files(tmp_path / "out-seen")
    assert all(after[k] == v for k, v in before.items())
    rows = spark.read.parquet(out)
    assert rows.count() == 61 and rows.where("epoch = 1").collect()[0].url == "http://h1.jp/new" and rows.columns == ["url", "host", "v", "epoch"]
    # the second batch runs again after the index had taken it in: nothing changes
    manifest = index.manifest()
    run("another state")  # batch 0 anew, with all files: every mark is there already
    assert index.manifest() == manifest and spark.read.parquet(out).count() == 61


def test_replay_after_the_sink_was_written(spark, tmp_path):
    """A job that dies between sink and index writes the same rows again."""
    schema = "url string, v int"
    out = str(tmp_path / "out")
    spark.createDataFrame([("http://a/x", 1), ("http://a/y", 2)], schema).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("http://a/x", 1, 0)], schema + ", epoch int").write.partitionBy("epoch").parquet(out)
    ingest.ingest_new(ingest.page_stream(spark, str(tmp_path / "in"), schema), out, str(tmp_path / "state")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["http://a/x", "http://a/y"]


def test_rebuild_buckets(spark, tmp_path):
    schema = "building_id string, v int"
    pages = ingest.VersionedTable(spark, str(tmp_path / "pages"), ["building_id"], 16)
    table = ingest.VersionedTable(spark, str(tmp_path / "table"), ["building_id"], 16)
    build = lambda rows: rows.groupBy("building_id").agg(F.count("*").alias("n"), F.max("v").alias("v"))
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: ingest.rebuild_buckets(ingest.page_stream(spark, str(tmp_path / "in"), schema), pages, build, table, str(tmp_path / "state")).awaitTermination()
    put([(f"b{i % 40}", i) for i in range(100)])
    run()
    first, before = {r.building_id: (r.n, r.v) for r in table.read().collect()}, _files(tmp_path / "table")
    assert first["b3"] == (3, 83) and len(first) == 40
    put([("b3", 900), ("new", 5)])
    run()
    assert {r.building_id: (r.n, r.v) for r in table.read().collect()} == first | {"b3": (4, 900), "new": (1, 5)}
    after = _files(tmp_path / "table")
    assert all(after[k] == v for k, v in before.items())
    touched = set(table.buckets_of(spark.createDataFrame([("b3",), ("new",)], "building_id string")))
    new = {int(k.split("bucket=")[1].split("/")[0]) for k in after.keys() - before.keys() if "bucket=" in k}
    assert new == touched and {r.building_id: r.n for r in table.read(version=1).collect()} == {k: v[0] for k, v in first.items()}
