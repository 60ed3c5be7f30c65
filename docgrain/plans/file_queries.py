"""Queries of readers and sinks: what is written from the given tables to the shared folder is read again from its files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.plans import buildings
from docgrain.plans.registry import Tables, query
from docgrain.sources import readers, sinks
from docgrain.sources.stages import shared_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/docgrain/{name}-{uuid.uuid4().hex}"


def _texts(lines: DataFrame, path: str) -> str:
    """Text files of ``line``, whose order inside a file is that of ``ord``; the lines of one first field of ``ord``, such as
    a table with its header, stay in one file however many files there are."""
    first = f"ord.{lines.schema['ord'].dataType.names[0]}"
    lines.repartitionByRange(first).sortWithinPartitions("ord").select("line").write.text(path)
    return path


@query("""SELECT CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_name || ', Town ' || c_nationkey ELSE c_name || ' Tokyo' END AS name FROM customer""")
def q_name_lists(spark, sf_dir):
    """Names in plain lines between comments, and in tables of one row each, with a city that some names hold already."""
    c, form = Tables(spark, sf_dir).customer, F.col("c_custkey") % 3
    table = lambda name, city: F.array(F.lit("| # | Name | City |"), F.lit("|---|:--:|---|"), F.concat(F.lit("| 1 | "), name, F.lit(" | "), city, F.lit(" |")), F.lit(""))
    town = F.concat(F.lit("Town "), F.col("c_nationkey").cast("string"))
    own = F.when(form == 0, F.array(F.lit("# names"), F.col("c_name"), F.lit(""))).when(form == 1, table(F.concat(F.lit("**"), "c_name", F.lit("**")), town)).otherwise(table(F.concat(F.lit("["), "c_name", F.lit(" Tokyo](http://x)")), F.lit("Tokyo")))
    rows = c.select("c_custkey", F.posexplode(own).alias("i", "line")).select(F.struct("c_custkey", "i").alias("ord"), "line")
    return readers.building_names(spark, _texts(rows, _folder(spark, "names"))).select("name")


@query("""SELECT 'https://a.jp/' || p_partkey AS url, CASE WHEN p_size % 3 = 0 THEN 'floorplan' ELSE 'official_overview' END AS purpose, CASE WHEN p_size % 3 = 2 THEN p_name ELSE 'plans of ' || p_size END AS expected_content, 1 AS priority FROM part""")
def q_source_lists(spark, sf_dir):
    """Lines of address, purpose and note; comments and lines without an address go."""
    part, form = Tables(spark, sf_dir).part, F.col("p_size") % 3
    url = F.concat(F.lit("https://a.jp/"), F.col("p_partkey").cast("string"))
    note = F.concat(F.lit("plans of "), F.col("p_size").cast("string"))
    line = F.when(form == 0, F.concat_ws(" | ", url, F.lit("FloorPlan"), note)).when(form == 1, F.concat_ws(" | ", url, note)).otherwise(F.concat(F.lit("[Site]("), url, F.lit(") | "), "p_name"))
    rows = part.select("p_partkey", F.posexplode(F.array(F.lit("# c"), line, F.lit("no address"))).alias("i", "line")).select(F.struct("p_partkey", "i").alias("ord"), "line")
    sources = readers.source_list(readers.lines_of(spark, _texts(rows, _folder(spark, "sources"))))
    return sources.select("url", "purpose", "expected_content", "priority")


@query("""SELECT c_custkey::VARCHAR AS building_id, 'no source file' AS error FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 0)""")
def q_missing_sources(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return readers.missing_sources(t.customer.select(F.col("c_custkey").cast("string").alias("building_id")), t.orders.where("o_orderkey % 50 = 0").select(F.col("o_custkey").cast("string").alias("building_id")))


@query("""SELECT p_partkey::VARCHAR AS amenity_id, 'b' || p_size AS building_id, p_name AS amenity_name FROM part""")
def q_saved_records(spark, sf_dir):
    """Records written as JSON by table and read with their schema."""
    rows = Tables(spark, sf_dir).part.select(F.col("p_partkey").cast("string").alias("amenity_id"), F.concat(F.lit("b"), F.col("p_size").cast("string")).alias("building_id"), F.col("p_name").alias("amenity_name"))
    path = _folder(spark, "records")
    sinks.write_records({"amenity": rows}, path)
    return readers.saved_records(spark, path, "amenity").select("amenity_id", "building_id", "amenity_name")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 2 = 0 THEN (l_partkey % 40)::DOUBLE END AS area_m2, CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END AS has_window FROM lineitem WHERE l_returnflag <> 'R'""")
def q_verified_rooms(spark, sf_dir):
    """Review sheets with quotes and line feeds in their cells: rooms that somebody verified, typed."""
    t = Tables(spark, sf_dir).lineitem
    window = F.when(F.col("l_linenumber") % 3 == 0, " Yes").when(F.col("l_linenumber") % 3 == 1, "n").otherwise("?")
    sheet = t.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "N", "1").otherwise("no").alias("verified"), F.lit('a "quoted"\ncell, here').alias("note"),
        F.when(F.col("l_suppkey") % 2 == 0, (F.col("l_partkey") % 40).cast("string")).otherwise("x").alias("area_m2"), F.lit("").alias("width_m"), F.lit("2").alias("length_m"), window.alias("has_window"), F.lit("").alias("is_ensuite"),
    )
    path = _folder(spark, "rooms")
    sheet.write.option("header", True).option("escape", '"').csv(path)
    rows = readers.verified_rooms(spark, path)
    return rows.select(*[F.col(c).cast("long").alias(c) for c in ("l_orderkey", "l_partkey")], F.col("l_linenumber").cast("int").alias("l_linenumber"), "area_m2", "has_window")


STACKED = "SELECT 'b' || c_nationkey AS building_id, CASE WHEN c_custkey % 2 = 0 THEN 'B1' ELSE 'B2' END AS bang, 'b' || c_nationkey || '__' || c_custkey AS record_key, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN round(c_acctbal, 2)::VARCHAR ELSE '' END AS bal FROM customer"


@query(STACKED.replace("ELSE '' END AS bal", "END AS bal"))
def q_stacked_files(spark, sf_dir):
    """Stacked files of two headers, the columns of the second in another order, and batch files, which do not count."""
    key = F.concat(F.lit("b"), F.col("c_nationkey").cast("string"))
    even = F.col("c_custkey") % 2 == 0
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.when(even, "B1").otherwise("B2").alias("bang"), F.concat(key, F.lit("__"), F.col("c_custkey").cast("string")).alias("record_key"), F.col("c_name").alias("name"), F.round("c_acctbal", 2).cast("string").alias("bal"),
    )
    path = _folder(spark, "stacked")
    write = lambda rows, *cols: rows.select(*cols).write.mode("append").option("header", True).csv(path)
    write(c.where("c_custkey % 2 = 0"), "bang", "record_key", "name", "bal")
    write(c.where("c_custkey % 2 = 1"), "name", "record_key", "bang")
    return readers.stacked_csv(spark, path).select("building_id", "bang", "record_key", "name", "bal")


@query(f"SELECT building_id, record_key, bal, CASE WHEN bang = 'B1' THEN name END AS name FROM ({STACKED})")
def q_earlier_shards(spark, sf_dir):
    """Shards of one stamp, rewritten with other columns for some ids; columns that only some have survive."""
    key = F.concat(F.lit("b"), F.col("c_nationkey").cast("string"))
    even = F.col("c_custkey") % 2 == 0
    c = Tables(spark, sf_dir).customer.select(key.alias("building_id"), F.when(even, "B1").otherwise("B2").alias("bang"), F.concat(key, F.lit("__"), F.col("c_custkey").cast("string")).alias("record_key"), "c_name", F.when(even, F.round("c_acctbal", 2).cast("string")).otherwise("").alias("bal"))
    path = _folder(spark, "shards")
    sinks.write_shards(c.withColumn("stale", F.lit("x")), path, 3, "20260101")
    sinks.append_shards(spark, c.where("bang = 'B1'").withColumnRenamed("c_name", "name"), path, 2, "20260102")
    return readers.earlier_shards(spark, path, "20260102").unionByName(readers.earlier_shards(spark, path, "20260101").where("bang = 'B2'"), allowMissingColumns=True).select("building_id", "record_key", "bal", "name")


@query("""SELECT c_name AS query, 'b' || c_custkey AS building_id FROM customer""")
def q_done_index(spark, sf_dir):
    """JSON objects that map queries to ids, one a line, as rows."""
    pairs = Tables(spark, sf_dir).customer.select(F.to_json(F.create_map("c_name", F.concat(F.lit("b"), F.col("c_custkey").cast("string")))).alias("line"), F.col("c_custkey").alias("ord"))
    path = _folder(spark, "done")
    pairs.select("line").write.text(path)
    return readers.done_index(spark, path, whole=False)


@query("""SELECT page_id::INT AS idx, url, 'ok' AS status, length(html)::INT AS chars FROM pages""")
def q_crawl_log(spark, sf_dir):
    """The columns of the crawl log, written as a file with a header."""
    pages = Tables(spark, sf_dir).pages.select(F.col("page_id").cast("int").alias("idx"), "url", F.lit("ok").alias("status"), F.length("html").alias("chars"))
    full = pages.withColumns({c: F.lit("-") for c in schemas.CRAWL_LOG if c not in pages.columns}).withColumn("other", F.lit(1))
    path = _folder(spark, "log")
    sinks.crawl_log(full).write.option("header", True).csv(path)
    read = spark.read.csv(path, header=True)
    if read.columns != schemas.CRAWL_LOG:
        raise ValueError(f"columns of the log: {read.columns}")
    return read.select(F.col("idx").cast("int").alias("idx"), "url", "status", F.col("chars").cast("int").alias("chars"))


@query("""SELECT l_orderkey AS building_id, 'line ' || l_linenumber || ': ' || l_returnflag AS message FROM lineitem WHERE l_linenumber = 1 AND l_orderkey < 100""".replace(" AND l_orderkey < 100", ""))
def q_warning_lines(spark, sf_dir):
    """Warnings as lines of text, in folders by bucket of buildings."""
    t = Tables(spark, sf_dir).lineitem.where("l_linenumber = 1")
    rows = t.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("\t"), F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(": "), "l_returnflag").alias("message"), (F.col("l_orderkey") % 8).alias("building_id"))
    path = _folder(spark, "warnings")
    sinks.write_warnings(rows, path)
    read = spark.read.text(path).select(F.split("value", "\t").alias("v"))
    return read.select(F.col("v")[0].cast("long").alias("building_id"), F.col("v")[1].alias("message"))


@query("""SELECT p_partkey::VARCHAR AS building_id, p_name AS building_name, round(p_retailprice, 1)::VARCHAR AS height_m, NULL::VARCHAR AS city FROM part""")
def q_feature_csv(spark, sf_dir):
    """One flat row of features a building, as text cells."""
    rows = Tables(spark, sf_dir).part.select(F.col("p_partkey").cast("string").alias("building_id"), F.col("p_name").alias("building_name"), F.round("p_retailprice", 1).alias("height_m"), F.lit(None).cast("string").alias("city"))
    path = _folder(spark, "features")
    sinks.write_features(rows, path)
    return spark.read.csv(path, header=True).select("building_id", "building_name", "height_m", "city")


@query("""SELECT p_partkey % 50 AS b, count(*) AS n FROM part WHERE p_size % 2 = 0 GROUP BY 1""")
def q_site_extractors(spark, sf_dir):
    """A site's own extractor sees the pages of its hosts only; one that fails leaves an error row and the others' records."""
    part = Tables(spark, sf_dir).part
    host = F.when(F.col("p_size") % 2 == 0, "www.a.jp").otherwise("b.jp")
    pages = part.select((F.col("p_partkey") % 50).alias("b"), host.alias("host"))

    def own(rows: DataFrame) -> DataFrame:
        return rows.groupBy("b").agg(F.count("*").alias("n"))

    def broken(rows: DataFrame) -> DataFrame:
        return rows.select("no_such_column")

    found, errors = buildings.run_extractors(pages, [(own, ("a.jp",)), (broken, None)])
    if [e[0] for e in errors] != ["broken"]:
        raise ValueError(f"errors: {errors}")
    return found[0]
