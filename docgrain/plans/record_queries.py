"""Queries of records: merging, keys, overriding, stacking, carrying over, folding, evidence."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docgrain.functions import text
from docgrain.operators import derive, quality, records, stack
from docgrain.plans.registry import Tables, query
from docgrain.sources import readers, sinks


@query("""WITH r AS (SELECT c_nationkey AS k, 0 AS src, c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal END AS bal FROM customer
UNION ALL SELECT s_nationkey, 1, s_suppkey, s_name, s_acctbal FROM supplier)
SELECT k AS nationkey, arg_min(name, src * 1000000000 + id) FILTER (WHERE name IS NOT NULL) AS name, arg_min(bal, src * 1000000000 + id) FILTER (WHERE bal IS NOT NULL) AS bal,
arg_min(src, src * 1000000000 + id) FILTER (WHERE bal IS NOT NULL) AS bal_src FROM r GROUP BY k""")
def q_coalesce_merge(spark, sf_dir):
    """Customers, then suppliers, of a nation as versions of one record: of each field the first value there is."""
    t = Tables(spark, sf_dir)
    a = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.lit(0).alias("src"), F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal")).alias("bal"))
    b = t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.lit(1).alias("src"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    rows = a.unionByName(b).withColumn("from", F.col("src"))
    merged = records.coalesce_merge(rows, ["nationkey"], ["name", "bal"], ["src", "id"], "from")
    return merged.select("nationkey", "name", "bal", F.col("bal_from").alias("bal_src"))


@query("""WITH t AS (SELECT p_brand AS code, max(p_partkey) AS id FROM part GROUP BY p_brand),
r AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN '  ' || upper(p_brand) ELSE 'none' END AS code FROM part)
SELECT r.p_partkey, r.code, t.id AS type_id FROM r LEFT JOIN t ON lower(trim(r.code)) = lower(t.code)""")
def q_fk_resolve(spark, sf_dir):
    """Codes as written, in other letters with blanks, or unknown."""
    part = Tables(spark, sf_dir).part
    form = F.col("p_partkey") % 3
    rows = part.select("p_partkey", F.when(form == 0, F.col("p_brand")).when(form == 1, F.concat(F.lit("  "), F.upper("p_brand"))).otherwise("none").alias("code"))
    targets = part.select("p_brand", F.col("p_partkey").alias("type_id"))
    return records.resolve_foreign_key(rows, "code", targets, "p_brand", "type_id", "type_id")


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, 'seen' AS src FROM lineitem WHERE l_returnflag <> 'R'), b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, -l_quantity AS q, 'verified' AS src FROM lineitem WHERE l_returnflag = 'R')
SELECT * FROM a WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM b) UNION ALL SELECT * FROM b""")
def q_override_union(spark, sf_dir):
    """Lines, but for orders and line numbers of which a returned line is there."""
    t = Tables(spark, sf_dir).lineitem
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    seen = t.where("l_returnflag <> 'R'").select(*cols, F.col("l_quantity").alias("q"), F.lit("seen").alias("src"))
    better = t.where("l_returnflag = 'R'").select(*cols, (-F.col("l_quantity")).alias("q"), F.lit("verified").alias("src"))
    return records.override(seen, better, ["l_orderkey", "l_linenumber"])


@query("""WITH o AS (SELECT o_custkey AS custkey, count(*) AS n, 'orders' AS src FROM orders GROUP BY 1) SELECT * FROM o UNION ALL SELECT c_custkey, 0, 'none' FROM customer WHERE c_custkey NOT IN (SELECT custkey FROM o)""")
def q_fallback_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("n")).withColumn("src", F.lit("orders"))
    other = t.customer.select(F.col("c_custkey").alias("custkey"), F.lit(0).cast("long").alias("n"), F.lit("none").alias("src"))
    return records.fallback(rows, other, "custkey")


STACK_COLUMNS = "bang, bang_ten, record_key, record_label, r_regionkey, r_name, n_nationkey, n_name, n_regionkey, s_suppkey, s_name, s_nationkey, s_acctbal"


@query("""SELECT 'R1' AS bang, 'region' AS bang_ten, r_regionkey::VARCHAR AS record_key, r_name AS record_label, r_regionkey::VARCHAR AS r_regionkey, r_name, NULL AS n_nationkey, NULL AS n_name, NULL AS n_regionkey, NULL AS s_suppkey, NULL AS s_name, NULL AS s_nationkey FROM region
UNION ALL SELECT 'R2', 'nation', n_nationkey::VARCHAR, n_name || ' · ' || n_regionkey, NULL, NULL, n_nationkey::VARCHAR, n_name, n_regionkey::VARCHAR, NULL, NULL, NULL FROM nation
UNION ALL SELECT 'R3', 'supplier', s_suppkey::VARCHAR, s_name || ' · ' || s_nationkey, NULL, NULL, NULL, NULL, NULL, s_suppkey::VARCHAR, s_name, s_nationkey::VARCHAR FROM supplier""")
def q_stack_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tables = {"region": t.region, "nation": t.nation, "supplier": t.supplier.drop("s_acctbal")}
    labels = {"region": F.col("r_name"), "nation": stack.record_label(F.col("n_name"), F.col("n_regionkey")), "supplier": stack.record_label(F.col("s_name"), F.col("s_nationkey"))}
    return stack.stack(tables, labels, {"region": "R1", "nation": "R2", "supplier": "R3"}, {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey"})


@query("""WITH r AS (SELECT c_custkey AS building_id, c_name, c_acctbal + 1 AS bal, NULL AS note FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
n AS (SELECT *, ((dense_rank() OVER (ORDER BY building_id) - 1) % 4)::INT AS shard FROM r) SELECT building_id, c_name, round(bal, 2) AS bal, note, shard FROM n""")
def q_append_carry(spark, sf_dir):
    """Customers of every third id are rebuilt, all others carried over with a column of their own; dealt to four shards."""
    c = Tables(spark, sf_dir).customer.withColumnRenamed("c_custkey", "building_id")
    new = c.where("building_id % 3 = 0").select("building_id", "c_name", F.round(F.col("c_acctbal") + 1, 2).alias("bal"))
    old = c.select("building_id", "c_name", F.round("c_acctbal", 2).alias("bal"), F.col("c_mktsegment").alias("note"))
    return sinks.shard_of(stack.carry_over(old, new), 4)


@query("SELECT s_suppkey, s_name, CASE WHEN s_nationkey = 1 THEN 'x' ELSE '' END AS sparse FROM supplier")
def q_benchmark_nonempty_cols(spark, sf_dir):
    """Of four columns the one that is blank in all rows goes."""
    rows = Tables(spark, sf_dir).supplier.select("s_suppkey", "s_name", F.when(F.col("s_nationkey") == 1, "x").otherwise("").alias("sparse"), F.lit(" ").alias("blank"))
    return rows.select(*sinks.non_empty_columns(rows))


@query("""WITH d AS (SELECT doc_id, source, lang, nullif(trim(split_part(coalesce(text, ''), chr(10), 1)), '') AS head, CASE WHEN doc_id % 2 = 0 THEN n_chars END AS n, lower(split_part(coalesce(text, ''), chr(10), 1)) AS k FROM documents),
r AS (SELECT *, rtrim(regexp_replace(trim(k), '[ \\t\\n\\f\\r]+', ' ', 'g'), ' .') AS key, (CASE WHEN head IS NULL THEN 0 ELSE 1 END + CASE WHEN n IS NULL THEN 0 ELSE 1 END) AS rich FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rich DESC, doc_id) AS n_o FROM r)
SELECT key, arg_min(doc_id, n_o) AS doc_id, arg_min(n, n_o) FILTER (WHERE n IS NOT NULL) AS n, arg_min(source, n_o) AS source, count(*) AS versions, max(rich)::INT AS richness FROM o GROUP BY key""")
def q_entity_fold(spark, sf_dir):
    """Documents of one first line as versions of one: the richest is the base, its blanks are filled from the others."""
    d = Tables(spark, sf_dir).documents
    head = F.nullif(F.trim(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)), F.lit(""))
    rows = d.select("doc_id", "source", head.alias("head"), F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).alias("n"), text.name_key(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)).alias("key"))
    rows = rows.withColumn("richness", stack.richness(["head", "n"])).withColumn("_r", -F.col("richness"))
    folded = stack.fold(rows, "key", ["doc_id", "n", "source"], ["_r", "doc_id"])
    return folded.join(rows.groupBy("key").agg(F.max("richness").alias("richness")), "key")


@query("""SELECT c_custkey, ((CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 1 ELSE 0 END) + 3)::INT AS richness,
round(45 * ((CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 1 ELSE 0 END) + 3)::DOUBLE / 4 + 35 * (least(coalesce(n, 0) / 20.0, 1) + least(coalesce(u, 0) / 8.0, 1)) / 2 + 20 * CASE WHEN c_acctbal > 5000 THEN 1.0 WHEN c_acctbal > 0 THEN 0.6 ELSE 0.25 END, 1) AS completeness
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS u FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def q_completeness(spark, sf_dir):
    """Filled fields, orders against their targets and confidence in one score."""
    t = Tables(spark, sf_dir)
    rows = t.customer.withColumn("segment", F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).otherwise(""))
    rows = rows.withColumn("richness", stack.richness(["c_custkey", "c_name", "c_nationkey", "segment"]))
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    counted = derive.child_counts(rows, "c_custkey", {"n": orders, "u": orders.where("o_orderstatus = 'F'")})
    level = F.when(F.col("c_acctbal") > 5000, "high").when(F.col("c_acctbal") > 0, "medium").otherwise("low")
    return counted.select("c_custkey", "richness", derive.completeness(F.col("richness"), 4, {"orders": ("n", 20), "done": ("u", 8)}, level).alias("completeness"))


@query("""WITH o AS (SELECT DISTINCT 'priority' AS field, o_orderpriority AS value FROM orders UNION SELECT DISTINCT 'flag', l_returnflag FROM lineitem UNION SELECT DISTINCT 'lang', lang FROM documents),
d(field, value) AS (VALUES ('priority','1-URGENT'),('priority','2-HIGH'),('priority','9-NEVER'),('flag','A'),('flag','N'),('lang','en'),('lang','fr'),('lang','ja'))
SELECT coalesce(o.field, d.field) AS field, coalesce(o.value, d.value) AS value, CASE WHEN d.field IS NULL THEN 'extra' ELSE 'missing' END AS side FROM o FULL JOIN d ON o.field = d.field AND o.value = d.value WHERE o.field IS NULL OR d.field IS NULL""")
def q_schema_drift(spark, sf_dir):
    t = Tables(spark, sf_dir)
    seen = [df.select(F.lit(f).alias("field"), F.col(c).alias("value")).distinct() for f, df, c in (("priority", t.orders, "o_orderpriority"), ("flag", t.lineitem, "l_returnflag"), ("lang", t.documents, "lang"))]
    declared = {"priority": ["1-URGENT", "2-HIGH", "9-NEVER"], "flag": ["A", "N"], "lang": ["en", "fr", "ja"]}
    table = spark.createDataFrame([(f, v) for f, vs in declared.items() for v in vs], "field string, value string")
    return quality.drift(seen[0].unionByName(seen[1]).unionByName(seen[2]), table, ["field", "value"])


@query("""WITH f AS (SELECT doc_id, unnest(['text', 'lang', 'source']) AS field FROM documents WHERE text <> ''), p AS (SELECT doc_id, 'text' AS field FROM labels UNION SELECT doc_id, 'lang' FROM labels WHERE quality = 1),
m AS (SELECT f.doc_id, f.field, p.field IS NOT NULL AS proven FROM f LEFT JOIN p ON f.doc_id = p.doc_id AND f.field = p.field)
SELECT field, count(*) AS filled, count(CASE WHEN proven THEN 1 END) AS proven, round(count(CASE WHEN proven THEN 1 END) * 100.0 / count(*), 1) AS pct FROM m GROUP BY field""")
def q_evidence_coverage(spark, sf_dir):
    """Fields of documents that labels speak for."""
    t = Tables(spark, sf_dir)
    filled = records.filled_fields(t.documents.where("text <> ''"), "doc_id", ["text", "lang", "source"])
    proof = t.labels.select("doc_id", F.lit("text").alias("field")).union(t.labels.where("quality = 1").select("doc_id", F.lit("lang")))
    missing, _ = quality.evidence_coverage(filled, proof, ["doc_id"])
    totals = filled.groupBy("field").agg(F.count("*").alias("filled")).join(missing.groupBy("field").agg(F.count("*").alias("m")), "field", "left")
    proven = F.col("filled") - F.coalesce("m", F.lit(0))
    return totals.select("field", "filled", proven.alias("proven"), F.round(proven * 100.0 / F.col("filled"), 1).alias("pct"))


@query("""WITH p AS (SELECT d.source AS record, d.lang AS field, d.doc_id AS ord, 'u' || (d.doc_id % 3) AS url, CASE WHEN l.quality IS NULL THEN 'medium' WHEN l.quality = 1 THEN 'high' ELSE 'low' END AS confidence FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY record, field ORDER BY ord DESC) AS n FROM p)
SELECT record, arg_min(confidence, CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS confidence, string_agg(DISTINCT url, '; ' ORDER BY url) AS source_urls,
'{' || string_agg('"' || field || '":{"source_url":"' || url || '","snippet":"' || ord || '","confidence":"' || confidence || '"}', ',' ORDER BY field) FILTER (WHERE n = 1) || '}' AS evidence_json FROM r GROUP BY record""")
def q_evidence_rollup(spark, sf_dir):
    """Documents as evidence of their source: weakest confidence, sources, and the last word on each language."""
    t = Tables(spark, sf_dir)
    level = F.when(F.col("quality").isNull(), "medium").when(F.col("quality") == 1, "high").otherwise("low")
    rows = t.documents.join(t.labels, "doc_id", "left").select(F.col("source").alias("record"), F.col("lang").alias("field"), F.col("doc_id").alias("ord"), F.concat(F.lit("u"), F.col("doc_id") % 3).alias("source_url"), F.col("doc_id").cast("string").alias("snippet"), level.alias("confidence"))
    return stack.evidence_rollup(rows, ["record"])


@query("SELECT n_nationkey, n_name, coalesce(c, 0) AS customers, coalesce(s, 0) AS suppliers, first_customer FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS c, min(c_name) AS first_customer FROM customer GROUP BY 1) a ON n_nationkey = c_nationkey LEFT JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) b ON n_nationkey = s_nationkey")
def q_nested_payload(spark, sf_dir):
    """Nations with arrays of their suppliers and of the customers' segments, read back from the nested rows."""
    t = Tables(spark, sf_dir)
    customers = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_name", "c_mktsegment")
    suppliers = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_name")
    nested = sinks.nested_payload(t.nation, "n_nationkey", {"customers": customers, "suppliers": suppliers})
    count = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    return nested.select("n_nationkey", "n_name", count("customers").alias("customers"), count("suppliers").alias("suppliers"), F.get("customers.c_name", F.lit(0)).alias("first_customer"))


@query("""WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'notes.csv' ELSE 'thread' || (o_orderkey % 4) || '_' || strftime(o_orderdate, '%Y%m%d') || '.csv' END AS file_name FROM orders)
SELECT o_orderkey, file_name, regexp_extract(file_name, '_(\\d{8})', 1) AS stamp FROM b WHERE regexp_extract(file_name, '_(\\d{8})', 1) = (SELECT max(regexp_extract(file_name, '_(\\d{8})', 1)) FROM b)""".replace("\\\\", "\\"))
def q_pick_latest_batch(spark, sf_dir):
    """Orders as rows of batch files of their day: those of the newest day."""
    name = F.when(F.col("o_orderkey") % 7 == 0, "notes.csv").otherwise(F.concat(F.lit("thread"), F.col("o_orderkey") % 4, F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")))
    return readers.latest_batch(Tables(spark, sf_dir).orders.select("o_orderkey", name.alias("file_name")))


@query("""WITH d AS (SELECT o_custkey, count(*) AS ok FROM orders GROUP BY 1) SELECT c_custkey AS building_id, coalesce(ok, 0) AS ok FROM customer LEFT JOIN d ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND coalesce(ok, 0) < 5""")
def q_skip_done(spark, sf_dir):
    """Wanted customers (one segment) that do not have five orders yet."""
    t = Tables(spark, sf_dir)
    counts = t.orders.groupBy(F.col("o_custkey").alias("building_id")).agg(F.count("*").alias("ok"))
    ids = t.customer.select(F.col("c_custkey").alias("building_id")).join(counts, "building_id", "left").withColumn("ok", F.coalesce("ok", F.lit(0)))
    only = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("building_id"))
    done = ids.where(records.is_done(F.col("ok"), 5, F.lit(False)))
    return records.select_run(ids, only, done, None)


@query("""WITH q AS (SELECT c_custkey, c_name AS query FROM customer), o AS (SELECT c_name AS query, 'o' || c_custkey AS id FROM customer WHERE c_custkey % 10 = 0), i AS (SELECT c_name AS query, 'i' || c_custkey AS id FROM customer WHERE c_custkey % 5 = 0), s AS (SELECT c_name AS query, 's' || c_custkey AS id FROM customer WHERE c_custkey % 3 = 0)
SELECT q.query, coalesce(o.id, i.id, s.id, regexp_replace(lower(q.query), '[^a-z0-9]+', '_', 'g')) AS building_id FROM q LEFT JOIN o USING (query) LEFT JOIN i USING (query) LEFT JOIN s USING (query)""")
def q_resolve_ids(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(F.col("c_name").alias("query"), "c_custkey")
    given = lambda n, p: c.where(F.col("c_custkey") % n == 0).select("query", F.concat(F.lit(p), F.col("c_custkey")).alias("building_id"))
    return records.resolve_ids(c.select("query"), given(10, "o"), given(5, "i"), given(3, "s"), text.slug("query"))


@query("""SELECT l_orderkey AS building_id, l_linenumber AS line, CASE WHEN l_partkey % 4 = 0 THEN 'u' || l_suppkey END AS source_url FROM lineitem""")
def q_provenance_index(spark, sf_dir):
    """Evidence from files of lines: by path where it is given, else by the file's name; other files have no source."""
    t = Tables(spark, sf_dir).lineitem
    own = F.concat("l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_"), "l_suppkey", F.lit(".txt"))
    sources = t.where("l_partkey % 4 = 0").select(F.col("l_orderkey").alias("building_id"), F.concat(F.lit("raw/"), own).alias("text_file"), F.lit("").alias("raw_file"), F.lit(None).cast("string").alias("shot_file"), F.lit(None).cast("array<string>").alias("floorplan_files"), F.concat(F.lit("u"), "l_suppkey").alias("url"), F.lit("2026-01-01").alias("accessed_at"))
    proof = t.select(F.col("l_orderkey").alias("building_id"), F.col("l_linenumber").alias("line"), F.when(F.col("l_partkey") % 8 == 0, F.concat(F.lit("raw/"), own)).otherwise(own).alias("source_file"))
    return records.with_source(proof, records.file_index(sources)).select("building_id", "line", "source_url")


@query("""WITH m AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) SELECT o_custkey AS query, o_orderkey AS building_id FROM m WHERE n = 1""")
def q_upsert_latest(spark, sf_dir):
    """Orders of even keys as the index there is, those of odd keys as news: the newest of each customer counts."""
    o = Tables(spark, sf_dir).orders.select(F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("building_id"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return sinks.upsert(o.where("building_id % 2 = 0"), o.where("building_id % 2 = 1"), "query", "at").drop("at")
