"""Queries of rollups, price indices, counts, reports and data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.operators import derive, quality
from docgrain.plans.registry import Tables, query
from docgrain.sources import readers


@query("""WITH w AS (SELECT l_suppkey, l_returnflag, sum(coalesce(nullif(l_quantity, 0), 1)) AS w, min(l_orderkey * 10 + l_linenumber) AS f FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY w DESC, f) AS n FROM w)
SELECT l_suppkey, l_returnflag AS mode FROM r WHERE n = 1""")
def q_weighted_mode(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.withColumn("share", F.lit(None).cast("double"))
    return derive.weighted_mode(rows, "l_suppkey", "l_returnflag", derive.weight("l_quantity", "share", 1.0), F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("""WITH w AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_returnflag, round(w / sum(w) OVER (PARTITION BY l_suppkey) * 100, 1) AS pct FROM w""")
def q_mix_pct(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.withColumn("share", F.lit(None).cast("double"))
    return derive.mix_percent(rows, "l_suppkey", "l_returnflag", derive.weight("l_quantity", "share", 0.0))


@query("""SELECT p_brand, coalesce(min(CASE WHEN p_type = 'PROMO' AND p_brand <> 'Brand#7' THEN p_retailprice END), min(p_retailprice)) AS lo, coalesce(max(CASE WHEN p_type = 'PROMO' AND p_brand <> 'Brand#7' THEN p_retailprice END), max(p_retailprice)) AS hi,
max(CASE WHEN p_type = 'STANDARD' THEN p_size END) AS typical FROM part GROUP BY p_brand""")
def q_minmax_fallback(spark, sf_dir):
    """Price bounds of promotions, of all parts where a brand has none; the largest standard size."""
    rows = Tables(spark, sf_dir).part.withColumn("net", F.when((F.col("p_type") == "PROMO") & (F.col("p_brand") != "Brand#7"), F.col("p_retailprice")))
    typical = rows.groupBy("p_brand").agg(F.max(F.when(F.col("p_type") == "STANDARD", F.col("p_size"))).alias("typical"))
    return derive.bounds_with_fallback(rows, "p_brand", "net", "p_retailprice").join(typical, "p_brand")


@query("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities, string_agg(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, '; ' ORDER BY CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS done FROM orders GROUP BY o_custkey""")
def q_distinct_lists(spark, sf_dir):
    done = derive.distinct_list(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))
    return Tables(spark, sf_dir).orders.groupBy("o_custkey").agg(F.array_join(derive.distinct_list("o_orderpriority"), "; ").alias("priorities"), F.array_join(done, "; ").alias("done"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) SELECT p_brand, count(*) AS parts, string_agg(CASE WHEN n <= 8 THEN p_name END, '; ' ORDER BY n) AS highlights FROM r GROUP BY p_brand""")
def q_top_highlights(spark, sf_dir):
    """Count of parts and the first eight names of each brand; only eight rows of a brand are gathered."""
    part = Tables(spark, sf_dir).part
    first = derive.top_rows(part, ["p_brand"], ["p_partkey"], 8).groupBy("p_brand").agg(F.array_join(derive.highlights("p_partkey", "p_name"), "; ").alias("highlights"))
    return part.groupBy("p_brand").agg(F.count("*").alias("parts")).join(first, "p_brand")


FX_SQL = "fx(currency, usd_rate) AS (VALUES " + ", ".join(f"('{c}', {r!r})" for c, r in schemas.FX_TO_USD.items()) + ")"


@query(f"""WITH {FX_SQL}, l AS (SELECT l_suppkey, CASE l_linestatus WHEN 'F' THEN 'so_cap' ELSE 'thu_cap' END AS market, CASE l_suppkey % 3 WHEN 0 THEN 'VND' WHEN 1 THEN 'JPY' ELSE 'XXX' END AS currency,
CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice ELSE (l_extendedprice + (l_extendedprice + 100)) / 2 END AS avg, CASE WHEN l_suppkey % 7 = 0 AND l_returnflag = 'R' THEN 'gross' ELSE 'net' END AS basis FROM lineitem),
p AS (SELECT *, (round((avg * usd_rate)::VARCHAR::DECIMAL(38, 20), 2) * 100)::HUGEINT AS cents FROM l LEFT JOIN fx USING (currency)),
a AS (SELECT l_suppkey, sum(CASE WHEN market = 'so_cap' AND cents <> 0 THEN cents END) AS p, count(CASE WHEN market = 'so_cap' AND cents <> 0 THEN 1 END)::HUGEINT AS np, sum(CASE WHEN market = 'thu_cap' AND cents <> 0 THEN cents END) AS s, count(CASE WHEN market = 'thu_cap' AND cents <> 0 THEN 1 END)::HUGEINT AS ns,
count(DISTINCT CASE WHEN cents <> 0 THEN basis END) AS k FROM p GROUP BY l_suppkey), b AS (SELECT *, s * np - p * ns AS d, nullif(p * ns, 0) AS base FROM a)
SELECT l_suppkey, sign(p) * ((abs(p) * 20 + np * 100) // (np * 200)) / 10 AS usd_primary, sign(s) * ((abs(s) * 20 + ns * 100) // (ns * 200)) / 10 AS usd_secondary,
CASE WHEN k = 1 THEN sign(d) * sign(base) * ((abs(d) * 2000 + abs(base)) // (abs(base) * 2)) / 10 END AS premium_pct FROM b""")
def q_price_benchmark(spark, sf_dir):
    """Lines as prices of two markets in three currencies, one of which has no rate; some suppliers mix two bases. Means and
    premiums are rounded half up from whole cents."""
    from docgrain.functions.numbers import average_price

    t, key = Tables(spark, sf_dir).lineitem, F.col("l_suppkey")
    given = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice"))
    rows = t.select(
        "l_suppkey", F.when(F.col("l_linestatus") == "F", "so_cap").otherwise("thu_cap").alias("market"), F.when(key % 3 == 0, "VND").when(key % 3 == 1, "JPY").otherwise("XXX").alias("currency"), F.lit("per_m2").alias("price_unit"),
        average_price(given, F.col("l_extendedprice"), F.col("l_extendedprice") + 100).alias("price_avg"), F.when((key % 7 == 0) & (F.col("l_returnflag") == "R"), "gross").otherwise("net").alias("price_basis"), F.lit(None).cast("boolean").alias("includes_vat"),
    )
    fx = spark.createDataFrame(list(schemas.FX_TO_USD.items()), "currency string, usd_rate double")
    return derive.price_index(derive.usd_per_m2(rows, fx), "l_suppkey")


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate)::INT AS y, avg(o_totalprice) AS m FROM orders GROUP BY 1, 2), l AS (SELECT *, lag(y) OVER w AS y0, lag(m) OVER w AS m0, row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC) AS n FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY y))
SELECT o_custkey, y AS last_year, CASE WHEN y - y0 = 1 THEN round((m / m0 - 1) * 100, 1) END AS growth_pct FROM l WHERE n = 1""")
def q_yoy_growth(spark, sf_dir):
    rows = Tables(spark, sf_dir).orders.withColumn("year", F.year("o_orderdate"))
    return derive.growth_yoy(rows, "o_custkey", "year", "o_totalprice")


@query("""SELECT n_nationkey, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers, coalesce(o.n, 0) AS orders FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) c ON k = n_nationkey
LEFT JOIN (SELECT s_nationkey AS k2, count(*) AS n FROM supplier GROUP BY 1) s ON k2 = n_nationkey LEFT JOIN (SELECT c_nationkey AS k3, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) o ON k3 = n_nationkey""")
def q_child_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    customers = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    orders = t.orders.groupBy("o_custkey").agg(F.count("*").alias("m")).join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_nationkey").agg(F.sum("m").alias("orders"))
    counted = derive.child_counts(t.nation.select("n_nationkey"), "n_nationkey", {"customers": customers, "suppliers": t.supplier.withColumnRenamed("s_nationkey", "n_nationkey")})
    return counted.join(orders, "n_nationkey", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("""WITH e AS (SELECT split_part(event_type || ':' || (user_id % 5), ':', 1) AS step, value, (props->>'k')::BIGINT AS k FROM events)
SELECT step, count(*) AS calls, sum(k)::BIGINT AS secs, sum(k * 10)::BIGINT AS tokens_in, sum(k * 3)::BIGINT AS tokens_out, round(sum(k * 10 * 0.003 + k * 3 * 0.015)::DOUBLE, 4) AS cost, grouping(step)::INT AS is_total FROM e GROUP BY ROLLUP (step)""")
def q_usage_rollup(spark, sf_dir):
    """Events as a ledger of calls: totals of each step, and of all."""
    k = F.get_json_object("props", "$.k").cast("long")
    calls = Tables(spark, sf_dir).events.select(F.concat("event_type", F.lit(":"), F.col("user_id") % 5).alias("label"), F.lit(1).alias("calls"), k.alias("secs"), (k * 10).alias("tokens_in"), (k * 3).alias("tokens_out"))
    return derive.usage_rollup(calls, F.col("tokens_in") * 0.003 + F.col("tokens_out") * 0.015)


@query("""WITH r AS (SELECT o_orderpriority, o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) SELECT * FROM r WHERE rank <= 5""")
def q_stratified_sample(spark, sf_dir):
    """The five dearest orders of each priority: a report."""
    from pyspark.sql import Window

    rows = Tables(spark, sf_dir).orders
    rank = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return rows.withColumn("rank", rank).where("rank <= 5").select("o_orderpriority", "o_orderkey", "o_custkey", "rank")


@query("SELECT coalesce(CASE WHEN c_nationkey % 9 = 0 THEN NULL ELSE n_name END, 'unknown') AS country, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def q_facets(spark, sf_dir):
    t = Tables(spark, sf_dir)
    counted = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    rows = counted.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.coalesce(F.when(F.col("c_nationkey") % 9 != 0, F.col("n_name")), F.lit("unknown")).alias("country")).agg(F.sum("n").alias("customers"))


@query("SELECT c_mktsegment, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 2) AS middle FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def q_local_price_range(spark, sf_dir):
    """Prices of each market by themselves. The exact middle counts the distinct prices of a market."""
    t = Tables(spark, sf_dir)
    joined = t.orders.select("o_custkey", "o_totalprice").join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"), F.count("*").alias("n"), F.round(F.percentile("o_totalprice", F.lit(0.5)), 2).alias("middle"))


@query("""WITH f AS (SELECT p_partkey, unnest(['size', 'price', 'name']) AS col, unnest([CASE WHEN p_size % 3 = 0 THEN 'measured' ELSE 'derived' END, CASE WHEN p_retailprice > 1000 THEN 'policy' ELSE 'measured' END, 'measured']) AS basis FROM part)
SELECT col, basis, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY col), 1) AS pct FROM f GROUP BY col, basis""")
def q_basis_share(spark, sf_dir):
    """How many values of each column are measured, derived or set by policy."""
    rows = Tables(spark, sf_dir).part.select(
        F.when(F.col("p_size") % 3 == 0, "measured").otherwise("derived").alias("size_basis"), F.when(F.col("p_retailprice") > 1000, "policy").otherwise("measured").alias("price_basis"), F.lit("measured").alias("name_basis")
    )
    from pyspark.sql import Window

    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c[: -len("_basis")]).alias("col"), F.col(c).alias("basis")) for c in rows.columns])).alias("x")).select("x.*")
    counted = long.groupBy("col", "basis").agg(F.count("*").alias("n"))
    return counted.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("col")), 1))


@query("""SELECT l_shipmode_kind AS mix_kind, part, round(sum(q), 2) AS total FROM (SELECT CASE l_linenumber % 3 WHEN 0 THEN 'units' WHEN 1 THEN 'area' ELSE 'share' END AS l_shipmode_kind, l_returnflag AS part, l_quantity AS q FROM lineitem) GROUP BY 1, 2""")
def q_mix_decomposition(spark, sf_dir):
    """JSON mixes of three meanings, taken apart by kind and never added together."""
    kind = F.element_at(F.array(F.lit("units"), F.lit("area"), F.lit("share")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    rows = Tables(spark, sf_dir).lineitem.select(kind.alias("mix_kind"), F.to_json(F.create_map(F.col("l_returnflag"), F.col("l_quantity"))).alias("mix"))
    parts = rows.select("mix_kind", F.explode(F.from_json("mix", "map<string,double>")).alias("part", "q"))
    return parts.groupBy("mix_kind", "part").agg(F.round(F.sum("q"), 2).alias("total"))


@query("""SELECT o_orderkey, 'price' AS field, o_totalprice AS value FROM orders WHERE NOT o_totalprice BETWEEN 1000 AND 400000 UNION ALL SELECT o_orderkey, 'year', year(o_orderdate)::DOUBLE FROM orders WHERE NOT year(o_orderdate) BETWEEN 1996 AND 2000""")
def q_quality_range(spark, sf_dir):
    rows = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))
    return quality.out_of_range(rows, "o_orderkey", {"price": (1000, 400_000), "year": (1996, 2000)})


@query("""WITH l AS (SELECT l_orderkey, sum(cast(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS total, count(*) AS n FROM lineitem GROUP BY 1) SELECT o_orderkey, n, round(total, 2) AS total, o_totalprice AS stated FROM orders JOIN l ON o_orderkey = l_orderkey WHERE abs(total - o_totalprice) / o_totalprice > 0.15""")
def q_quality_sum(spark, sf_dir):
    """Sums of parts that differ from the stated total by more than 15 %."""
    t = Tables(spark, sf_dir)
    sums = quality.sums_against(t.lineitem, "l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)")).withColumn("total", F.col("total").cast("double"))
    rows = t.orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.where(F.abs(F.col("total") - F.col("o_totalprice")) / F.col("o_totalprice") > 0.15).select("o_orderkey", "n", F.round("total", 2).alias("total"), F.col("o_totalprice").alias("stated"))


@query("""SELECT 'lineitem' AS name, count(*) AS rows, count(CASE WHEN k IS NULL THEN 1 END) AS empty, count(k) - count(DISTINCT k) AS duplicate FROM (SELECT CASE WHEN l_quantity > 1 THEN l_orderkey || '__' || l_linenumber END AS k FROM lineitem)
UNION ALL SELECT 'part', count(*), 0, count(p_name) - count(DISTINCT p_name) FROM part""")
def q_quality_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = t.lineitem.select(F.when(F.col("l_quantity") > 1, F.concat_ws("__", "l_orderkey", "l_linenumber")).alias("k"))
    named = lambda df, n: df.select(F.lit(n).alias("name"), "*")
    return named(quality.key_problems(lines, "k"), "lineitem").unionByName(named(quality.key_problems(t.part, "p_name"), "part"))


@query("""SELECT o_orderkey, field FROM (SELECT o_orderkey, unnest(['status', 'priority', 'clerk']) AS field, unnest([o_orderstatus, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' ' ELSE o_orderpriority END, CASE WHEN o_orderkey % 3 <> 0 THEN 'c' END]) AS v FROM orders) WHERE nullif(trim(v), '') IS NULL""")
def q_quality_mandatory(spark, sf_dir):
    rows = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ").otherwise(F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 3 != 0, "c").alias("clerk"))
    return quality.missing_fields(rows, ["o_orderkey"], ["status", "priority", "clerk"])


@query("""WITH t AS (SELECT p_partkey AS unit_type_id, p_brand AS building_id, p_retailprice AS gross, p_size % 4 AS bedrooms FROM part), r AS (SELECT l_partkey, sum(l_quantity * 10) AS rooms, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS beds FROM lineitem GROUP BY 1),
j AS (SELECT *, (gross - rooms) / gross * 100 AS gap FROM t JOIN r ON unit_type_id = l_partkey)
SELECT building_id, 'V2' AS rule, unit_type_id::VARCHAR AS record FROM j WHERE rooms > gross UNION ALL SELECT building_id, 'V3', unit_type_id::VARCHAR FROM j WHERE NOT rooms > gross AND NOT gap BETWEEN 5 AND 15
UNION ALL SELECT building_id, 'V4', unit_type_id::VARCHAR FROM j WHERE beds > 0 AND beds <> bedrooms""")
def q_quality_gap(spark, sf_dir):
    """Parts as types and their lines as rooms: rooms larger than gross, share of walls, bedrooms."""
    t = Tables(spark, sf_dir)
    types = t.part.select(F.col("p_partkey").alias("unit_type_id"), F.col("p_brand").alias("building_id"), F.col("p_retailprice").alias("area_gross_m2"), (F.col("p_size") % 4).alias("bedrooms"))
    rooms = t.lineitem.select(F.col("l_partkey").alias("unit_type_id"), (F.col("l_quantity") * 10).alias("area_m2"), F.when(F.col("l_returnflag") == "R", "phong_ngu_2").otherwise("bep").alias("room_type"))
    return quality.room_rules(types, rooms).select("building_id", "rule", "record")


@query("""WITH t AS (SELECT p_brand AS building_id, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS net, p_size - 1 + p_partkey % 3 AS gross, CASE WHEN p_partkey % 4 <> 0 THEN 'x' END AS basis, p_partkey FROM part), s AS (SELECT building_id, count(net) AS net, count(*) AS n FROM t GROUP BY 1)
SELECT building_id, 'V8' AS rule, p_partkey::VARCHAR AS record FROM t WHERE basis IS NULL UNION ALL SELECT building_id, 'V9', p_partkey::VARCHAR FROM t WHERE net > gross UNION ALL SELECT building_id, 'V13', building_id FROM s WHERE net > 0 AND net < n""")
def q_quality_types(spark, sf_dir):
    key = F.col("p_partkey")
    types = Tables(spark, sf_dir).part.select(
        F.col("p_brand").alias("building_id"), key.alias("unit_type_id"), F.when(key % 5 != 0, F.col("p_size").cast("double")).alias("area_net_m2"), (F.col("p_size") - 1 + key % 3).cast("double").alias("area_gross_m2"), F.when(key % 4 != 0, "x").alias("area_basis_reported")
    )
    return quality.type_rules(types).select("building_id", "rule", "record")


@query("""WITH s AS (SELECT o_custkey, count(*) AS total, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS ok, sum(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS images FROM orders GROUP BY 1) SELECT o_custkey AS building_id, total, ok, images FROM s""")
def q_manifest_rollup(spark, sf_dir):
    """Orders as fetched sources of their customer: how many, how many went well, how many images."""
    files = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("a"), F.lit("b")))
    rows = Tables(spark, sf_dir).orders.select(F.col("o_custkey").alias("building_id"), F.when(F.col("o_orderstatus") == "O", "ok").otherwise("error").alias("status"), files.alias("floorplan_files"))
    return derive.manifest_rollup(rows)


@query("""WITH n AS (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'b' || (doc_id % 50) || '__t' || doc_id ELSE 'plain' || doc_id END AS record_key FROM documents)
SELECT doc_id, coalesce(CASE WHEN contains(record_key, '__') THEN split_part(record_key, '__', 1) END, source) AS building_id FROM n""")
def q_owner_of_rows(spark, sf_dir):
    """Whose row it is: the part of its key before the double underscore, else the file's name."""
    key = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("b"), F.col("doc_id") % 50, F.lit("__t"), "doc_id")).when(F.col("doc_id") % 3 == 2, F.concat(F.lit("plain"), "doc_id"))
    rows = Tables(spark, sf_dir).documents.select("doc_id", "source", key.alias("record_key"))
    return rows.select("doc_id", F.coalesce(readers.owner_of_key("record_key"), "source").alias("building_id"))
