"""Queries over pages and documents: URLs, hosts, text, cells, dictionaries, blocks, terms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgrain.functions import domain, text
from docgrain.operators import cells, dictionary, terms
from docgrain.plans.registry import Tables, query, spread
from docgrain.sources.stages import shared_dir
from docgrain.sources import readers
from docgrain.streaming import ingest

URL_SQL = r"""
w AS (SELECT *, regexp_replace(url, '#.*$', '') AS whole FROM pages),
q AS (SELECT *, split_part(whole, '?', 1) AS base, list_filter(string_split(regexp_extract(whole, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')) AS ps FROM w),
c AS (SELECT page_id, url AS raw_url, html, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host, CASE WHEN len(ps) = 0 THEN base ELSE base || '?' || array_to_string(ps, '&') END AS curl FROM q)
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).pages.select("page_id", "html", F.col("url").alias("raw_url"), text.canonical_url("url").alias("url"), text.host("url").alias("host"))


@query(f"WITH {URL_SQL} SELECT curl AS url, any_value(host) AS host, min(page_id) AS page_id, count(*) AS copies FROM c GROUP BY curl")
def q_url_canonical(spark, sf_dir):
    rows = _pages(spark, sf_dir)
    return rows.groupBy("url").agg(F.min("host").alias("host"), F.min("page_id").alias("page_id"), F.count("*").alias("copies"))


VISIBLE_SQL = r"""
v AS (SELECT page_id, url, html, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', chr(10), 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]+>', chr(10), 'g') AS t FROM pages),
e AS (SELECT page_id, url, html, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM v),
lines AS (SELECT page_id, url, html, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM e)
"""


@query(f"""WITH {VISIBLE_SQL} SELECT page_id, regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '^[[:space:]]+|[[:space:]]+$', '', 'g') AS title,
len(ls)::BIGINT AS n_lines, length(array_to_string(ls, chr(10)))::BIGINT AS n_chars, coalesce(list_max(list_transform(ls, lambda x: length(x))), 0)::BIGINT AS longest FROM lines""")
def q_page_text_stats(spark, sf_dir):
    rows = Tables(spark, sf_dir).pages.select("page_id", text.page_title("html").alias("title"), text.visible_lines("html").alias("ls"))
    longest = F.coalesce(F.array_max(F.transform("ls", lambda x: F.length(x))), F.lit(0))
    return rows.select("page_id", "title", F.size("ls").cast("long").alias("n_lines"), F.length(F.array_join("ls", "\n")).cast("long").alias("n_chars"), longest.cast("long").alias("longest"))


@query(f"WITH {URL_SQL}, f AS (SELECT curl, any_value(host) AS host, min(page_id) AS page_id FROM c GROUP BY curl) SELECT host, count(*) AS pages, min(page_id) AS first_page, count(*) = 1 AS is_single FROM f GROUP BY host")
def q_host_profile(spark, sf_dir):
    """Pages of each host, counted once a canonical URL, and the first of them."""
    return terms.host_profile(q_url_canonical(spark, sf_dir), "host", "page_id", "page_id")


@query(f"WITH {URL_SQL} SELECT * FROM (SELECT host, page_id, length(html)::BIGINT AS size, row_number() OVER (PARTITION BY host ORDER BY length(html) DESC, page_id) AS rank FROM c) WHERE rank <= 3")
def q_host_top_pages(spark, sf_dir):
    rows = _pages(spark, sf_dir).select("host", "page_id", F.length("html").cast("long").alias("size"))
    return terms.top_pages(rows, "host", "size", "page_id")


@query(f"""WITH {URL_SQL}, h AS (SELECT host, min(page_id) AS page_id FROM c GROUP BY host HAVING count(*) = 1), n AS (SELECT *, row_number() OVER (ORDER BY host) - 1 AS k, greatest(1, count(*) OVER () // 14) AS step FROM h)
SELECT host, page_id, (k // step)::INT AS pick FROM n WHERE k % step = 0 AND k // step < 14""")
def q_host_systematic_sample(spark, sf_dir):
    """At most 14 hosts of a single page, evenly over their order, for people to read."""
    single = _pages(spark, sf_dir).groupBy("host").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    return terms.systematic_sample(single, "host", 14)


@query(f"WITH {URL_SQL}, t AS (SELECT host, unnest(regexp_extract_all(lower(html), '<([a-z][a-z0-9]*)', 1)) AS tag FROM c) SELECT host, tag, count(*) AS n FROM t GROUP BY host, tag")
def q_tag_profile(spark, sf_dir):
    return _pages(spark, sf_dir).select("host", F.explode(text.tags("html")).alias("tag")).groupBy("host", "tag").agg(F.count("*").alias("n"))




@query(f"""WITH {URL_SQL}, u AS (SELECT page_id, host, regexp_extract(raw_url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM c)
SELECT page_id, host, path, CASE WHEN starts_with(host, 'www.') THEN true WHEN starts_with(host, 'm.') THEN false WHEN starts_with(path, '/en/1') THEN true WHEN starts_with(path, '/en/') THEN false ELSE true END AS allowed FROM u""")
def q_host_policy_gate(spark, sf_dir):
    """Each URL against its host's rules: hosts that answer 403 deny all, the first prefix that fits decides, no rule allows."""
    urls = _pages(spark, sf_dir).select("page_id", "host", text.url_path("raw_url").alias("path"))
    rules = F.array(*[F.struct(F.lit(o).alias("rule_ord"), F.lit(p).alias("prefix"), F.lit(a).alias("allow")) for o, p, a in ((1, "/en/1", True), (2, "/en/", False), (3, "/", True))])
    hosts = urls.select("host").distinct().where(~F.col("host").startswith("www."))
    policy = hosts.select("host", F.when(F.col("host").startswith("m."), 403).otherwise(200).alias("http_status"), F.explode(rules).alias("r")).select("host", "http_status", "r.*")
    return cells.host_gate(urls, policy)


@query(f"""WITH {URL_SQL}, u AS (SELECT page_id, host, CASE WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'commercial' WHEN host LIKE '%.example.net' THEN 'network' END AS site FROM c)
SELECT coalesce(site, 'generic') AS site, count(*) AS pages, count(DISTINCT host) AS hosts FROM u GROUP BY 1""")
def q_host_dispatch(spark, sf_dir):
    sites = spark.createDataFrame([("commercial", "example.com", 1), ("network", "example.net", 2)], "site string, pattern string, site_ord int")
    found = cells.host_dispatch(_pages(spark, sf_dir).select("page_id", "host"), sites)
    return found.groupBy(F.coalesce("site", F.lit("generic")).alias("site")).agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"))


@query(f"""WITH {URL_SQL}, f AS (SELECT host AS building_id, curl AS url, min(page_id) AS page_id FROM c WHERE page_id % 2 = 1 AND curl NOT IN (SELECT curl FROM c WHERE page_id % 2 = 0) GROUP BY host, curl),
m AS (SELECT host AS building_id, max(page_id) AS last FROM c WHERE page_id % 2 = 0 GROUP BY host)
SELECT f.building_id, url, page_id, (coalesce(last, 0) + row_number() OVER (PARTITION BY f.building_id ORDER BY page_id))::BIGINT AS new_idx FROM f LEFT JOIN m USING (building_id)""")
def q_url_incremental(spark, sf_dir):
    """Pages of odd ids as new sources, those of even ids as crawled ones."""
    rows = _pages(spark, sf_dir).select(F.col("host").alias("building_id"), F.col("raw_url").alias("url"), F.col("page_id").alias("idx"))
    out = readers.new_urls(rows.where("idx % 2 = 1"), rows.where("idx % 2 = 0"))
    return out.select("building_id", "url", F.col("idx").alias("page_id"), "new_idx")


@query("""WITH d AS (SELECT source, doc_id, least(length(coalesce(text, '')), 8000) AS n FROM documents), r AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY doc_id) AS used FROM d)
SELECT source, count(*) AS texts, max(used)::BIGINT AS used FROM r WHERE used <= 60000 GROUP BY source""")
def q_corpus_budget(spark, sf_dir):
    """Texts of a source that fit its budget: a text counts for 8,000 characters at most, all for 60,000."""
    rows = Tables(spark, sf_dir).documents.select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kept = cells.budgeted(rows, "source", "doc_id", "text", 8_000, 60_000)
    return kept.groupBy("source").agg(F.count("*").alias("texts"), F.max("used").alias("used"))


TERMS = [("thation", "T1", "a"), ("thering", "T2", "a"), ("enation", "T2", "b"), ("Licensed", "T3", "c"), ("token", "T4", "c")]


@query("""WITH t(term, code, category, dict_idx) AS (VALUES ('thation','T1','a',0),('thering','T2','a',1),('enation','T2','b',2),('Licensed','T3','c',3),('token','T4','c',4)),
m AS (SELECT source, doc_id, code, term, category, dict_idx, row_number() OVER (PARTITION BY source, code ORDER BY doc_id, dict_idx) AS n FROM documents, t WHERE contains(text, term))
SELECT source, doc_id, code, term, category FROM m WHERE n = 1""")
def q_dictionary_match(spark, sf_dir):
    """The first document and term of each code in each source."""
    docs = Tables(spark, sf_dir).documents.select("source", "doc_id", "text")
    found = cells.dictionary_matches(docs, ["source", "doc_id"], "text", TERMS, ["term", "code", "category"])
    return cells.first_per_code(found, "source", "code", ["doc_id", "dict_idx"]).select("source", "doc_id", "code", "term", "category")


@query(f"""WITH {VISIBLE_SQL}, k AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host, ls, generate_subscripts(ls, 1) AS kv_idx FROM lines),
cells AS (SELECT page_id, host, kv_idx - 1 AS kv_idx, split_part(ls[kv_idx], ' ', 1) AS label, trim(substr(ls[kv_idx], length(split_part(ls[kv_idx], ' ', 1)) + 1)) AS value FROM k),
l(field, pattern, label_rank) AS (VALUES ('first', 'The', 0), ('first', 'And', 1), ('second', 'In', 0), ('second', 'Th', 1)),
m AS (SELECT host, field, label, page_id, kv_idx, row_number() OVER (PARTITION BY host, field ORDER BY label_rank, CASE WHEN page_id % 2 = 0 THEN 0 ELSE 1 END, page_id, kv_idx) AS n FROM cells JOIN l ON contains(label, pattern) WHERE value <> '')
SELECT host, field, label, page_id, kv_idx::INT AS kv_idx FROM m WHERE n = 1""")
def q_label_priority_pick(spark, sf_dir):
    """Lines of pages as cells (first word and rest): the best cell of each field of each host, by label, trust, page and cell."""
    lines = Tables(spark, sf_dir).pages.select("page_id", text.host("url").alias("host"), F.posexplode(text.visible_lines("html")).alias("kv_idx", "line"))
    label = F.substring_index("line", " ", 1)
    rows = lines.select("page_id", "host", "kv_idx", label.alias("label"), F.trim(F.substr("line", F.length(label) + 1)).alias("value"), F.when(F.col("page_id") % 2 == 0, 0).otherwise(1).alias("trust"))
    labels = [("first", "The", 0), ("first", "And", 1), ("second", "In", 0), ("second", "Th", 1)]
    best = cells.best_cell(cells.label_matches(rows, labels), "host", ["label_rank", "trust", "page_id", "kv_idx"])
    return best.select("host", "field", "label", "page_id", "kv_idx")


@query("""WITH b AS (SELECT conv_id, turn, role, length(coalesce(text, '')) AS n, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM conversations)
SELECT conv_id, block::BIGINT AS block, count(*) AS turns, min(turn) AS first_turn, arg_min(role, turn) AS opened_by, sum(n)::BIGINT AS chars FROM b GROUP BY conv_id, block""")
def q_block_segmentation(spark, sf_dir):
    """A user's turn opens a block."""
    rows = Tables(spark, sf_dir).conversations
    blocks = cells.segment(rows, ["conv_id"], "turn", F.col("role") == "user")
    return blocks.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"), F.min_by("role", "turn").alias("opened_by"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


@query("""WITH a AS (SELECT conv_id, turn, role, list(split_part(coalesce(text, ''), ' ', 1)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS w FROM conversations)
SELECT conv_id, turn, coalesce(array_to_string(list_filter(w, lambda x: x <> ''), ' '), '') AS ahead, coalesce(list_filter(w, lambda x: x <> '')[2], '') AS second FROM a WHERE role = 'user'""")
def q_lookahead_window(spark, sf_dir):
    """First words of the three turns after each user's turn."""
    rows = Tables(spark, sf_dir).conversations.withColumn("line", F.substring_index(F.coalesce("text", F.lit("")), " ", 1))
    ahead = cells.look_ahead(rows, ["conv_id"], "turn", "line", 3).where("role = 'user'")
    return ahead.select("conv_id", "turn", F.array_join("window", " ").alias("ahead"), F.coalesce(F.get("window", F.lit(1)), F.lit("")).alias("second"))


MISS_SQL = r"""
w AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS term FROM documents),
b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS term FROM benchmark),
m AS (SELECT term, count(*) AS count FROM w WHERE term NOT IN (SELECT term FROM b) GROUP BY term)
"""


def _misses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = Tables(spark, sf_dir)
    found = terms.words(t.documents, [], "text", "[a-z]+").groupBy("term").agg(F.count("*").alias("count"))
    known = terms.words(t.benchmark, [], "text", "[a-z]+").select("term", F.col("term").alias("translation"), F.lit(0).alias("src_rank")).dropDuplicates(["term"])
    return found, known


@query(f"WITH {MISS_SQL} SELECT length(term)::INT AS letters, count(*) AS terms, sum(count)::BIGINT AS uses, max(count) AS most FROM m GROUP BY 1")
def q_term_misses(spark, sf_dir):
    """Words of documents that the benchmark's vocabulary lacks, by length; counted before they are looked up."""
    found, known = _misses(spark, sf_dir)
    missed = found.join(known, "term", "left_anti")
    return missed.groupBy(F.length("term").alias("letters")).agg(F.count("*").alias("terms"), F.sum("count").alias("uses"), F.max("count").alias("most"))


@query(f"WITH {MISS_SQL}, p AS (SELECT term, count FROM m ORDER BY count DESC, term LIMIT 500) SELECT term, count, ((row_number() OVER (ORDER BY count DESC, term) - 1) // 250)::INT AS batch FROM p")
def q_pending_terms(spark, sf_dir):
    """The 500 most frequent misses, in batches of 250 to be sent out."""
    found, known = _misses(spark, sf_dir)
    return terms.batches(terms.pending(found, known, 500), 250, [F.desc("count"), F.col("term")])


@query(r"""WITH w AS (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS term FROM documents), c AS (SELECT term, count(*) AS n FROM w GROUP BY term HAVING count(*) >= 2),
k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS term FROM benchmark)
SELECT term, 'known' AS src FROM k UNION ALL SELECT term, 'learnt' FROM c WHERE length(term) > 3 AND term NOT IN (SELECT term FROM k)""")
def q_dictionary_growth(spark, sf_dir):
    """Insert-only growth: words seen twice or more, with a translation that is not the word itself."""
    from docgrain.sources.sinks import grow_dictionary

    found, known = _misses(spark, sf_dir)
    pairs = found.where("count >= 2").select("term", F.when(F.length("term") > 3, F.upper("term")).otherwise(F.col("term")).alias("translation"), F.lit("learnt").alias("src"))
    grown = grow_dictionary(known.select("term", "translation", F.lit("known").alias("src")), pairs, text.CJK)
    return grown.select("term", "src")


DICTIONARY = [("東京", "Tokyo"), ("免震", "isolated"), ("階", "floor")]


@query(r"""SELECT p_partkey, 'tháng ' || (p_size % 12 + 1) || '/' || (2000 + p_size % 30) || ' hoàn công ' || (p_size % 60 + 1) || ' tầng nổi, ' || (p_size % 4 + 1) || ' tầng hầm' AS phrase, 0 AS residual FROM part""")
def q_phrase_rewrite(spark, sf_dir):
    """Notices in source script, written from the numbers of each part, rewritten by the ordered rules."""
    n = lambda expr: expr.cast("string")
    size = F.col("p_size")
    source = F.concat(n(2000 + size % 30), F.lit("年"), n(size % 12 + 1), F.lit("月竣工"), F.lit("地上"), n(size % 60 + 1), F.lit("階地下"), n(size % 4 + 1), F.lit("階建"))
    rows = spread(Tables(spark, sf_dir).part.select("p_partkey", "p_size")).select("p_partkey", source.alias("source")).withColumn("phrase", domain.rewrite_phrase(F.col("source"), DICTIONARY))
    return rows.select("p_partkey", "phrase", F.size(domain.residual_terms(F.col("phrase"), F.col("source"))).alias("residual"))


@query("""SELECT p_partkey, 0 AS kv_idx, 'Brand' AS label, p_brand AS value FROM part UNION ALL SELECT p_partkey, 1, 'Size', p_size::VARCHAR FROM part
UNION ALL SELECT p_partkey, 2, 'Type', p_type FROM part UNION ALL SELECT p_partkey, 3, 'Name', p_name FROM part UNION ALL SELECT p_partkey, 4, 'Key', 'k' || p_partkey FROM part""")
def q_cells(spark, sf_dir):
    """Label/value cells of a page with a table, a definition list and a line, written from each part."""
    html = F.concat(
        F.lit("<html><script>x: 1</script><table><tr><th>Brand</th><td>"), "p_brand", F.lit("</td><th>Size</th><td>"), F.col("p_size").cast("string"), F.lit("</td></tr><tr><td>Type</td><td><b>"), "p_type",
        F.lit("</b></td><td>odd</td></tr></table><dl><dt>Name</dt><dd>"), "p_name", F.lit("</dd><dt>unpaired</dt></dl><p>Key： k"), F.col("p_partkey").cast("string"), F.lit("</p></html>"),
    )
    pages = Tables(spark, sf_dir).part.select("p_partkey", html.alias("html"))
    return cells.html_cells(pages, ["p_partkey"])


@query("""WITH r AS (SELECT p_partkey, p_size, p_brand, p_type, p_name, p_partkey % 4 AS form FROM part)
SELECT p_partkey, 'Brand' AS label, p_brand AS value, false AS failed FROM r WHERE form < 3 UNION ALL SELECT p_partkey, 'Name', p_name, false FROM r WHERE form < 3 UNION ALL SELECT p_partkey, 'Key', 'k' || p_partkey, false FROM r WHERE form < 3
UNION ALL SELECT p_partkey, 'Sizes', 'Size ' || p_size || ' Type ' || p_type, false FROM r WHERE form = 1 UNION ALL SELECT p_partkey, 'Size', p_size::VARCHAR, false FROM r WHERE form < 3 UNION ALL SELECT p_partkey, 'Type', p_type, false FROM r WHERE form < 3
UNION ALL SELECT p_partkey, '', '', true FROM r WHERE form = 3""")
def q_nested_cells(spark, sf_dir):
    """Pages with a table inside a cell, pages with one table after another, and pages that can't be parsed."""
    form, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    row = lambda label, value: F.concat(F.lit(f"<tr><th>{label}</th><td>"), value, F.lit("</td></tr>"))
    table = lambda *rows: F.concat(F.lit("<table class='x'>"), *rows, F.lit("</table>"))
    inner = table(row("Size", size), row("Type", F.concat(F.lit("<b>"), "p_type", F.lit("</b>"))))
    after = F.concat(F.lit("<dl><dt>Name</dt><dd>"), "p_name", F.lit("</dd></dl><script>no: 1</script><p>Key： k"), F.col("p_partkey").cast("string"), F.lit("</p>"))
    html = F.when(form == 1, F.concat(table(row("Brand", F.col("p_brand")), row("Sizes", inner)), after)).when(form == 3, F.concat(table(row("Sizes", inner)), F.lit("<![odd[ x ]]>"))).otherwise(F.concat(table(row("Brand", F.col("p_brand"))), inner, after))
    pages = Tables(spark, sf_dir).part.select("p_partkey", html.alias("html"))
    return cells.page_cells(pages, ["p_partkey"]).select("p_partkey", "label", "value", F.col("error").isNotNull().alias("failed"))


@query("""WITH w AS (SELECT string_split(text, ' ') AS ws FROM benchmark), t AS (SELECT DISTINCT unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS term FROM w UNION SELECT o_orderkey::VARCHAR FROM orders),
m AS (SELECT doc_id, term FROM documents JOIN t ON contains(text, term) WHERE term <> '')
SELECT doc_id, count(*) AS n_terms, first(term ORDER BY length(term) DESC, term) AS longest FROM m GROUP BY doc_id""")
def q_dictionary_index(spark, sf_dir):
    """A dictionary that is a table, of the benchmark's pairs of words and all order numbers, in all documents: how many terms
    each one has, and the longest."""
    t = Tables(spark, sf_dir)
    words = F.split("text", " ")
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1))))
    known = t.benchmark.select(F.explode(pairs).alias("term")).unionByName(t.orders.select(F.col("o_orderkey").cast("string").alias("term")))
    found = dictionary.occurring(spread(t.documents.select("doc_id", "text")), "text", known, "term", kept=["doc_id"], once=True).groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.min(F.struct((-F.length("term")).alias("n"), "term")).alias("l"))
    return found.select("doc_id", "n_terms", F.col("l.term").alias("longest"))


@query("""SELECT c_custkey, a.n_name || ' の ' || b.n_name AS said FROM customer JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b ON b.n_nationkey = c_custkey % 25""")
def q_rewrite_by_table(spark, sf_dir):
    """Phrases in source script rewritten by a table of terms, some of which begin others: the longest is taken."""
    t = Tables(spark, sf_dir)
    coded = lambda c: F.concat(F.lit("国"), F.translate(c.cast("string"), "0123456789", "春夏秋冬山川森海空星"))
    known = t.nation.select(coded(F.col("n_nationkey")).alias("term"), F.col("n_name").alias("translation"))
    rows = t.customer.select("c_custkey", F.concat(coded(F.col("c_nationkey")), F.lit("の"), coded(F.col("c_custkey") % 25)).alias("phrase"))
    return dictionary.rewrite_phrases(rows, "phrase", "said", known).select("c_custkey", "said")


@query(f"WITH {URL_SQL} SELECT DISTINCT curl AS url, lower(regexp_extract(curl, '^https?://([^/?#]+)', 1)) AS host FROM c")
def q_stream_dedup(spark, sf_dir):
    """The pages as a file stream: one row a canonical URL."""
    pages = Tables(spark, sf_dir).pages
    name = f"pages_{uuid.uuid4().hex}"
    source = f"{shared_dir(spark)}/docgrain/stream-{name}"
    # a file source reads folders; the table may be a single file
    pages.write.parquet(f"{source}/in")
    stream = ingest.one_per_url(ingest.page_stream(spark, f"{source}/in", pages.schema).select("page_id", "url"))
    run = stream.writeStream.format("parquet").option("path", f"{source}/out").option("checkpointLocation", f"{source}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{source}/out").select("url", text.host("url").alias("host"))
