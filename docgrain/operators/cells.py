"""Label/value cells of pages, label and dictionary matching, block segmentation and look-ahead windows."""

from __future__ import annotations

import re
from functools import reduce
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgrain import schemas
from docgrain.functions.text import clean, clean_literal, sentence_around, visible_lines

MAX_LABEL = 30
#: Labels that are never values, and values that say nothing.
KNOWN_LABELS = (
    "所在地", "住所", "交通", "交通機関", "最寄駅", "総戸数", "間取り", "専有面積", "販売価格", "価格", "築年月", "構造", "階建", "敷地面積", "建築面積", "売主",
    "施工会社", "設計", "竣工", "完成時期", "管理費", "修繕積立金", "タイプ", "マンション名", "偏差値", "推定相場", "バルコニー面積", "バルコニ-面積",
)
EMPTY_VALUES = ("-", "--", "×", "未定")


def _plain(x: Column) -> Column:
    return clean(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " "))


def html_cells(pages: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """key, kv_idx, label, value: cells of table rows two by two, of definition lists, and of "label: value" lines.

    Works on what regular expressions can see: rows inside nested tables count once, as innermost rows. Equal pairs of a
    page count once, the first.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>((?:(?!<tr[\s>]).)*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), _plain))
    # sequence counts down when it has nothing to count up, so rows of one cell are kept out
    paired = F.transform(
        F.filter(cells, lambda c: F.size(c) >= 2),
        lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 2, F.lit(2)), lambda i: F.struct(F.get(c, i).alias("label"), F.get(c, i + 1).alias("value"))),
    )
    terms, facts = (F.transform(F.regexp_extract_all(F.col(html), F.lit(f"(?is)<{t}[^>]*>(.*?)</{t}>"), F.lit(1)), _plain) for t in ("dt", "dd"))
    listed = F.transform(F.arrays_zip(terms.alias("label"), facts.alias("value")), lambda z: F.struct(z["label"].alias("label"), z["value"].alias("value")))
    colon = rf"^([^:：]{{1,{MAX_LABEL}}})[:：]\s*(.+)$"
    lines = F.transform(F.filter(visible_lines(html), lambda x: x.rlike(colon) & ~x.rlike("^https?:")), lambda x: F.struct(clean(F.regexp_extract(x, colon, 1)).alias("label"), clean(F.regexp_extract(x, colon, 2)).alias("value")))
    every = F.filter(F.concat(F.flatten(paired), listed, lines), lambda z: z["label"].isNotNull() & z["value"].isNotNull() & (z["label"] != "") & (z["value"] != "") & (F.length(z["label"]) <= MAX_LABEL))
    return pages.select(*key, F.posexplode(F.array_distinct(every)).alias("kv_idx", "kv")).select(*key, "kv_idx", "kv.label", "kv.value")


class _Cells(HTMLParser):
    """Rows of tables in the order in which they begin; a row's cells are its own, with the text of tables inside them. Terms
    and facts of lists, and the lines of text between tags."""

    UNSEEN = ("script", "style", "noscript", "template")

    def __init__(self):
        super().__init__()
        self.rows, self.open, self.unseen = [], [], 0
        self.listed, self.into, self.lines = {"dt": [], "dd": []}, None, []

    def handle_starttag(self, tag, attrs):
        if tag in self.UNSEEN:
            self.unseen += 1
        elif tag == "tr":
            self.rows.append([])
            self.open.append([self.rows[-1], False])
        elif tag in ("td", "th") and self.open:
            self.open[-1][0].append([])
            self.open[-1][1] = True
        elif tag in self.listed:
            self.into = []
            self.listed[tag].append(self.into)

    def handle_endtag(self, tag):
        if tag in self.UNSEEN:
            self.unseen = max(0, self.unseen - 1)
        elif tag == "tr" and self.open:
            self.open.pop()
        elif tag in ("td", "th") and self.open:
            self.open[-1][1] = False
        elif tag in self.listed:
            self.into = None

    def handle_data(self, data):
        if self.unseen or not data.strip():
            return
        self.lines += data.split("\n")
        for row, inside in self.open:
            if inside:
                row[-1].append(data.strip())
        if self.into is not None:
            self.into.append(data.strip())

    def pairs(self):
        for row in self.rows:
            yield from zip(row[::2], row[1::2])
        yield from zip(self.listed["dt"], self.listed["dd"])
        for line in self.lines:
            said = re.match(rf"([^:：]{{1,{MAX_LABEL}}})[:：]\s*(.+)$", line.strip())
            if said and not re.match("https?:", line.strip()):
                yield [said[1]], [said[2]]


@F.udtf(returnType="kv_idx int, label string, value string, error string")
class NestedCells:
    """For pages with nested tables: a lateral table function over the HTML of one page; errors are rows, not failures."""

    def eval(self, html: str):
        parser = _Cells()
        try:
            parser.feed(html or "")
            parser.close()
        except Exception as e:  # a broken page must not end the job
            yield -1, "", "", f"{type(e).__name__}: {e}"[:300]
            return
        for n, (label, value) in enumerate(dict.fromkeys((" ".join(a), " ".join(b)) for a, b in parser.pairs())):
            yield n, label, value, None


def has_nested_table(html: str) -> Column:
    """Whether a table opens before the one before it is closed."""
    parts = F.split(F.lower(F.coalesce(html, F.lit(""))), r"<table[\s>]")
    inner = F.when(F.size(parts) > 2, F.slice(parts, F.lit(2), F.size(parts) - 2)).otherwise(F.array().cast("array<string>"))
    return F.exists(inner, lambda p: ~F.contains(p, F.lit("</table")))


def page_cells(pages: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """key, kv_idx, label, value, error: the cells of all pages, those with nested tables by ``NestedCells``.

    Pages without nested tables, nearly all, stay native. Where tables are nested an outer row's cell has the text of what is
    inside, and inner rows follow it. A page that can't be parsed has one row, with an error.
    """
    flat = html_cells(pages.where(~has_nested_table(html)), key, html).select(*key, "kv_idx", "label", "value", F.lit(None).cast("string").alias("error"))
    nested = pages.where(has_nested_table(html)).select(*key, F.col(html).alias("html"))
    rows = nested.lateralJoin(NestedCells(F.col("html").outer())).select(*key, "kv_idx", clean("label").alias("label"), clean("value").alias("value"), "error")
    return flat.unionByName(rows.where(F.col("error").isNotNull() | ((F.col("label") != "") & (F.col("value") != "") & (F.length("label") <= MAX_LABEL))))


def trust(purpose: Column) -> Column:
    """0 for official pages, else 1: the order in which pages are believed."""
    return F.when(purpose.isin(schemas.OFFICIAL), 0).otherwise(1)


def confidence(purpose: Column) -> Column:
    return F.when(purpose.isin(schemas.OFFICIAL), "high").when(purpose.isin(schemas.DOUBTFUL), "low").otherwise("medium")


def label_matches(cells: DataFrame, labels: list[tuple[str, str, int]]) -> DataFrame:
    """Cells with each (field, label, label_rank) that their label contains; placeholders and labels as values go.

    The labels are a list written by hand. As a literal array they are matched where the cells are, and validators that
    follow see matches only; in a join they would move into its condition and run for every pair.
    """
    bad = [clean_literal(x) for x in (*KNOWN_LABELS, *EMPTY_VALUES)]
    values = cells.withColumn("value", clean("value")).where((F.col("value") != "") & ~F.col("value").isin(bad))
    known = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(clean_literal(p)).alias("pattern"), F.lit(r).alias("label_rank")) for f, p, r in labels])
    found = values.select("*", F.explode(F.filter(known, lambda k: F.contains(F.col("label"), k["pattern"]))).alias("_k"))
    return found.select("*", "_k.field", "_k.pattern", "_k.label_rank").drop("_k")


def best_cell(matches: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first match of each (key, field) in ``order``: label rank, trust, page, cell."""
    best = Window.partitionBy(key, "field").orderBy(*order)
    return matches.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def first_scan(pages: DataFrame, key: str, text: str, pattern: str, order: list[str]) -> DataFrame:
    """The first page of each key, in order of trust, whose text matches."""
    return pages.where(F.col(text).rlike(pattern)).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def dictionary_matches(texts: DataFrame, key: list[str], text: str, terms: list[tuple], columns: list[str], hints: tuple = (), limit: int = 140) -> DataFrame:
    """One row a (text, term) that the text contains, with the term's columns and the sentence around it.

    ``terms`` are tuples of ``columns``, the first of which is the term. The dictionary is a literal array, so texts are
    scanned where they are read; only matches are exploded.
    """
    item = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, t)], F.lit(clean_literal(t[0])).alias("_term"), F.lit(i).alias("dict_idx")) for i, t in enumerate(terms)])
    cleaned = texts.withColumn("_flat", clean(text))
    found = cleaned.select(*[F.col(k) for k in key], "_flat", F.explode(F.filter(item, lambda t: F.contains(F.col("_flat"), t["_term"]))).alias("t"))
    near = sentence_around(F.col("_flat"), F.col("t._term"), limit)
    out = found.withColumn("sentence", near)
    included = ~F.exists(F.array(*[F.lit(clean_literal(h)) for h in hints]), lambda h: F.contains(F.col("sentence"), h)) if hints else F.lit(True)
    return out.select(*key, *[F.col(f"t.{c}").alias(c) for c in columns], F.col("t.dict_idx").alias("dict_idx"), "sentence", included.alias("is_included"))


def first_per_code(matches: DataFrame, key: str, code: str, order: list[str]) -> DataFrame:
    best = Window.partitionBy(key, code).orderBy(*order)
    return matches.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def segment(rows: DataFrame, key: list[str], order: str, opens: Column) -> DataFrame:
    """``block`` of each row: how many rows up to it open one; rows before the first are block 0."""
    window = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", F.sum(opens.cast("int")).over(window))


def look_ahead(lines: DataFrame, key: list[str], order: str, line: str, span: int = 8) -> DataFrame:
    """``window``: the non-empty ones of the next ``span`` lines."""
    ahead = Window.partitionBy(*key).orderBy(order).rowsBetween(1, span)
    return lines.withColumn("window", F.filter(F.collect_list(line).over(ahead), lambda x: x != ""))


def after_colon_or_next(window: Column, word: str) -> Column:
    """The value of the last line with ``word``: what follows its colon, else the next line of the window."""
    word = clean_literal(word)
    tail = lambda x: F.trim(F.element_at(F.split(x, "[:：]"), -1))
    at = F.array_max(F.transform(window, lambda x, i: F.when(F.contains(x, F.lit(word)), i)))
    return F.coalesce(F.nullif(tail(F.get(window, at)), F.lit("")), F.get(window, at + 1))


def budgeted(rows: DataFrame, key: str, order: str, text: str, per_text: int, total: int) -> DataFrame:
    """Texts cut to ``per_text`` characters, as many of a key, in order, as fit ``total``."""
    cut = rows.withColumn(text, F.left(text, F.lit(per_text)))
    so_far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.withColumn("used", F.sum(F.length(text)).over(so_far)).where(F.col("used") <= total)


def image_candidates(images: DataFrame, words: tuple[str, ...], relevant: list[str], most: int = 12) -> DataFrame:
    """Floor-plan images: a word in source, caption or class, or large on a relevant page; never small or inline ones."""
    said = F.lower(F.concat_ws(" ", "src", "alt", "class"))
    hit = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(said, w))
    large = (F.col("width") >= 800) & (F.col("height") >= 600) & F.col("purpose").isin(relevant)
    good = images.where((hit | large) & (F.col("width") >= 400) & (F.col("height") >= 300) & ~F.col("src").startswith("data:"))
    return good.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("img_idx"))).where(F.col("_n") <= most).drop("_n")


def _joined_back(rows: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """Every row, equal ones too, with what was decided for its keys; null keys meet null keys."""
    renamed = decided.withColumnsRenamed({k: f"_d_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys])
    return rows.join(renamed, on, "left").drop(*[f"_d_{k}" for k in keys])


def host_gate(urls: DataFrame, policy: DataFrame) -> DataFrame:
    """``allowed`` of each URL by its host's rules (host, http_status, rule_ord, prefix, allow): the first prefix that fits.

    A host that answers 401 or 403 denies everything; no rule allows. Denied URLs stay, as rows to log. Decided once for
    each host and path, so equal rows stay as many.
    """
    rules = urls.select("host", "path").distinct().join(policy, "host", "left")
    denied = F.max(F.col("http_status").isin(401, 403))
    first = F.min_by("allow", F.when(F.col("path").startswith(F.col("prefix")) & (F.col("http_status") == 200), F.col("rule_ord")))
    decided = rules.groupBy("host", "path").agg((~F.coalesce(denied, F.lit(False)) & F.coalesce(first, F.lit(True))).alias("allowed"))
    return _joined_back(urls, decided, ["host", "path"])


def host_dispatch(urls: DataFrame, sites: DataFrame) -> DataFrame:
    """The first site (site, pattern, site_ord) whose pattern is the host or ends it after a dot.

    A host is cut to itself and what follows each of its dots, so patterns meet it in a join on equality.
    """
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cut = urls.select("host").distinct().select("host", F.explode(ends).alias("pattern"))
    decided = cut.join(sites, "pattern").groupBy("host").agg(F.min_by("site", "site_ord").alias("site"))
    return _joined_back(urls, decided, ["host"])
