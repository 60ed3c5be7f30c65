"""Text, URL, HTML and JSON expressions: each takes a column and returns a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Full-width characters and what each becomes (long dashes and the long-vowel mark become "-").
FULL_WIDTH = "０１２３４５６７８９．，－―ー～〜％　（）：／"
HALF_WIDTH = "0123456789.,---~~% ():/"
#: What a text that ``strip`` changes begins or ends with (blanks; ``$`` also stands before a last line end).
EDGES = [" ", "\t", "\n", "\x0b", "\f", "\r", "\x85", "\u2028", "\u2029"]
#: Scripts of the sources (kana, Han, Hangul), for character classes.
CJK = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7a3"


def text_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it: keeps plans small where parsers nest."""
    return F.transform(F.array(value), f)[0]


def strip(c: Column, chars: str = r"\s") -> Column:
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def _half_width(c: Column | str) -> Column:
    s = F.translate(F.coalesce(text_column(c).cast("string"), F.lit("")), FULL_WIDTH, HALF_WIDTH)
    return F.replace(F.replace(s, F.lit("\u00a0"), F.lit(" ")), F.lit("\u200b"), F.lit(""))


def _tidy(s: Column) -> Column:
    return strip(F.regexp_replace(s, "[ \\t\u3000]+", " "))


def clean(c: Column | str) -> Column:
    """Half-width digits and signs, plain blanks, no zero-width characters; null becomes empty."""
    return _tidy(_half_width(c))


def with_clean(rows: DataFrame, name: str, text: Column) -> DataFrame:
    """``clean`` of a text as a column: the patterns only run on texts that hold what they change."""
    s = F.col(name)
    loose = F.contains(s, F.lit("\t")) | F.contains(s, F.lit("  ")) | F.left(s, F.lit(1)).isin(EDGES) | F.substr(s, F.lit(-1)).isin(EDGES)
    return rows.withColumn(name, _half_width(text)).withColumn(name, F.when(loose, _tidy(s)).otherwise(s))


def clean_literal(term: str) -> str:
    """``clean`` of a dictionary term, so that text and term are always compared in the same form."""
    return " ".join(term.translate(str.maketrans(FULL_WIDTH, HALF_WIDTH)).split(" ")).strip()


def squash(c: Column | str, limit: int = 300) -> Column:
    return F.left(F.regexp_replace(clean(c), r"\s*\n\s*", " "), F.lit(limit))


def slug(c: Column | str, limit: int = 60, fallback: str = "x") -> Column:
    s = F.left(strip(F.regexp_replace(F.lower(clean(c)), "[^a-z0-9]+", "_"), "_"), F.lit(limit))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback))


def file_slug(c: Column | str, limit: int = 200) -> Column:
    """The variant for file names: case and ``-`` stay."""
    return F.left(strip(F.regexp_replace(clean(c), "[^A-Za-z0-9-]+", "_"), "_"), F.lit(limit))


def name_key(c: Column | str) -> Column:
    return F.rtrim(F.regexp_replace(F.lower(F.trim(text_column(c))), r"\s+", " "), F.lit(" ."))


def canonical_url(c: Column | str) -> Column:
    """Without the fragment and without ``utm_*`` parameters; other parameters stay as they are written."""
    whole = F.regexp_replace(text_column(c), "#.*$", "")
    base, query = F.substring_index(whole, "?", 1), F.regexp_extract(whole, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_")), "&")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(text_column(c), "^https?://([^/?#]+)", 1))


def url_path(c: Column | str) -> Column:
    return F.regexp_extract(text_column(c), "^https?://[^/?#]+([^?#]*)", 1)


def is_pdf(c: Column | str) -> Column:
    return F.lower(url_path(c)).endswith(".pdf")


def page_title(html: Column | str) -> Column:
    return strip(F.regexp_extract(text_column(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def visible_lines(html: Column | str) -> Column:
    """The lines of text that a page shows: scripts and styles go, each node is a line."""
    s = F.regexp_replace(text_column(html), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", "\n")
    s = F.regexp_replace(F.regexp_replace(s, r"(?s)<!--.*?-->", ""), r"<[^>]+>", "\n")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(sign))
    return F.filter(F.transform(F.split(s, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def visible_text(html: Column | str) -> Column:
    return F.array_join(visible_lines(html), "\n")


def tags(html: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text_column(html)), F.lit("<([a-z][a-z0-9]*)"), F.lit(1))


def sentence_around(text: Column, term: Column | str, limit: int = 140) -> Column:
    """The sentence of cleaned ``text`` that holds the first ``term``; empty if there is none."""
    term = F.lit(clean_literal(term)) if isinstance(term, str) else term
    return let(text, lambda t: _sentence(t, term, limit))


def _sentence(text: Column, term: Column, limit: int) -> Column:
    at = F.position(term, text)
    head = F.regexp_extract(F.substr(text, F.lit(1), at - 1), "([^。｡※]*)$", 1)
    tail = F.split(F.substr(text, at + F.length(term)), "[。｡\n]|※|・{2,}", 2)[0]
    return F.when(at > 0, F.left(strip(F.concat(head, term, tail)), F.lit(limit))).otherwise("")


def strip_source_terms(c: Column | str) -> Column:
    """Without brackets that hold source script and no Latin letters; the text itself if nothing else is left."""
    c = text_column(c)
    bare = strip(F.regexp_replace(c, rf"\s*[(（\[](?=[^)）\]]*[{CJK}])[^)）\]A-Za-z]*[)）\]]", ""))
    return F.coalesce(F.nullif(bare, F.lit("")), c)


def tolerant_json(c: Column | str, schema: str) -> Column:
    """An object from free text: the whole text, what stands between fences, or between the outermost braces."""
    c = text_column(c)
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    outer = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    valid = lambda x: F.when(F.json_object_keys(x).isNotNull(), x)
    return F.from_json(F.coalesce(valid(c), valid(fenced), valid(outer)), schema)


def pairs_to_map(pairs: Column) -> Column:
    """Array of (key, value) to a map; pairs without a key go, the last value of a key counts."""

    def of(held: Column) -> Column:
        last = lambda p, i: ~F.exists(F.slice(held, i + 2, F.size(held)), lambda q: q["key"] == p["key"])
        return F.map_from_entries(F.transform(F.filter(held, last), lambda p: F.struct(p["key"], p["value"])))

    return let(F.filter(pairs, lambda p: p["key"].isNotNull()), of)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(text_column(c), F.lit(""))


def true_word(c: Column | str) -> Column:
    """yes/y/1/true to true, no/n/0/false to false, anything else to null."""
    s = F.lower(F.trim(text_column(c)))
    return F.when(s.isin("yes", "y", "1", "true"), True).when(s.isin("no", "n", "0", "false"), False)
