"""Expressions of the building domain: floors, years, layouts, companies, status, source-script rewriting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgrain.functions.numbers import area_m2, int_of
from docgrain.functions.text import CJK, clean, clean_literal, let, strip


def _int(s: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(s, pattern, group).try_cast("int")


# The patterns in the expressions of this file are fixed values: of storeys, years and layouts, of companies and districts, of
# heights and ceilings, of counters, of the words of addresses and of the marks of a state.


def floors(c: Column | str) -> Column:
    """struct(above, below); without an above-ground word the first "N floors built" counts, a basement's too."""
    return let(clean(c), _floors)


def _floors(s: Column) -> Column:
    return F.struct(F.coalesce(_int(s, r"地上\s*(\d+)\s*階"), _int(s, r"(\d+)\s*階建")).alias("above"), _int(s, r"地下\s*(\d+)\s*階").alias("below"))


def year(c: Column | str) -> Column:
    return _int(clean(c), r"((?:19|20)\d{2})")


def period(c: Column | str) -> Column:
    """YYYY-MM; a year alone is its January."""
    return let(clean(c), _period)


def _period(s: Column) -> Column:
    month = _int(s, r"((?:19|20)\d{2})\s*[年/\-.]\s*(\d{1,2})", 2)
    dated = F.concat(F.regexp_extract(s, r"((?:19|20)\d{2})\s*[年/\-.]\s*(\d{1,2})", 1), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return F.coalesce(dated, F.concat(_int(s, r"((?:19|20)\d{2})").cast("string"), F.lit("-01")))


def layout(c: Column | str) -> Column:
    """struct(bedrooms, layout_class, has_multipurpose_room) of a room-layout code such as 2LDK+S."""
    return let(F.replace(F.upper(clean(c)), F.lit("ＬＤＫ"), F.lit("LDK")), _layout)


def _layout(s: Column) -> Column:
    pattern = r"(\d+)\s*(LDK|DK|K|R)\s*(\+?\s*S|\+?\s*N|\+?\s*WIC|\+?\s*SIC)?"
    n, kind, extra = _int(s, pattern), F.regexp_extract(s, pattern, 2), F.trim(F.regexp_extract(s, pattern, 3))
    plus = (extra != "") | F.contains(F.replace(s, F.lit(" "), F.lit("")), F.lit("+S")) | F.contains(s, F.lit(clean_literal("サービスルーム")))
    studio = kind.isin("R", "K") & (n == 1)
    base = F.when(n == 1, "1pn").when(n == 2, "2pn").when(n == 3, "3pn").otherwise("4pn_plus")
    named = F.when(studio, "studio").when(plus & n.isin(1, 2), F.concat(base, F.lit("_plus"))).otherwise(base)
    return F.struct(
        F.when(studio, 0).otherwise(n).alias("bedrooms"), F.when(n.isNotNull(), named).alias("layout_class"), F.when(n.isNotNull() & plus, True).alias("has_multipurpose_room")
    )


#: Words of area labels and the basis that each means, in order of precedence.
AREA_BASIS_LABELS = {
    "壁芯": "tim_tuong", "壁心": "tim_tuong", "建築面積": "tim_tuong", "공급면적": "tim_tuong", "建筑面积": "tim_tuong", "供給面積": "tim_tuong",
    "専有面積": "thong_thuy", "内法": "thong_thuy", "전용면적": "thong_thuy", "套内面积": "thong_thuy",
}


def area_basis(c: Column | str, label: Column | None = None) -> Column:
    known = let(clean(c), lambda s: F.coalesce(*[F.when(F.contains(s, F.lit(w)), F.lit(b)) for w, b in AREA_BASIS_LABELS.items()]))
    return F.coalesce(known, F.when(F.contains(label, F.lit("専有")), F.lit("thong_thuy")) if label is not None else F.lit(None), F.lit("khong_ro"))


def district(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(clean(c), r"([^\s都道府県]{1,8}[区市郡])", 1), F.lit(""))


COMPANY = r"[^\s、,/／()（）]{2,20}?(?:株式会社|有限会社|ホ-ルディングス)"


def companies(c: Column | str, limit: int = 3) -> Column:
    """Names of companies in order, without roles and brackets, joined by "; "."""
    s = F.regexp_replace(clean(c), r"(売主|販売提携|代理|事業主|分譲会社|販売会社)[・/／:：]*", "")
    s = F.regexp_replace(s, r"[(（][^)）]*[)）]", " ")
    names = F.transform(F.regexp_extract_all(s, F.lit(COMPANY), F.lit(0)), lambda x: strip(x, "・/／ "))
    return F.nullif(F.array_join(F.slice(F.array_distinct(F.filter(names, lambda x: x != "")), 1, limit), "; "), F.lit(""))


def status(handover_year: Column, words: Column, as_of_year: Column) -> Column:
    building = clean(words).rlike("予定|工事中|建築中")
    return F.when(building, "dang_xay").when(handover_year <= as_of_year, "da_ban_giao")


def type_code(c: Column | str, known_labels: tuple[str, ...] = ()) -> Column:
    s = strip(F.replace(F.replace(clean(c), F.lit("Type"), F.lit("")), F.lit("タイプ"), F.lit("")), " ：:")
    s = F.replace(s, F.lit("タイプ"), F.lit(""))
    known = [clean_literal(x) for x in known_labels] or [""]
    return let(F.split(F.trim(s), r"\s+")[0], lambda x: F.when(x.rlike("[A-Za-z0-9]") & (F.length(x) <= 16) & ~x.isin(*known), x))


def title_code(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(clean(c), r"([A-Z]{1,3}[-‐]?\d{1,3}[A-Z]?)\s*タイプ", 1), F.lit(""))


def height_m(c: Column | str) -> Column:
    v = F.regexp_extract(clean(c), r"高さ[^\d]{0,8}([\d.]+)\s*m", 1).try_cast("double")
    return F.when(v.between(3, 700), v)


def ceiling_m(c: Column | str) -> Column:
    s = clean(c)
    pattern = r"天井高[^\d]{0,8}([\d,.]+)\s*(mm|m)"
    v = F.replace(F.regexp_extract(s, pattern, 1), F.lit(","), F.lit("")).try_cast("double")
    v = F.when(F.regexp_extract(s, pattern, 2) == "mm", v / 1000).otherwise(v)
    return F.when(v.between(2.0, 6.0), v)


def parking_ratio(slots: Column | str, units: Column) -> Column:
    n = _int(clean(slots), r"(\d+)\s*台")
    return F.round(F.try_divide(n, F.nullif(units, F.lit(0))), 3)


def terms_present(text: Column, terms: tuple[str, ...]) -> Column:
    """The terms that cleaned ``text`` holds, in their order; null if none."""
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(clean_literal(t))), F.lit(t)) for t in terms]))
    return F.when(F.size(found) > 0, found)


def floor_mention(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(地下\s*\d+\s*階|B\d|\d{1,2}\s*階|屋上|ル-フ)", 1), F.lit(""))


def is_address(c: Column) -> Column:
    return c.rlike("(都|道|府|県|区|市|町|村)") & (F.length(c) >= 6)


def is_count(c: Column, lo: int = 1, hi: int = 20_000) -> Column:
    return F.coalesce(int_of(c).between(lo, hi), F.lit(False))


def is_area(c: Column, lo: float = 1.0, hi: float = 2_000_000.0) -> Column:
    return F.coalesce(area_m2(c).between(lo, hi), F.lit(False))


def is_company(c: Column) -> Column:
    return F.length(c).between(2, 80) & ~c.rlike(r"^\d+$")


def has_company(c: Column) -> Column:
    return clean(c).rlike(COMPANY)


KANJI = "一二三四五六七八九"
COUNTERS = "(?=丁目|番|階|戸|号)"


def kanji_numbers(c: Column) -> Column:
    """Kanji numerals before counters as digits: digits before a ten count tens, those after the last ten units.

    The text is cut around its numerals once; texts without any are left as they are.
    """
    numeral, counter = f"[{KANJI}十]", COUNTERS.removeprefix("(?=").removesuffix(")")
    digits = lambda x: F.aggregate(F.split(x, ""), F.lit(0), lambda n, d: n + F.greatest(F.lit(0), F.instr(F.lit(KANJI), d)) * (d != "").cast("int"))

    def number(x: Column) -> Column:
        tens = F.greatest(F.lit(1), digits(F.substring_index(x, "十", 1)))
        return F.when(F.contains(x, F.lit("十")), tens * 10 + digits(F.substring_index(x, "十", -1))).otherwise(digits(x)).cast("string")

    def joined(parts: Column) -> Column:
        counted = lambda i: F.coalesce(F.get(parts, i + 1).rlike(f"^(?:{counter})"), F.lit(False))
        return F.array_join(F.transform(parts, lambda x, i: F.when(x.rlike(f"^{numeral}+$") & counted(i), number(x)).otherwise(x)), "")

    cut = f"(?<={numeral})(?=(?:{counter}))|(?<!{numeral})(?={numeral}+(?:{counter}))"
    return F.when(c.rlike(f"{numeral}(?:{counter})"), let(F.split(c, cut), joined)).otherwise(c)


#: Rewriting rules in order; $1 and $2 are groups.
RULES = [
    (r"[(（](?:地番|地名地番|住居表示)[)）]", ""),
    (r"地下\s*(\d+)\s*階付\s*(\d+)\s*階建", "$2 tầng nổi, $1 tầng hầm"),
    (r"地上\s*(\d+)\s*階\s*地下\s*(\d+)\s*階建?", "$1 tầng nổi, $2 tầng hầm"),
    (r"地下\s*(\d+)\s*階建?", "$1 tầng hầm"),
    (r"地上\s*(\d+)\s*階建?", "$1 tầng nổi"),
    (r"(\d+)\s*階建", "$1 tầng"),
    (r"(\d+)\s*階", "tầng $1"),
    ("屋上", "mái"),
    (r"(\d+)\s*戸", "$1 căn"),
    (r"(\d+)\s*台", "$1 chỗ"),
    (r"徒歩\s*(\d+)\s*分", "đi bộ $1 phút"),
    (r"((?:19|20)\d{2})\s*年\s*(\d{1,2})\s*月", "tháng $2/$1"),
    (r"((?:19|20)\d{2})\s*年", "năm $1"),
    (r"(\d+)\s*丁目", "$1-chome"),
    (r"(\d+)\s*番\s*(\d+)", "$1-$2"),
    (r"(\d+)\s*番地?", "số $1"),
    (r"他\s*$", " và lân cận"),
    ("上旬", " đầu tháng"),
    ("中旬", " giữa tháng"),
    ("下旬", " cuối tháng"),
    (r"約(?=\s*\d)", "khoảng "),
    ("株式会社|有限会社|合同会社", ""),
    ("一級建築士事務所", "văn phòng kiến trúc sư"),
    ("東京都", "Tokyo "),
    ("予定", " (dự kiến)"),
    ("竣工", "hoàn công"),
    ("入居", "nhận nhà"),
    ("引き?渡し", "bàn giao"),
    ("販売", "mở bán"),
    ("完成", "hoàn thành"),
]


def spaced(c: Column) -> Column:
    c = F.regexp_replace(c, rf"(?<=[A-Za-zÀ-ỹ0-9])(?=[{CJK}])", " ")
    c = F.regexp_replace(c, rf"(?<=[{CJK}])(?=[A-Za-zÀ-ỹ0-9])", " ")
    return F.regexp_replace(F.regexp_replace(c, r"\s{2,}", " "), r"\s+([,.);])", "$1")


def apply_rules(c: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """Each rule in order, set off by blanks; blanks are then made single."""
    padded = reduce(lambda s, r: F.regexp_replace(s, r[0], f" {r[1]} " if r[1] else " "), RULES if rules is None else rules, kanji_numbers(c))
    return strip(spaced(padded), " ・,")


def repair_long_vowels(c: Column) -> Column:
    return F.regexp_replace(c, "(?<=[ァ-ヿ])-(?=[ァ-ヿ])", "ー")


def rewrite_phrase(c: Column, dictionary: list[tuple[str, str]], rules: list[tuple[str, str]] | None = None) -> Column:
    """Exact translation, else rules, else exact again, else known terms longest first (ties by the term)."""
    terms = sorted(dictionary, key=lambda t: (-len(t[0]), t[0]))
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in terms]) if terms else F.array().cast("array<struct<k:string,v:string>>")
    exact = lambda x: F.get(F.transform(F.filter(table, lambda t: t["k"] == x), lambda t: t["v"]), F.lit(0))
    replaced = lambda x: strip(spaced(F.aggregate(table, x, lambda a, t: F.replace(a, t["k"], t["v"]))), " ・,")

    def done(s: Column) -> Column:
        return let(apply_rules(s, rules), lambda ruled: F.coalesce(exact(s), exact(ruled), F.nullif(replaced(ruled), F.lit("")), s))

    return let(F.trim(repair_long_vowels(F.coalesce(c, F.lit("")))), lambda s: F.when(s.rlike(f"[{CJK}]"), done(s)).otherwise(s))


def residual_terms(rewritten: Column, source: Column, max_phrase: int = 40, max_sentence: int = 160, max_term: int = 30) -> Column:
    """What is still in source script: runs of a short text, the whole of a longer one, nothing of the longest."""
    run = f"[{CJK}]+(?:-[{CJK}]+)*"
    parts = F.filter(F.regexp_extract_all(rewritten, F.lit(run), F.lit(0)), lambda x: (F.length(x) <= max_term) & ~x.rlike("^[・、。〜~ー\\-–—…]+$"))
    n = F.length(source)
    whole = F.when(rewritten.rlike(f"[{CJK}]"), F.array(rewritten)).otherwise(F.array().cast("array<string>"))
    return F.when(n <= max_phrase, parts).when(n <= max_sentence, whole).otherwise(F.array().cast("array<string>"))
