"""Vectors of the expressions."""

import pytest
from pyspark.sql import functions as F

from docgrain.functions import domain, numbers, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f("v").alias("r")).first().r


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (numbers.area_m2, "70.27㎡", 70.27),
        (numbers.area_m2, "10坪", 33.06),
        (numbers.area_m2, "約５０平方メートル", 50.0),
        (numbers.area_m2, "1,200 sq ft", 111.48),
        (numbers.area_m2, "none", None),
        (numbers.area_range_m2, "70.27㎡ ~ 120.97㎡", (70.27, 120.97)),
        (numbers.money_jpy, "2億3,800万円", 238000000.0),
        (numbers.money_jpy, "6980万円", 69800000.0),
        (numbers.money_jpy, "500円", 500.0),
        (numbers.money_jpy, "未定", None),
        (numbers.money_range_jpy, "6,980万円 ~ 2億3,800万円", (69800000.0, 238000000.0)),
        (domain.floors, "地上27階 地下1階建", (27, 1)),
        (domain.floors, "地下1階建", (1, 1)),
        (domain.floors, "45階建", (45, None)),
        (domain.year, "2026年3月竣工", 2026),
        (domain.year, "令和8年", None),
        (domain.period, "2026年3月", "2026-03"),
        (domain.period, "2026年", "2026-01"),
        (domain.period, "x", None),
        (domain.layout, "3LDK+S", (3, "3pn", True)),
        (domain.layout, "2LDK+S", (2, "2pn_plus", True)),
        (domain.layout, "1K", (0, "studio", None)),
        (domain.layout, "5LDK", (5, "4pn_plus", None)),
        (domain.layout, "none", (None, None, None)),
        (domain.type_code, "F-120K Type", "F-120K"),
        (domain.type_code, "間取り", None),
        (domain.district, "東京都中央区月島1-1", "中央区"),
        (domain.companies, "売主・販売提携(代理)/住友不動産株式会社東京建物株式会社", "住友不動産株式会社; 東京建物株式会社"),
        (lambda c: domain.kanji_numbers(F.col(c)), "南青山二十三丁目十番三戸", "南青山23丁目10番3戸"),
        (lambda c: domain.apply_rules(F.col(c)), "地下1階付42階建", "42 tầng nổi, 1 tầng hầm"),
        (lambda c: domain.apply_rules(F.col(c)), "2026年3月竣工予定", "tháng 3/2026 hoàn công (dự kiến)"),
        (lambda c: domain.repair_long_vowels(F.col(c)), "カウンタ-トップ", "カウンタートップ"),
        (lambda c: numbers.floors_in_range(F.col(c)), "5-20", 16),
        (lambda c: numbers.floors_in_range(F.col(c)), "7", 1),
        (lambda c: numbers.floors_in_range(F.col(c)), "mái", None),
        (text.clean, "１２３　ー x ", "123 - x"),
        (text.clean, None, ""),
        (text.slug, "Grand City Tower — Tokyo", "grand_city_tower_tokyo"),
        (text.slug, "東京", "x"),
        (text.canonical_url, "https://a.b/c?utm_source=x&p=1&UTM_y=2#top", "https://a.b/c?p=1"),
        (text.canonical_url, "https://a.b/c?utm_source=x", "https://a.b/c"),
        (text.host, "https://M.A.b/c", "m.a.b"),
        (text.is_pdf, "https://a.b/c.PDF?x=1", True),
        (text.name_key, "  The  Tower. ", "the tower"),
        (text.strip_source_terms, "bếp từ (IHクッキング)", "bếp từ (IHクッキング)"),
        (text.strip_source_terms, "bếp (台所)", "bếp"),
        (text.true_word, "Yes", True),
        (text.true_word, "maybe", None),
        (lambda c: text.sentence_around(text.clean(c), "床暖房"), "前文。床暖房を標準装備。次", "床暖房を標準装備"),
    ],
)
def test_vectors(spark, f, value, expected):
    got = one(spark, value, f)
    assert (tuple(got) if isinstance(expected, tuple) else got) == expected


def test_html(spark):
    html = "<title> A </title><script>x</script><p>one<b>two</b></p><!-- no -->"
    assert one(spark, html, text.visible_lines) == ["A", "one", "two"]
    assert one(spark, html, text.page_title) == "A"


def test_json_and_pairs(spark):
    assert one(spark, 'so {"k": 3} it is', lambda c: text.tolerant_json(c, "k int")).k == 3
    assert one(spark, "none", lambda c: text.tolerant_json(c, "k int")) is None
    got = spark.sql("SELECT array(struct('a' AS key, 1D AS value), struct('b' AS key, 2D AS value), struct('a' AS key, 3D AS value)) AS p").select(text.pairs_to_map(F.col("p")).alias("m")).first().m
    assert got == {"a": 3.0, "b": 2.0}


def test_phrases(spark):
    rewrite = lambda c: domain.rewrite_phrase(F.col(c), [("免震", "isolated"), ("免震構造", "base isolation")])
    assert one(spark, "免震構造", rewrite) == "base isolation"
    assert one(spark, "免震構造 27階建", rewrite) == "base isolation 27 tầng"
    assert one(spark, "plain", rewrite) == "plain"
    assert one(spark, "南青山 x 赤坂", lambda c: domain.residual_terms(F.col(c), F.col(c))) == ["南青山", "赤坂"]


def test_area_numbers_stand_where_the_lowered_text_has_them(spark):
    assert one(spark, "İİİ 10坪 5", numbers.area_m2) == 33.06  # İ is two characters in lower case
    assert one(spark, "İİİ 10㎡ 5", numbers.area_range_m2) == (10.0, 10.0)


def test_compiled_forms_equal_the_expressions(spark):
    parts = ["約", "１２", "3.5", "1,200", "坪", "帖", "SQM", "sq ft", "sq\tft", "ft2", "平方メートル", "j", " ", "  ", "\t", "\n", "\u3000", "\x85", "\u2028", "\u200b", "İ", "-4"]
    rows = spark.createDataFrame([(a + b + c,) for a in parts for b in parts for c in parts] + [(None,), ("",)], "s string")
    got = numbers.with_area_m2(text.with_clean(rows, "cleaned", F.col("s")), "area", F.col("s"))
    assert got.columns == ["s", "cleaned", "area"]
    differ = got.where(~F.col("cleaned").eqNullSafe(text.clean("s")) | ~F.col("area").eqNullSafe(numbers.area_m2("s")))
    assert differ.count() == 0
    assert got.where("area IS NOT NULL").count() > 3000


def test_unit_convert_parses_without_functions_over_arrays(spark):
    """They run uncompiled; of each area only the rule for texts whose longest unit has no number before it may use them."""
    plan = numbers.with_area_m2(spark.sql("SELECT '10坪' AS s"), "area", F.col("s"))._jdf.queryExecution().analyzed().toString()
    steps = [x for x in plan.splitlines() if "lambda" in x]
    assert len(steps) == 1 and "coalesce(round(" in steps[0]
