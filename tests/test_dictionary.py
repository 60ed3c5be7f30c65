"""Dictionaries as tables, and cells of nested tables."""

import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docgrain.functions import domain
from docgrain.operators import cells, dictionary


@pytest.mark.parametrize("most_bytes", [dictionary.BROADCAST_BYTES, 0])
def test_occurring(spark, most_bytes):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("ab東京é𝄞 ") for _ in range(n))
    texts = [(i, word(r.randint(0, 40))) for i in range(60)] + [(90, None), (91, ""), (7, "ab")]
    terms = [(word(r.randint(1, 8)), k) for k in range(200)] + [("", 900), (None, 901), ("ab", 902), ("ab", 903)]
    got = dictionary.occurring(spark.createDataFrame(texts, "id int, text string"), "text", spark.createDataFrame(terms, "term string, k int"), "term", most_bytes)
    assert sorted((x.id, x.k) for x in got.collect()) == sorted((i, k) for i, t in texts for w, k in terms if t and w and w in t)


@pytest.mark.parametrize("most_bytes", [dictionary.BROADCAST_BYTES, 0])
def test_occurring_long(spark, most_bytes):
    """Terms longer than a key that agree in it, terms of equal bytes in one text, and a text of several slices whose terms lie
    across their ends."""
    stem = "x" * (dictionary.KEY - 1) + "é"
    terms = [stem + "a", stem + "b", stem, "end of slice", "zzzzzzz", "z", "東京" * 40]
    size = dictionary.SLICE
    long = ("." * (size - 5) + "end of slice" + "-" * size + "z")[: 2 * size + 20]
    texts = [(1, stem + "b"), (2, stem), (3, long), (4, "zzzzzz" + "東京" * 41), (5, "zzzzzzzz" * 3), (6, "end of slic"), (7, "e end of slice")]
    frame = spark.createDataFrame(texts, "id int, text string").coalesce(1)
    got = dictionary.occurring(frame, "text", spark.createDataFrame([(t,) for t in terms], "term string"), "term", most_bytes)
    assert sorted((x.id, x.term) for x in got.collect()) == sorted((i, w) for i, t in texts for w in terms if w in t)


def test_occurring_without_terms(spark):
    terms = spark.createDataFrame([(None,), ("",)], "term string")
    assert dictionary.occurring(spark.createDataFrame([(1, "a")], "id int, text string"), "text", terms, "term").count() == 0


def test_matches_as_by_literals(spark):
    texts = spark.createDataFrame([(1, "床暖房を標準装備。ディスポーザーはオプション。"), (2, "プール完備　ＡＢＣ"), (3, None)], "id int, text string")
    terms = [("床暖房", "a"), ("ディスポーザー", "b"), ("ABC", "c"), ("暖房", "d")]
    table = spark.createDataFrame([(t, c, i) for i, (t, c) in enumerate(terms)], "term string, code string, dict_idx int")
    hints = ("オプション",)
    a = cells.dictionary_matches(texts, ["id"], "text", terms, ["term", "code"], hints)
    b = dictionary.dictionary_matches(texts, ["id"], "text", table, "term", hints)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect())) and b.count() == 3
    found = {x.id: x.terms for x in dictionary.longest_first(b, ["id"], "term").collect()}
    assert found[1] == ["ディスポーザー", "床暖房", "暖房"]


def test_rewriting_as_by_literals(spark):
    terms = [("東京", "Tokyo"), ("東京都", "Tokyo-to"), ("免震", "isolated"), ("免震構造", "on bearings"), ("竣工済", "done")]
    texts = ["東京都免震構造", "東京の免震 2020年3月竣工", "竣工済", "plain", None, "", "シャト-東京", "2026年5月下旬", "東京", "東京"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    by_table = dictionary.rewrite_phrases(rows, "t", "said", spark.createDataFrame([*terms, (None, "x"), ("", "y")], "term string, translation string"))
    expected = rows.select("id", domain.rewrite_phrase(F.col("t"), terms).alias("said"))
    assert sorted(map(tuple, by_table.select("id", "said").collect())) == sorted(map(tuple, expected.collect()))


def test_nested_pages(spark):
    inner = "<table><tr><td>b</td><td>c<b>d</b></td></tr><tr><th>e</th><td>f</td><td>odd</td></tr></table>"
    pages = [(1, f"<table><tr><th>a</th><td>x {inner} y</td></tr></table><dl><dt>g</dt><dd>h</dd></dl><p>i: j</p><script>k: l</script>"), (2, f"{inner}{inner}"), (3, f"<table><tr><td>{inner}<![odd[ x ]]>"), (4, None), (5, f"<table><tr><td>a</td><td>{inner}")]
    got = cells.page_cells(spark.createDataFrame(pages, "id int, html string"), ["id"]).collect()
    of = lambda i: [(r.label, r.value) for r in sorted(got, key=lambda r: r.kv_idx) if r.id == i and r.error is None]
    assert of(1) == [("a", "x b c d e f odd y"), ("b", "c d"), ("e", "f"), ("g", "h"), ("i", "j")]
    assert of(2) == [("b", "c d"), ("e", "f")] and of(4) == [] and of(5)[0] == ("a", "b c d e f odd")
    assert [r.id for r in got if r.error] == [3]


def test_large_dictionary_lets_little_pass():
    """Of two million terms in the sieves hardly a stretch of text passes that is no term, and a batch is cut into pieces."""
    import numpy as np
    import pyarrow as pa

    n = 2_000_000
    keys = np.char.mod("%d", np.arange(10**8, 10**8 + 13 * n, 13))
    head_bits, bits = (min(m, (32 * n).bit_length()) for m in (dictionary.MOST_HEAD_BITS, dictionary.MOST_BITS))
    head, whole = np.zeros(1 << head_bits - 6, np.int64), np.zeros(1 << bits - 6, np.int64)
    for batch in dictionary._sieve_rows(head_bits, bits)([pa.RecordBatch.from_arrays([pa.array(keys.tolist()).cast(pa.binary())], ["_key"])]):
        kind, word, value = (c.to_numpy() for c in batch.columns)
        np.bitwise_or.at(head, word[kind == 0], value[kind == 0])
        np.bitwise_or.at(whole, word[kind == 1], value[kind == 1])
    text = "".join(str(x) for x in np.random.default_rng(1).integers(0, 10, 200_000))
    raw, offsets = dictionary._raw(pa.array([text], pa.large_string()).cast(pa.large_binary()))
    size = dictionary.SLICE + dictionary.KEY
    power, inverse = dictionary._powers(dictionary.BASE, size), dictionary._powers(pow(dictionary.BASE, -1, 1 << 64), size)
    _, found = dictionary._keys_in(raw, offsets, lambda bit: dictionary._held(head, bit), head_bits, whole, [9], power, inverse)
    got, terms = {x.decode() for x in found.to_pylist()}, set(keys.tolist())
    real = {text[i : i + 9] for i in range(len(text) - 8)} & terms
    assert real <= got and len(got - real) < 0.005 * len(text)
    assert list(dictionary._pieces(np.array([0, 5, 5, size, 3 * size, 3 * size + 1]))) == [(0, 2), (2, 3), (3, 4), (4, 5)]


@pytest.mark.parametrize("most_bytes", [dictionary.BROADCAST_BYTES, 1500, 0])
@pytest.mark.parametrize("longest", [dictionary.KEY, dictionary.KEY + 9])
def test_occurring_kept_columns(spark, most_bytes, longest):
    """Texts that are not returned, frequent and rare terms, terms of all lengths, rows that come twice, null and repeated ids."""
    r = random.Random(2)
    texts = [(r.choice([1, 2, 3, None]), "".join(r.choice("abcé東 ") for _ in range(r.randint(0, 250)))) for _ in range(60)]
    cuts = [(t, r.randint(0, 200)) for _, t in texts]
    terms = {t[i : i + n] for (t, i), n in zip(cuts, range(1, longest + 1), strict=False)} | {"a", "é", "東", "ab", "zz", ""}
    terms |= {t[i : i + 61] for t, i in cuts[:20]} | {"x" * longest, "a" * dictionary.KEY}
    rows = [(w, len(w) % 2) for w in terms] + [("a", 1), ("a", 7), ("ab", 0), ("ab", 0), (None, 0)]
    frame, known = spark.createDataFrame(texts, "id int, text string").repartition(3), spark.createDataFrame(rows, "term string, k int")
    order = lambda found: sorted(map(tuple, found), key=str)
    for once in (False, True):
        expected = [(i, w, k) for i, t in texts for w, k in (set(rows) if once else rows) if w and w in t]
        got = dictionary.occurring(frame, "text", known, "term", most_bytes, kept=["id"], once=once)
        assert got.columns == ["id", "term", "k"] and order(got.collect()) == order(expected)
    got = dictionary.occurring(frame, "text", known, "term", most_bytes)
    assert order(got.collect()) == order([(i, t, w, k) for i, t in texts for w, k in rows if w and w in t])


def test_index_by_a_large_dictionary_copies_no_texts(spark, tmp_path):
    """More terms than may be sent to the tasks: little but the dictionary is written, and no copy of the texts."""
    import __spark_entry__

    r = random.Random(3)
    n, letters = 300_000, "abcdefghijklmnopqrstuvwxyz"
    text = lambda i: " ".join("".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(1500)) + f" {i * 1499} red fox"
    texts = [(i, text(i)) for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "red fox ran"), (2, "fox ran"), (3, None), (4, "one")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey")).unionByName(spark.range(9).select(F.col("id").alias("o_orderkey"))).write.parquet(f"{tmp_path}/orders.parquet")
    shared, size = dictionary.stage(spark.range(1), "dictionary-none").inputFiles()[0].removeprefix("file:").split("/docgrain/")[0], lambda at: sum(p.stat().st_size for p in at.rglob("*.parquet"))
    folders = lambda: {p for p in Path(shared, "docgrain").iterdir() if p.name.startswith("dictionary")}
    before = folders()
    found = __spark_entry__.queries()["q_dictionary_index"](spark, str(tmp_path))
    got = {x.doc_id: (x.n_terms, x.longest) for x in found.collect()}
    written = {p.name: size(p) for p in folders() - before}
    assert sum(v for k, v in written.items() if not re.match("dictionary-[0-9a-f]{32}", k)) < 0.1 * size(tmp_path / "documents.parquet"), written
    digits = lambda s: {s[a:b] for a in range(len(s)) for b in range(a + 1, len(s) + 1) if str(int(s[a:b])) == s[a:b] and int(s[a:b]) < n}
    assert got == {i: (len(digits(str(i * 1499))) + 1, "red fox") for i, _ in texts}


def test_many_numbers_let_no_words_pass():
    """Words pass the sieves of two million numbers and some pairs of words only where a pair of that length begins as they do."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(4)
    n, words = 2_000_000, ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 8))) for _ in range(300)]
    keys = [str(x) for x in range(10**7, 10**7 + n)] + sorted({f"{r.choice(words)} {r.choice(words)}" for _ in range(3000)})
    sizes = np.bincount([len(k) for k in keys])
    regions, end = {}, 0
    for size in np.flatnonzero(sizes).tolist():
        regions[size] = end, max(dictionary.LEAST_PLACES, dictionary.PLACES * int(sizes[size]))
        end += regions[size][1]
    kept = [1 << dictionary.MOST_HEAD_BITS - 6, (end >> 6) + 1, 1 << dictionary.PREFIX_BITS]
    held = [np.zeros(k, np.int64) for k in kept]
    parts = dictionary._sieve_parts(kept, dictionary.MOST_HEAD_BITS, regions)(iter([pa.RecordBatch.from_arrays([pa.array(keys).cast(pa.binary())], ["_key"])]))
    for batch in dictionary._sieve_merged(parts):
        for kind, chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got = np.frombuffer(zlib.decompress(packed), np.int64)
            held[kind][chunk * dictionary.CHUNK :][: len(got)] = got
    head, whole, prefixes = held
    text = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 8))) if r.random() < 0.5 else r.choice(words) for _ in range(30_000))
    raw, offsets = dictionary._raw(pa.array([text], pa.large_string()).cast(pa.large_binary()))
    size = dictionary.SLICE + dictionary.KEY
    power, inverse = dictionary._powers(dictionary.BASE, size), dictionary._powers(pow(dictionary.BASE, -1, 1 << 64), size)
    _, found = dictionary._keys_in(raw, offsets, lambda bit: dictionary._held(head, bit), dictionary.MOST_HEAD_BITS, whole, [*regions], power, inverse, regions, prefixes)
    got, real = {x.decode() for x in found.to_pylist()}, {k for k in keys if not k.isdigit() and k in text}
    assert real <= got and len(got - real) < 10
