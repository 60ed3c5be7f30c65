"""Whitening, conversation repair and SimHash near-duplicates: brute force and odd tables."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from docgrain.llm import repair, simhash, whitening
from docgrain.llm.components import connected_components


# 11 ---------------------------------------------------------------------------------------------------------------------
SPECTRA = [[2.0], [1.0, 1.0], [5.0, 5, 5, 1, 1], np.exp(np.linspace(-9, 9, 48)), [1.0] + [0.0] * 31, np.repeat([3.0, 2, 1, 0], 8), 1 + np.arange(64) / 1000]


@pytest.mark.parametrize("e", SPECTRA, ids=range(len(SPECTRA)))
def test_eigenvectors(e):
    d = len(e)
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    v = (q * np.asarray(e)) @ q.T
    v = (v + v.T) / 2
    values, vectors = whitening.eigenvectors(v)
    top = max(e)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() < 1e-13 * top
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 * top and np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13
    few = whitening.eigenvectors(v, 3)[0]
    assert np.abs(few - values[:3]).max() < 1e-13 * top


def test_polar_factor():
    a = np.random.default_rng(0).normal(size=(30, 30))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    assert np.abs(whitening.polar_factor(a) - (vectors * np.sign(values)) @ vectors.T).max() < 1e-12


def test_exact_products():
    c = np.random.default_rng(1).integers(-(1 << 24), 1 << 24, (700, 3))
    big = c.astype(object)
    assert (whitening.exact_products(c) == big.T @ big).all()
    assert (whitening.exact_products(c << 20) == (big << 20).T @ (big << 20)).all()


def whitened(rows, d):
    x = {tuple(int(np.floor(256 * float(c))) for c in v) for _, v in rows if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)}
    f = np.array(sorted(x), np.float64)
    m = f.mean(0)
    e, u = np.linalg.eigh((f - m).T @ (f - m) / len(f))
    return len(f), m, e[::-1], u[:, ::-1], [sum(int(v) for v in c) for c in zip(*x)]


def test_whitening(spark):
    r = np.random.default_rng(2)
    mix = r.normal(size=(6, 6)) * [3, 2, 1, 1, 0.5, 0.1]
    rows = [(i, [float(np.float32(c)) for c in mix @ r.normal(size=6)]) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [0.0] * 6), (905, [-0.0] * 6), (906, [])]
    rows += [(1000 + i, [float(c) for c in r.normal(size=2)]) for i in range(40)]
    rows = [(i, v, 1, "x") for i, v in rows]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, d int, x string")).collect()
    for d, k in ((6, 4), (2, 2)):
        n, m, e, u, s = whitened([x[:2] for x in rows], d)
        used = [x for x in rows if x[1] and len(x[1]) == d and all(c is not None and np.isfinite(c) for c in x[1])]
        mine = [x for x in got if (x.vec_id is None or x.vec_id < 1000) == (d == 6)]
        assert len(mine) == k * len(used)
        x = {i: np.floor(256 * np.array(v, np.float64)) for i, v, *_ in used}
        sign = {}
        for row in mine:
            c = row.component - 1
            expected = (x[row.vec_id] - m) @ u[:, c] / np.sqrt(e[c])
            sign.setdefault(c, 1 if abs(expected - row.whitened) < 1e-6 else -1)
            assert row.n == n and abs(sign[c] * expected - row.whitened) < 1e-9 and abs(row.explained - e[c] / e.sum()) < 1e-12 and row.identity_error < 1e-9
            assert row.deviation == sum((n * int(a) - b) ** 2 for a, b in zip(x[row.vec_id], s))


def test_whitening_odd(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(frame([])).count() == 0 and whitening.whiten(frame([(1, None), (2, [])])).count() == 0
    one = whitening.whiten(frame([(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert {(x.vec_id, x.component, x.n, x.deviation, x.whitened, x.explained, x.identity_error) for x in one} == {(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    flat = whitening.whiten(frame([(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert {(x.explained, x.whitened is None) for x in flat} == {(1.0, False), (0.0, True)}
    huge = whitening.whiten(frame([(1, [1e300]), (2, [-1e300]), (3, [0.0])])).collect()
    assert {x.deviation for x in huge if x.vec_id != 3} == {None} and max(x.identity_error for x in huge) < 1e-9


# 12 ---------------------------------------------------------------------------------------------------------------------
def brute_repair(rows):
    """The cheapest, then least, list of edits of (role, text, fault) by Dijkstra's rule over whole strings."""
    best = {0: (0, "", ())}
    insert = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def spread(held):
        for _ in range(4):
            for st, (cost, audit, lines) in list(held.items()):
                role, to = insert[st]
                new = (cost + 2, audit + "I", (*lines, f"{role}:"))
                if to not in held or new < held[to]:
                    held[to] = new
        return held

    every = [[(0, "", (), 0)]]
    for role, text, fault in rows:
        out = []
        for cost, audit, lines, st in every[-1]:
            for k in range(3):
                out.append((cost + 3, audit + "D", lines, st))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    out.append((cost + 2 + more, audit + "R", (*lines, f"{insert[st][0]}:{text}"), insert[st][1]))
                    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((st, role[:1]))
                    if to:
                        out.append((cost + more, audit + "K", (*lines, f"{role}:{text}"), to))
                cost, audit, lines, st = cost + 2, audit + "I", (*lines, f"{insert[st][0]}:"), insert[st][1]
        every.append(list({(x[3], x[1]): x for x in sorted(out, reverse=True)}.values()))
        least = {st: min(x[0] for x in every[-1] if x[3] == st) for st in range(4) if any(x[3] == st for x in every[-1])}
        every[-1] = [x for x in every[-1] if x[0] == least[x[3]]]  # all lists of that cost, whatever their order
    ends = []
    for cost, audit, lines, st in every[-1]:
        for k in range(3):
            if st in (0, 3):
                ends.append((cost, audit, lines))
            cost, audit, lines, st = cost + 2, audit + "I", (*lines, f"{insert[st][0]}:"), insert[st][1]
    return min(ends)


def test_crossings_against_all_lists():
    r = random.Random(3)
    for _ in range(300):
        rows = [(r.choice(["user", "assistant", "system", "tool", ""]), f"t{i}", r.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(r.randint(1, 9))]
        kinds = [repair.kind_of(role[:1], {"": "", "truncated": "cut"}.get(fault, "lost")) for role, _, fault in rows]
        at = r.randint(0, len(kinds))
        items = [repair.stretch_matrix(part) for part in (kinds[:at], kinds[at:]) if part]
        cost, end = repair.best_end(items)
        states = [0, *repair.crossings(kinds, 0, end)]
        audit = "".join(repair.EDITS[k][a][b][1] for k, a, b in zip(kinds, states, states[1:])) + repair.END[end]
        expected = brute_repair(rows)
        assert (cost, audit) == expected[:2], rows
        assert repair.crossings(items, 0, end)[0] == states[len(kinds[:at])] or not at  # through matrices as through rows


def table_of(rows):
    return pa.table({k: [x[i] for x in rows] for i, k in enumerate(["conv_id", "turn", "role", "text"])})


def test_repair_against_sql(spark):
    r = random.Random(5)
    rows = []
    for conv in [*range(60), None, -1]:
        for k in range(r.randint(1, 14)):
            row = (conv, r.choice([None, 0, 1, 2, 5, 9, k, k, k]), r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), r.choice([None, "", " ", "a", "hi.", "ok!", "what? ", "hmm", "é.\n", " "]))
            rows += [row] * r.choice([1, 1, 1, 1, 2, 3])
    c = duckdb.connect()
    c.register("conversations", table_of(rows))
    df = spark.createDataFrame([(*x, 1, "n") for x in rows], "conv_id long, turn long, role string, text string, copies int, name string")
    got = repair.repair(repair.damaged(df))
    cols = sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, c.sql(f"SELECT {', '.join(cols)} FROM ({repair.OP12_SQL})").fetchall()))


def test_repair_over_many_chunks(spark):
    """A conversation cut into many chunks over many partitions gives what it gives in one."""
    r = random.Random(9)
    rows = [(i % 4 if i % 9 == 0 else 1, i, r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", f"c{i}.", f"d{i}", ""])) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, repair.repair(repair.damaged(df)).collect()))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        cut = sorted(map(tuple, repair.repair(repair.damaged(df)).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert whole == cut and len(whole) == 4


def test_repair_odd(spark):
    schema = "conv_id long, turn long, role string, text string, copies int"
    assert repair.repair(spark.createDataFrame([], schema)).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    (row,) = repair.repair(spark.createDataFrame([(4, 1, "user", "gone", 0)], schema)).collect()
    assert tuple(row) == (4, 0, 0, 0, 0, 0, 0, "", none)
    long = "word " * 300_000 + "."
    (row,) = repair.repair(spark.createDataFrame([(None, None, "user", long, 3), (None, 2, "assistant", long, 1)], schema)).collect()
    assert (row.conv_id, row.duplicate, row.illegal, row.cost, row.audit, row.gaps) == (None, 2, 2, 6, "KDDK", 0)
    assert row.repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()


# 13 ---------------------------------------------------------------------------------------------------------------------
def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", lower) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    label = {p: p for p in prints}
    moved = True
    while moved:
        moved = False
        for a, b in itertools.combinations(sorted(label), 2):
            if (a ^ b).bit_count() <= 3 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                moved = True
    return label


def test_golay_code():
    _, errors = simhash.golay_tables()
    assert (errors >= 0).sum(1).tolist().count(6) == 1771 and (errors >= 0).sum() == 2048 + 8855
    r = random.Random(1)
    words = np.array([r.getrandbits(23) for _ in range(2000)])
    home = simhash.golay_keys(words)[:, 0]
    for bit in range(23):
        assert (simhash.golay_keys(words ^ (1 << bit)) == home[:, None]).any(1).all()


def test_every_pair_within_three_bits_meets():
    r = random.Random(2)
    for _ in range(400):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 3)):
            b ^= 1 << bit
        home = simhash.print_keys(np.array([a], np.uint64), True)[0]
        sought = simhash.print_keys(np.array([b], np.uint64), False)[0]
        assert len(home) == 8 and set(home.tolist()) & set(sought.tolist())


@pytest.mark.parametrize("few", [64, 2])
def test_components_of_a_cloud(spark, few, monkeypatch):
    monkeypatch.setattr(simhash, "FEW_HOMES", few)
    monkeypatch.setattr(simhash, "BLOCK", 128)
    r = random.Random(few)
    centres = [r.getrandbits(64) for _ in range(12)]
    prints = set(centres)
    for k in range(500):
        p = centres[0 if k < 250 else r.randrange(12)]
        for bit in r.sample(range(64), r.randint(1, 5)):
            p ^= 1 << bit
        prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    links = simhash.linked_prints(spark.createDataFrame([(signed(p),) for p in prints], "print long"))
    label = {x.node: x.label for x in connected_components(links).collect()}
    groups = lambda of: sorted(sorted(v) for v in of.values())
    got, expected = {}, {}
    for p in prints:
        got.setdefault(label.get(signed(p), signed(p)), []).append(p)
    for p, k in brute_components(prints).items():
        expected.setdefault(k, []).append(p)
    assert groups(got) == groups(expected)


def test_near_duplicates(spark):
    base = " ".join(f"w{i % 37}x{i % 11}" for i in range(400))
    texts = [base, base, base.upper(), base + " tail", None, "", " \t\n", "One", "one two", "ONE  two\nthree", "é É b", base * 40, "a\x0bb\x1fc"]
    rows = [(i + 3, t, 1) for i, t in enumerate(texts)] + [(3, base, 1), (None, base, 1), (None, "alone in the world", 2)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, print int")).collect()
    prints = {(i, brute_print(t)) for i, t, _ in rows}
    assert len(got) == len(rows) and {(x.doc_id, int(x.fingerprint, 16)) for x in got} == prints
    label = brute_components({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(least.get(label[p], i), i)
    assert all(x.component_id == least.get(label[int(x.fingerprint, 16)]) and len(x.fingerprint) == 16 for x in got)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
