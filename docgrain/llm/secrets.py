r"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

The patterns label all documents: what they mark as a value trains the model of random strings; tokens too short to be
candidates train the model of identifiers, so that no unmarked secret teaches it (both order 1, smoothed; the random one half
uniform). Marks such as ``_`` and ``-``, which stand in both, count for neither. A token outside the marked spans is a secret
if its log-likelihood ratio a pair passes a threshold, as it is written and in lower case without the pairs where a capital
follows a small letter, as names in camel case are read; of one
that does not pass, each piece between slashes and equals signs is judged by itself. Tokens of few different characters never
are. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import read_table, text_or_empty
from docgrain.llm.textblocks import blocks

#: Fixed values of the base kinds: pattern, group that is the value, least length of that group.
BASE_KINDS = (
    ("assign", rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", rb"AKIA[A-Z0-9]+", 0, 18),
    ("hex", rb"[0-9a-f]+", 0, 16),
)
ASSIGN, ACCESS = re.compile(BASE_KINDS[0][1]), re.compile(BASE_KINDS[1][1])
KINDS = ("assign", "access", "hex", "markov")
#: Characters of tokens: what random strings are written in.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What parts tokens into pieces: paths and assignments.
PARTING = b"/="
#: Marks between the words of identifiers and in random strings alike: a pair with one says nothing for either model.
NEUTRAL = b"+/_=-"
LEAST_LENGTH = 20
#: Different characters that a candidate has at least: rules of dashes and the like are neither random nor identifiers.
LEAST_KINDS = 8
#: Nats a pair of letters or digits by which a token must be likelier under the model of random strings. Tests hold it against
#: made identifiers (at most 2 % pass) and random strings (at least 95 % pass) that no model has seen.
LEAST_RATIO = 1.0

CODE = np.full(256, -1, np.int64)
CODE[list(ALPHABET)] = np.arange(len(ALPHABET))
#: By code: whether a character's pairs say something; the last entry is that of no code.
SAYS = np.array([c not in NEUTRAL for c in ALPHABET] + [False])
#: By code: that of the letter in lower case.
FOLDED = np.append(CODE[[c + 32 if 65 <= c <= 90 else c for c in ALPHABET]], -1)
IS_PARTING = np.zeros(256, bool)
IS_PARTING[list(PARTING)] = True
IS_HEX = np.zeros(256, bool)
IS_HEX[list(b"0123456789abcdef")] = True


def _runs(inside: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` marked bytes, none of which crosses from one text to the next."""
    step = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cut = at[1:-1]
    k = np.searchsorted(begins, cut, side="left") - 1
    crossed = cut[(k >= 0) & (begins[np.maximum(k, 0)] < cut) & (ends[np.maximum(k, 0)] > cut)] if len(begins) else cut[:0]
    begins, ends = np.sort(np.concatenate([begins, crossed])), np.sort(np.concatenate([ends, crossed]))
    long = ends - begins >= least
    return begins[long], ends[long]


def base_spans(text: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) in bytes, without the kind hex, which is found for whole blocks."""
    out = []
    low = text.lower()
    if any(k in low for k in (b"pass", b"secret", b"token", b"api")):
        out += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= BASE_KINDS[0][3]]
    if b"AKIA" in text:
        out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= BASE_KINDS[1][3]]
    return out


def _block_spans(block) -> list[list[tuple[str, int, int, int]]]:
    """The base spans of each text of a block, in bytes."""
    spans: list[list] = [[] for _ in range(block.n)]
    begins, ends = _runs(IS_HEX[block.data], block.at, BASE_KINDS[2][3])
    for b, e, t in zip(begins.tolist(), ends.tolist(), (np.searchsorted(block.at, begins, side="right") - 1).tolist()):
        spans[t].append(("hex", b - int(block.at[t]), e - int(block.at[t]), b - int(block.at[t])))
    for t in range(block.n):
        spans[t] += base_spans(block.text(t))
    return spans


def train(docs: DataFrame) -> np.ndarray:
    """The table of log-likelihood ratios of character pairs over all rows of ``docs``, null ids included.

    Each task sums its counts, of which there are 2 x 67 x 67 at most, before Spark adds them up. Where the patterns mark
    nothing the random model is uniform; an empty table leaves both uniform, and no token is then likelier under either.
    """
    n = len(ALPHABET)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, n * n), np.int64)
        for batch in batches:
            for block in blocks(batch):
                label = np.zeros(len(block.data), bool)
                for t, spans in enumerate(_block_spans(block)):
                    for _, _, end, value in spans:
                        label[block.at[t] + value : block.at[t] + end] = True
                code = CODE[block.data]
                begins, ends = _runs(code >= 0, block.at, LEAST_LENGTH)
                long = np.cumsum(np.bincount(begins, minlength=len(code) + 1) - np.bincount(ends, minlength=len(code) + 1))[: len(code)] > 0
                both = (code[1:] >= 0) & (code[:-1] >= 0)
                both[block.at[1:-1][(block.at[1:-1] > 0) & (block.at[1:-1] < len(block.data))] - 1] = False
                pair = code[:-1] * n + code[1:]
                for kind in (0, 1):
                    counts[kind] += np.bincount(pair[both & (label[1:] & label[:-1] if kind else ~(label | long)[1:] & ~(label | long)[:-1])], minlength=n * n)
        kind, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(pair), pa.array(counts[kind, pair])], ["kind", "pair", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(pairs, "kind long, pair long, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, n, n))
    for r in rows:
        counts[r.kind, r.pair // n, r.pair % n] = r.n
    ordinary = (counts[0] + 0.05) / (counts[0] + 0.05).sum(1, keepdims=True)
    random = (counts[1] + 0.5) / (counts[1] + 0.5).sum(1, keepdims=True)
    ratio = np.log(0.5 * random + 0.5 / n) - np.log(ordinary)
    marks = CODE[list(NEUTRAL)]
    ratio[marks, :] = ratio[:, marks] = 0.0
    return ratio


def markov_spans(block, ratio: np.ndarray, base: list[list[tuple[str, int, int, int]]], least: int = LEAST_LENGTH, threshold: float = LEAST_RATIO) -> list[list[tuple[str, int, int, int]]]:
    """Tokens of each text, outside its base spans, that are likelier random than ordinary, in bytes; if a token is not, its pieces."""
    code = CODE[block.data]
    for t, some in enumerate(base):
        for _, begin, end, _ in some:
            code[block.at[t] + begin : block.at[t] + end] = -1
    spans: list[list] = [[] for _ in range(block.n)]
    begins, ends = _runs(code >= 0, block.at, least)
    if not len(begins):
        return spans
    both = (code[1:] >= 0) & (code[:-1] >= 0)
    folded = FOLDED[code]
    hump = (folded[1:] != code[1:]) & (folded[:-1] == code[:-1])
    readings = []
    for c, telling in ((code, both & SAYS[code[1:]] & SAYS[code[:-1]]), (folded, both & ~hump & SAYS[code[1:]] & SAYS[code[:-1]])):
        total, n = np.zeros(len(code) + 1), np.zeros(len(code) + 1, np.int64)  # at j: of the pairs that end before j
        total[2:], n[2:] = np.cumsum(np.where(telling, ratio[c[:-1], c[1:]], 0.0)), np.cumsum(telling)
        readings.append((total, n))
    passes = lambda b, e: np.all([t[e] - t[b + 1] >= threshold * np.maximum(1, n[e] - n[b + 1]) for t, n in readings], axis=0)
    whole = passes(begins, ends)
    piece, stop = _runs((code >= 0) & ~IS_PARTING[block.data], block.at, least)
    owner = np.searchsorted(begins, piece, side="right") - 1
    apart = ~whole[owner] & passes(piece, stop)
    found = sorted([*zip(begins[whole].tolist(), ends[whole].tolist()), *zip(piece[apart].tolist(), stop[apart].tolist())])
    for b, e in found:
        if len(np.unique(block.data[b:e])) < LEAST_KINDS:
            continue
        t = int(np.searchsorted(block.at, b, side="right")) - 1
        spans[t].append(("markov", b - int(block.at[t]), e - int(block.at[t]), b - int(block.at[t])))
    return spans


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for kind, b, e in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def scan_documents(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of every row of ``docs``.

    Null texts are empty; null ids are ordinary values; equal rows get equal results; an empty table gives an empty
    result; other columns are ignored. Model spans lie outside base spans: what sticks out of one is judged by itself.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                counts, base_of, all_of = np.zeros((block.n, 4), np.int64), [], []
                marked = _block_spans(block)
                for t, (base, more) in enumerate(zip(marked, markov_spans(block, ratio, marked))):
                    if base or more:
                        own = block.data[block.at[t] : block.at[t + 1]]
                        points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
                        base, more = ([(k, int(points[b]), int(points[e])) for k, b, e, _ in some] for some in (base, more))
                        for kind, _, _ in base + more:
                            counts[t, KINDS.index(kind)] += 1
                    base_of.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    all_of.append(_joined(base + more))
                columns = [batch.column(0).slice(block.first, block.n), *(pa.array(counts[:, k]) for k in range(3)), pa.array(base_of, pa.string()), pa.array(all_of, pa.string()), pa.array(counts[:, 3])]
                yield pa.RecordBatch.from_arrays(columns, names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return narrow.mapInArrow(scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")


def find_secrets(docs: DataFrame) -> DataFrame:
    return scan_documents(docs, train(docs))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))
