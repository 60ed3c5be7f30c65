"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled 1; the unlabelled text is a sample of all training documents, good and bad, of
which a prior share, estimated from the two samples alone, is positive. The non-negative unbiased risk
``prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)])`` with the logistic loss is minimised by mini-batches, once on
each half of both samples. The half that a fit has not seen makes its values probabilities: by Bayes' rule the chance of
label 1 at a value is prior times the density of positives there over that of the unlabelled. The score is the mean of both
fits. Only the text is an input: shares of bytes, lengths and repetition of words and lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgrain.llm.common import read_table, text_or_empty
from docgrain.llm.textblocks import Block, blocks, word_hashes, word_spans

#: Bounds of the two samples that the fit reads (documents by the order of a hash of their ids).
POSITIVES = 8_000
UNLABELLED = 8_000
THRESHOLD = 0.3
FEATURES = 256 + 8


def features(block: Block) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each text."""
    sizes = block.sizes
    owner = block.owner()
    bytes_of = np.bincount(owner * 256 + block.data, minlength=block.n * 256).reshape(block.n, 256).astype(np.float64)
    share = np.sqrt(bytes_of / np.maximum(1, sizes)[:, None])
    hashes, words_in = word_hashes(block)
    begins, ends = word_spans(block)
    n = np.bincount(words_in, minlength=block.n).astype(np.float64)
    order = np.lexsort((hashes, words_in))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words_in[order][1:] != words_in[order][:-1])
    distinct = np.bincount(words_in[order][new], minlength=block.n)
    again = np.bincount(words_in[1:][(hashes[1:] == hashes[:-1]) & (words_in[1:] == words_in[:-1])], minlength=block.n)
    length = np.bincount(words_in, weights=ends - begins, minlength=block.n)
    square = np.bincount(words_in, weights=(ends - begins) ** 2.0, minlength=block.n)
    mean = length / np.maximum(1, n)
    upper = np.add.reduce(bytes_of[:, 65:91], axis=1) / np.maximum(1, np.add.reduce(bytes_of[:, 97:123], axis=1) + np.add.reduce(bytes_of[:, 65:91], axis=1))
    more = [np.log1p(sizes), np.log1p(n), distinct / np.maximum(1, n) ** 0.8, again / np.maximum(1, n), mean, np.sqrt(np.maximum(0, square / np.maximum(1, n) - mean**2)), upper, np.log1p(bytes_of[:, 10]) - np.log1p(n)]
    return np.hstack([share, np.array(more).T]).astype(np.float32)


def held_out() -> Column:
    """Rows whose labels no fit may see."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def _sample(ids: DataFrame, n: int, seed: int) -> DataFrame:
    return ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n)


def _features_of(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in features(block)], pa.binary())], ["x"])

    # the sample is bounded, so it is broadcast
    picked = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    rows = picked.mapInArrow(of, "x binary").collect()
    return np.array([np.frombuffer(r.x, np.float32) for r in rows]).reshape(-1, FEATURES)


#: Shares of the positives at whose values the bins of the calibration are cut.
CUTS = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.05) -> float:
    """The share of positives among the unlabelled, from values of both that their fit has not seen: no label 0 is used.

    Above any threshold the unlabelled can hold no fewer than prior times the share of positives there, so the least ratio
    of the two shares, with its margin of error, over thresholds that leave at least ``least`` of the positives, is the
    estimate.
    """
    zp, zu = np.sort(positive), np.sort(unlabelled)
    cuts = zp[: max(1, int(len(zp) * (1 - least)))]
    share_p = 1 - np.searchsorted(zp, cuts, side="left") / len(zp)
    share_u = 1 - np.searchsorted(zu, cuts, side="left") / len(zu)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(zp)) + 1 / np.sqrt(len(zu)))
    at = np.argmin((share_u + margin) / share_p)
    return float(np.clip(share_u[at] / share_p[at], 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2000, batch: int = 512, rate: float = 0.01, decay: float = 1e-4, seed: int = 0) -> dict:
    """Weights of a linear value that minimises the non-negative risk; Adam, fixed seed."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-2
    p, u = (np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))]).astype(np.float32) for x in (positive, unlabelled))
    random = np.random.default_rng(seed)
    w = np.zeros(p.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        xp, xu = (x[random.integers(0, len(x), batch)] for x in (p, u))
        zp, zu = xp @ w, xu @ w
        as_bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()  # the risk of the negatives among the unlabelled
        of_bad = (xu.T @ sigmoid(zu) - prior * (xp.T @ sigmoid(zp))) / batch
        grad = -prior * (xp.T @ sigmoid(-zp)) / batch + of_bad if as_bad >= 0 else -of_bad
        grad = grad + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (1 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": w.astype(np.float64)}


def value(fitted: dict, x: np.ndarray) -> np.ndarray:
    """What a fit gives texts, unbounded; larger for label 1."""
    return np.clip((x - fitted["mean"]) / fitted["scale"], -8, 8) @ fitted["w"][:-1] + fitted["w"][-1]


def calibration(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Values and the chance of label 1 at each, from values that the fit has not seen.

    Bins are cut at values of the positives; half a text is added to each bin's unlabelled ones. Beyond the values that
    nearly all positives have the chance is what the outer bins say: little, where many unlabelled texts lie there.
    """
    edges = np.unique(np.quantile(positive, CUTS))
    bins = np.r_[-np.inf, edges, np.inf]
    p, u = np.histogram(positive, bins)[0] / len(positive), (np.histogram(unlabelled, bins)[0] + 0.5) / len(unlabelled)
    return np.r_[edges[0], (edges[1:] + edges[:-1]) / 2, edges[-1]], np.clip(prior * p / u, 0, 1)


def fit_halves(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 0) -> dict:
    """The prior and both fits with their calibrations, each from the half that the other one learnt from."""
    halves = [(x[::2], x[1::2]) if len(x) > 1 else (x, x) for x in (positive, unlabelled)]
    pilot = fit(halves[0][0], halves[1][0], 0.5, steps=1000, seed=seed)
    prior = estimated_prior(value(pilot, halves[0][1]), value(pilot, halves[1][1]))
    parts = []
    for k in (0, 1):
        fitted = fit(halves[0][k], halves[1][k], prior, seed=seed)
        parts.append(fitted | {"chance": calibration(value(fitted, halves[0][1 - k]), value(fitted, halves[1][1 - k]), prior)})
    return {"prior": prior, "parts": parts}


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, seed: int = 0) -> dict | None:
    """The fitted model from rows outside the held-out fold; None if there are no positives or no other text."""
    labels = labels.where("doc_id IS NOT NULL")
    good = labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    xp = _features_of(docs, _sample(good, positives, seed))
    xu = _features_of(docs, _sample(docs.where(~held_out() & F.col("doc_id").isNotNull()), unlabelled, seed + 1))
    # rows come in no order of their own: the halves are those of sorted rows
    xp, xu = (x[np.lexsort(x.T[::-1])] for x in (xp, xu))
    return fit_halves(xp, xu, seed) if len(xp) and len(xu) else None


def score(model: dict | None, x: np.ndarray) -> np.ndarray:
    """The mean chance of both fits; a hundredth follows the value itself, so that texts of equal chance keep its order."""
    if model is None:
        return np.full(len(x), 0.5)
    out = np.zeros(len(x))
    for part in model["parts"]:
        z, (at, chance) = value(part, x), part["chance"]
        out += 0.99 * np.interp(z, at, chance) + 0.01 / (1 + np.exp(-np.clip(z - at[0], -30, 30)))
    return np.clip(out / len(model["parts"]), 0, 1)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Null texts are empty, and empty texts are scored like others; null ids are ordinary values and never learnt from;
    equal rows get equal scores; without labels of good training rows every score is 0.5; an empty table gives an empty
    result; other columns are ignored.
    """
    model = train(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                ids = batch.column(0).slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(score(model, features(block)).astype(np.float64))], ["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = narrow.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good; columns unchanged."""
    model = train(docs, labels)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.concatenate([np.zeros(0, bool), *(score(model, features(block)) >= THRESHOLD for block in blocks(batch))])
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(kept, docs.schema)


def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
