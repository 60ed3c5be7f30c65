"""Texts of Arrow batches as blocks of bytes, and hashes of their words and substrings, all as numpy vectors.

A block holds whole texts, about ``BLOCK_BYTES`` at most (a longer text is a block of its own), so the vectors inside a
task stay small whatever the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

#: Bytes of words: digits, letters, and all of non-ASCII characters; A-Z count as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


class Block:
    """Rows ``first`` to ``first + n`` of a batch: their bytes in one array, text i at ``at[i]`` to ``at[i + 1]``."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray):
        self.first, self.data, self.at, self.n = first, data, at, len(at) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.at)

    def text(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()

    def owner(self) -> np.ndarray:
        """The text of each byte."""
        return np.repeat(np.arange(self.n), self.sizes)


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column; nulls are empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, raw = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Block(first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(1 << max(10, int(n - 1).bit_length()), int(base))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes of all substrings of ``data`` from one pass: equal substrings get equal hashes."""

    def __init__(self, data: np.ndarray):
        values = mix(data.astype(np.uint64) + np.uint64(0x51ED270B))  # a byte is a random 64-bit word
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * powers(max(1, len(data)))[: len(data)], out=self.sums[1:])
        self.inverse = powers(len(data) + 1, _INVERSE)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))


def word_spans(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of all words of a block; words never cross texts."""
    inside = np.zeros(len(block.data) + 2, np.int8)
    inside[1:-1] = IS_WORD[block.data]
    step = np.diff(inside)
    begins, ends = step[:-1] == 1, step[1:] == -1
    cut = block.at[1:-1]
    cut = cut[(cut > 0) & (cut < len(block.data))]
    joined = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    begins[joined] = True
    ends[joined - 1] = True
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) and the text that it stands in."""
    begins, ends = word_spans(block)
    hashes = Rolling(LOWER[block.data]).of(begins, ends)
    return hashes, np.searchsorted(block.at, begins, side="right") - 1


def shingles(hashes: np.ndarray, owner: np.ndarray, n_texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (hashes of ``width`` words in a row) of each text, sorted by text and hash.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    combined = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        combined = combined * BASE + hashes[k : k + len(combined)]
    whole = owner[: len(combined)] == owner[width - 1 :] if len(combined) else np.zeros(0, bool)
    values, owners = mix(combined[whole]), owner[: len(combined)][whole]
    counts = np.bincount(owner, minlength=n_texts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(owner, short)
        extra = np.array([mix(np.array([_fold(hashes[f : f + counts[t]])], np.uint64))[0] for t, f in zip(short, first)], np.uint64)
        values, owners = np.concatenate([values, extra]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return values[new], owners[new]


def _fold(hashes: np.ndarray) -> int:
    out = len(hashes)
    for h in hashes.tolist():
        out = (out * int(BASE) + h) % (1 << 64)
    return out
