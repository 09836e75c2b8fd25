"""What the operators mean by words and lines, and the vectorised word hashes that several of them share.

A word is a run of bytes other than space and the controls 9-13; case folding changes A-Z alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = " \t\n\x0b\x0c\r"
#: Java and Python regular expressions for a run of blanks.
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; more only for a single longer word.
_SEGMENT = 1 << 21
_powers = {1: np.ones(1, np.uint64), 2: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    which = 1 if base == _BASE else 2
    if len(_powers[which]) < n:
        p = np.full(max(n, _SEGMENT + 1), base, np.uint64)
        p[0] = 1
        _powers[which] = np.cumprod(p)
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the result."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cuts batches so that the texts of each piece hold at most ``limit`` bytes, or are one text; a
    null text becomes an empty one."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
        if not len(texts):
            continue
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), texts.slice(i, j - i)
            i = j


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _FOLD[data]


def word_bounds(texts: pa.Array, blank: np.ndarray = _IS_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a large_string array: the bytes of all texts, the start and end of every word in them, and per
    text the index of its first word (one more entry at the end). ``blank`` marks the bytes between words."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    edges = ends - ends[0]
    ink = ~blank[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] |= ink[inner]
    last[inner - 1] |= ink[inner - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, stops, np.searchsorted(starts, edges)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, folded: bool = True) -> np.ndarray:
    """64-bit hashes of the words, A-Z folded or as they are: a polynomial over the bytes, taken from running sums, then mixed."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + _SEGMENT, "right")))
        lo, hi = int(starts[i]), int(stops[j - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(((_FOLD[data[lo:hi]] if folded else data[lo:hi]).astype(np.uint64) + np.uint64(1)) * _power(_BASE, hi - lo), out=sums[1:])
        s, e = starts[i:j] - lo, stops[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * _power(_UNBASE, hi - lo + 1)[s]
        i = j
    return mix(out ^ ((stops - starts).astype(np.uint64) << np.uint64(40)))
