"""Vectorised hashing of words and word windows over whole batches of texts.

A word is a run of bytes other than space and \\x09-\\x0D. Every word gets a 64-bit
polynomial hash of its bytes, every run of words a polynomial hash of its words;
both come from prefix sums modulo 2**64, so no Python object is made per word.
"""

from __future__ import annotations

import re

import numpy as np

U = np.uint64
SEGMENT = 1 << 20  # bytes hashed at a time; a longer text is cut between words
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.up, self.down = self._table(self.base), self._table(self.inverse)
        return self.up[:n], self.down[:n]

    def _table(self, base: int) -> np.ndarray:
        table = np.full(self.size, base, U)
        table[0] = 1
        return np.multiply.accumulate(table)


_BYTES, _WORDS = Powers(0x9E3779B97F4A7C15), Powers(0xD6E8FEB86659FD93)


def segment(data: bytes, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start and end offsets of the words of ``data``."""
    b = np.frombuffer(data, np.uint8)
    up, down = _BYTES.get(len(b) + 1)
    gap = np.empty(len(b) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[b]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, U)
    np.cumsum(codes[b] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U)), start, end


def _pieces(blob: bytes):
    """Parts of at most about SEGMENT bytes, cut at white space only."""
    at = 0
    while at < len(blob):
        gap = _GAP.search(blob, at + SEGMENT) if len(blob) - at > SEGMENT else None
        end = gap.end() if gap else len(blob)
        yield blob[at:end]
        at = end


def hash_words(blobs: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of the texts in a row, and the bounds of each text within them."""
    codes = byte_codes(lower)
    parts: list[np.ndarray] = []
    counts = np.zeros(len(blobs), np.int64)
    group: list[bytes] = []
    first = held = 0

    def flush(upto: int) -> None:
        nonlocal group, held, first
        if group:
            h, start, _ = segment(b" ".join(group), codes)
            cuts = np.cumsum([len(x) + 1 for x in group])
            counts[first:upto] += np.diff(np.searchsorted(start, cuts), prepend=0)
            parts.append(h)
        group, held, first = [], 0, upto

    for i, blob in enumerate(blobs):
        blob = blob or b""
        if len(blob) > SEGMENT:
            flush(i)
            for piece in _pieces(blob):
                h, _, _ = segment(piece, codes)
                counts[i] += len(h)
                parts.append(h)
            first = i + 1
            continue
        group.append(blob)
        held += len(blob) + 1
        if held > SEGMENT:
            flush(i + 1)
    flush(len(blobs))
    bounds = np.zeros(len(blobs) + 1, np.int64)
    np.cumsum(counts, out=bounds[1:])
    return np.concatenate(parts) if parts else np.zeros(0, U), bounds


class Runs:
    """Hashes of arbitrary runs of words."""

    def __init__(self, words: np.ndarray):
        up, self.down = _WORDS.get(len(words) + 1)
        self.total = np.zeros(len(words) + 1, U)
        np.cumsum(words * up[:-1], out=self.total[1:])

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        end = start + length
        raw = (self.total[end] - self.total[start]) * self.down[start]
        return mix(raw ^ (np.asarray(length).astype(U) * U(0xA0761D6478BD642F)))


def starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start index of every window of ``width`` words, and windows per text."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(bounds[:-1] - before, counts), counts


def word_spans(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which the words of one text start and end."""
    gap = np.empty(len(blob) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[np.frombuffer(blob, np.uint8)]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_NO_LETTER = re.compile(rb"[^A-Za-z\x80-\xff]")


def affix_hashes(blobs: list[bytes], prefixes: tuple[int, ...]):
    """Runs of letters (and bytes above 127), A-Z in lower case: hashes of each run and of its prefixes.

    Returns the hash arrays, start and end bytes within the texts laid end to end with
    one byte between, the bounds of each text's runs, and where each text begins.
    """
    codes = byte_codes(True)
    begins = np.cumsum([0] + [len(b) + 1 for b in blobs])
    hashes: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
    starts_, ends_ = [], []

    def one(data: bytes, base: int) -> None:
        b = np.frombuffer(data, np.uint8)
        up, down = _BYTES.get(len(b) + 1)
        letter = np.zeros(len(b) + 2, bool)
        letter[1:-1] = _LETTER[b]
        edge = np.flatnonzero(letter[1:] != letter[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(b) + 1, U)
        np.cumsum(codes[b] * up[:-1], out=total[1:])
        for out, k in zip(hashes, (None, *prefixes), strict=True):
            stop = end if k is None else np.minimum(end, start + k)
            out.append((total[stop] - total[start]) * down[start])
        starts_.append(start + base)
        ends_.append(end + base)

    joined = b" ".join(blobs)
    at = 0
    while at < len(joined):
        gap = _NO_LETTER.search(joined, at + SEGMENT) if len(joined) - at > SEGMENT else None
        stop = gap.end() if gap else len(joined)
        one(joined[at:stop], at)
        at = stop
    start = np.concatenate(starts_) if starts_ else np.zeros(0, np.int64)
    end = np.concatenate(ends_) if ends_ else np.zeros(0, np.int64)
    bounds = np.searchsorted(start, begins)
    return [np.concatenate(h) if h else np.zeros(0, U) for h in hashes], start, end, bounds, begins
