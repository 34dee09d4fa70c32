"""Hashed words and word shingles of a batch of texts, computed on whole byte buffers.

Texts are split at space and U+0009 to U+000D, or at other bytes if told, A-Z lower-cased.  Words and
shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from textlode.llm.common import mix, once_per_worker

# Bytes that are worked on at once; a longer text is a piece of its own.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Everything of ASCII but letters and digits: a passage keeps its words when its punctuation changes.
MARKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
# One odd factor per place of a word in its shingle.
_PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least `n` of each."""
    size = 1 << max(20, int(n - 1).bit_length())

    def build():
        both = []
        for base in (_BASE, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        return tuple(both)

    return once_per_worker(f"powers-{size}", build)


def words(buffer: np.ndarray, starts: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of the first word of each text (and of the end).

    A long buffer is worked on piece by piece, cut where no word is, so that the tables of powers stay as long as a piece.
    """
    hashes, begins = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    low = 0
    while low < len(buffer):
        high = len(buffer) if len(buffer) - low <= 2 * CHUNK else _gap(buffer, low + CHUNK, between)
        inner = starts[(starts > low) & (starts < high)] - low
        own, begin = _word_hashes(buffer[low:high], inner, between)
        hashes.append(own)
        begins.append(begin + low)
        low = high
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), starts)


def _gap(buffer: np.ndarray, at: int, between: np.ndarray) -> int:
    """The first place from `at` that belongs to no word, or the end."""
    while at < len(buffer):
        found = np.flatnonzero(between[_LOWER[buffer[at : at + CHUNK]]])
        if len(found):
            return at + int(found[0])
        at += CHUNK
    return len(buffer)


def _word_hashes(buffer: np.ndarray, edges: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and where they begin; at `edges` another text begins."""
    n = len(buffer)
    low = _LOWER[buffer]
    solid = ~between[low]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[edges - 1] = solid[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[low] * power[:n], out=sums[1:])
    hashes = (sums[end] - sums[begin]) * inverse[begin]
    return mix(hashes + (end - begin).astype(np.uint64)), begin


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `k`-word shingles, and the first shingle of each text (and the end).

    A text with fewer than `k` words, but at least one, has its whole sequence as its only shingle,
    which is named like a shingle of so many words.
    """
    count = np.diff(bounds)
    many = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(many)])
    out = np.empty(first[-1], np.uint64)
    full = max(0, len(hashes) - k + 1)
    rolled = np.zeros(full, np.uint64)
    for place in range(k if full else 0):
        rolled += hashes[place : place + full] * _PLACES[place]
    long = np.flatnonzero(count >= k)
    if len(long):
        shift = np.repeat(bounds[long] - first[long], many[long])
        at = np.repeat(first[long] - np.concatenate([[0], np.cumsum(many[long])[:-1]]), many[long])
        at += np.arange(len(at))
        out[at] = rolled[at + shift]
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for place in range(n):
                whole += hashes[bounds[short] + place] * _PLACES[place]
            out[first[short]] = whole
    return mix(out), first


def pieces(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes together."""
    low = 0
    while low < len(starts) - 1:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + CHUNK, side="right")) - 1)
        yield low, high
        low = high


def shingle_sets(buffer: np.ndarray, starts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For every text its distinct shingles, ascending."""
    for low, high in pieces(starts):
        part = starts[low : high + 1]
        hashes, bounds = words(buffer[part[0] : part[-1]], part - part[0])
        found, first = shingles(hashes, bounds, k)
        for i in range(high - low):
            own = np.sort(found[first[i] : first[i + 1]])
            if len(own) > 1:
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                own = own[keep]
            yield own
