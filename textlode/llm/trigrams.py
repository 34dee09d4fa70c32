"""Boolean trigram queries from regular expressions, and a trigram index of a batch of texts.

A query is True (says nothing), a trigram, or a tuple ("and" | "or", parts).
Trigrams are bytes of the lower-cased (A-Z) UTF-8 text, so a query holds for
every text in which the expression matches, whatever the case.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

import numpy as np

from textlode.llm.common import once_per_worker

# Alternatives of a literal stretch that are followed one by one; more are given up.
MAX_STRINGS = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _all_of(parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(parts: list):
    parts = list(dict.fromkeys(parts))
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_string(text: str):
    raw = text.encode()
    return _all_of([raw[i : i + 3] for i in range(len(raw) - 2)])


class _Walk:
    """Strings that the expression must spell so far, and what earlier stretches demand."""

    def __init__(self):
        self.strings, self.needs = {""}, []

    def flush(self) -> None:
        self.needs.append(_any_of([_of_string(s) for s in self.strings]))
        self.strings = {""}

    def add(self, options: set[str]) -> None:
        joined = {a + b for a in self.strings for b in options}
        if len(joined) > MAX_STRINGS:
            self.flush()
            joined = options
        if len(joined) > MAX_STRINGS:
            joined = {""}
        self.strings = joined


def _letters(items: list) -> set[str] | None:
    """The characters of a small class, or None."""
    found = set()
    for kind, value in items:
        if kind is C.LITERAL and value < 128:
            found.add(chr(value).lower())
        elif kind is C.RANGE and value[1] < 128 and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _follow(tree, walk: _Walk) -> None:
    for kind, value in tree:
        if kind is C.LITERAL and value < 128:
            walk.add({chr(value).lower()})
        elif kind is C.IN and (letters := _letters(value)):
            walk.add(letters)
        elif kind is C.SUBPATTERN:
            _follow(value[3], walk)
        elif kind is C.BRANCH:
            exact, parts = set(), []
            for branch in value[1]:
                own = _Walk()
                _follow(branch, own)
                if not own.needs:
                    exact |= own.strings
                own.flush()
                parts.append((_all_of(own.needs), len(own.needs) == 1))
            if all(plain for _, plain in parts):
                walk.add(exact)
            else:
                walk.flush()
                walk.needs.append(_any_of([need for need, _ in parts]))
        elif kind in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, inner = value
            own = _Walk()
            _follow(inner, own)
            if low == 0 and high == 1 and not own.needs and len(own.strings) == 1:
                walk.add({""} | own.strings)
            elif 1 <= low == high <= 4 and not own.needs and len(own.strings) == 1:
                walk.add({next(iter(own.strings)) * low})
            else:
                walk.flush()
                if low > 0:
                    own.flush()
                    walk.needs += own.needs
        elif kind in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue
        else:
            walk.flush()


def trigram_query(pattern: str, flags: int = 0):
    """A Boolean query that holds in every text with a match; True if the rule demands no trigram."""
    walk = _Walk()
    _follow(_parser.parse(pattern, flags), walk)
    walk.flush()
    return _all_of(walk.needs)


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


def postings(buffer: np.ndarray, starts: np.ndarray, grams: list[bytes]) -> dict[bytes, np.ndarray]:
    """For each trigram the ascending numbers of the texts that hold it.

    `buffer`: bytes of all texts, one after the other; text i is starts[i]:starts[i + 1].
    """
    found = {g: np.empty(0, np.int64) for g in grams}
    if len(buffer) < 3 or not grams:
        return found
    def build() -> np.ndarray:
        table = np.zeros(1 << 24, np.uint8 if len(grams) < 256 else np.uint16)
        table[[g[0] | g[1] << 8 | g[2] << 16 for g in grams]] = np.arange(1, len(grams) + 1)
        return table

    table = once_per_worker(f"trigrams-{grams}", build)
    hits, slots = [], []
    step = 1 << 20
    for low in range(0, len(buffer) - 2, step):
        part = LOWER[buffer[low : low + step + 2]].astype(np.uint32)
        slot = table[part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)]
        at = np.flatnonzero(slot)
        hits.append(at + low)
        slots.append(slot[at])
    at, slot = np.concatenate(hits), np.concatenate(slots)
    row = np.searchsorted(starts, at, side="right") - 1
    whole = at + 3 <= starts[row + 1]
    keys = np.unique(slot[whole].astype(np.int64) * len(starts) + row[whole])
    number, row = keys // len(starts), keys % len(starts)
    edges = np.searchsorted(number, np.arange(1, len(grams) + 2))
    return {g: row[edges[i] : edges[i + 1]] for i, g in enumerate(grams)}


def candidates(query, lists: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts for which the query holds: postings intersected and united."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return lists[query]
    parts = [candidates(p, lists, n) for p in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(parts))
    parts.sort(key=len)
    found = parts[0]
    for part in parts[1:]:
        found = np.intersect1d(found, part, assume_unique=True)
    return found


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of an Arrow string column without nulls, without copying the texts."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(starts) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def check(pattern: str, flags: int, text: str) -> bool:
    """Whether the query allows the text; for tests: never False where the expression matches."""
    raw = np.frombuffer(text.encode(), np.uint8)
    query = trigram_query(pattern, flags)
    lists = postings(raw, np.array([0, len(raw)]), sorted(trigrams_of(query)))
    return len(candidates(query, lists, 1)) == 1 or re.search(pattern, text, flags) is None
