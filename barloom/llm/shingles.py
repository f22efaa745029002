"""Word shingles as 64-bit hashes, for whole batches of texts at a time.

Words are maximal runs of other bytes than ASCII white space, with A-Z lower-cased; a text's set holds
its distinct runs of ``k`` words. A text of fewer words has the whole sequence as its one shingle, a
text without words (null and empty ones too) the empty set.
"""

from __future__ import annotations

import re

import numpy as np

from barloom.llm.common import worker_cache

SPACES = b" \t\n\v\f\r"
WIDE = 1 << 19  # bytes hashed at once
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h



def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    made = worker_cache("shingles")
    if "shingle bytes" in made:
        return made["shingle bytes"]
    is_space = np.zeros(256, dtype=bool)
    is_space[list(SPACES)] = True
    made["shingle bytes"] = is_space, mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
    return made["shingle bytes"]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    made = worker_cache("shingles")
    if made.get("shingle size", 0) >= size:
        return made["shingle powers"]
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    made["shingle size"], made["shingle powers"] = size, (out[0], out[1])
    return made["shingle powers"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words of lower-cased bytes.

    The hash of a word is a polynomial over its bytes, read off running sums over the whole buffer.
    """
    is_space, values = _byte_tables()
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gap = np.ones(len(raw) + 2, dtype=bool)
    gap[1:-1] = is_space[raw]
    turns = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = turns[::2], turns[1::2]
    power, inverse = _powers(1 << max(19, int(len(raw) - 1).bit_length()))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * power[: len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _word_stream(data: bytes) -> np.ndarray:
    """Word hashes of one text of any length, hashed in parts that end at white space."""
    out, at = [], 0
    while at < len(data):
        cut = len(data)
        if cut - at > WIDE:
            found = re.compile(rb"[ \t-\r]").search(data, at + WIDE)
            cut = found.start() if found else cut
        out.append(word_hashes(data[at:cut])[1])
        at = cut
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words."""
    h = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        h = mix(h * _STEP + words[j : len(words) - k + 1 + j])
    return mix(h + np.uint64(k))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    coded = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    if sum(map(len, coded)) > WIDE:
        words = [_word_stream(c) for c in coded]
        joined = np.concatenate(words) if words else np.zeros(0, np.uint64)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    else:
        starts, joined = word_hashes(b" ".join(coded))
        firsts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
        bounds = np.searchsorted(starts, firsts)
    runs = _runs(joined, k) if len(joined) >= k else np.zeros(0, np.uint64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            out.append(_runs(joined[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_identity(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set's hashes: equal sets have equal identities, others do not in practice."""
    one = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    two = mix(s + _STEP).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))
