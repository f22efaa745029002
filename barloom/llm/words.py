"""Words of letters and digits, as bytes: the form in which phrases and passages are looked for."""

from __future__ import annotations

import numpy as np

# A-Z lower-cased; every other ASCII byte than a-z and 0-9 ends a word; all other bytes belong to words
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def folded(text: bytes | None) -> bytes:
    return (text or b"").translate(FOLD)


def joined(words: list[bytes]) -> str:
    """Words with one space before, between and after them, a character for each byte."""
    return f" {b' '.join(words).decode('latin-1')} "


def spaces(line: str) -> np.ndarray:
    """Where the spaces of a joined line are; word i lies between spaces i and i + 1."""
    return np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last code point of each word in the original text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    gap = np.ones(len(raw) + 2, dtype=bool)
    gap[1:-1] = np.frombuffer(folded(text), dtype=np.uint8) == 32
    turns = np.flatnonzero(gap[1:] != gap[:-1])
    return points[turns[::2]], points[turns[1::2]]
