"""Counting tokens of texts of any length."""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces
from barloom.llm.units import Units, load, units

CHUNK = 1 << 14
OVERLAP = 1 << 8
AGREE = 3


def whole_strings(tokenizer) -> tuple[str, ...] | None:
    """The strings that a tokenizer takes out of a text whole, if it splits the rest by kinds of characters; else None.

    It does so where it is byte-level with its own pattern, changes nothing beforehand, and takes added tokens as
    they stand. The pattern's words are runs of letters, of digits or of other characters, each with at most one
    space before it; endings such as ``'s``, an apostrophe and letters; and runs of white space.
    """
    how = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    added = tokenizer.get_added_tokens_decoder().values()
    if how.get("type") != "ByteLevel" or not how.get("use_regex", True) or how.get("add_prefix_space") or tokenizer.normalizer:
        return None
    if any(t.lstrip or t.rstrip or t.single_word for t in added):
        return None
    return tuple(t.content for t in added)


@functools.lru_cache(1 << 13)
def _kind(c: str) -> str:
    """L, N, S or O: letter, number, white space or other; empty where versions of Unicode may not agree."""
    if c in " \t\n\r\u3000":
        return "S"
    now, old = unicodedata.category(c)[0], unicodedata.ucd_3_2_0.category(c)[0]
    if now != old or now == "Z" or c.isspace() or unicodedata.ucd_3_2_0.category(c) == "Cn":
        return ""
    return now if now in "LN" else "O"


def _is_cut(text: str, at: int, whole: tuple[str, ...] | None = None) -> bool:
    """Whether no token can reach over ``at``, whatever stands before and after.

    At a single space between two other characters the word before has ended, as words hold no white
    space, and the space belongs to the word after it.

    Where the tokenizer splits by kinds (``whole`` from ``whole_strings``), a word ends wherever the kind changes, but for
    white space, which may begin the next word, and an apostrophe, whose ending may follow. The pattern looks
    ahead past white space alone, and never back, so what is before such a place does not depend on what follows
    it, nor the other way round. A string that is taken whole must not reach over the place.
    """
    if text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace():
        return True
    if whole is None:
        return False
    before, after = _kind(text[at - 1]), _kind(text[at])
    if not before or not after or before == "S" or before == after or (text[at - 1] == "'" and after == "L"):
        return False
    return not any(s in text[max(0, at - len(s) + 1) : at + len(s) - 1] for s in whole)


def count_plain(text: str, spaced: Units) -> int | None:
    """Tokens of a chunk as the sum over its words, or None where white space is not that simple.

    Words are taken with the one space before them; a line feed between two words is a token.
    """
    total = 0
    lines = text.split("\n")
    for line in lines:
        words = line.split(" ")
        for i, w in enumerate(words):
            if not w or w[0].isspace() or w[-1].isspace():
                return None
            total += spaced[f" {w}" if i else w]
    return total + (len(lines) - 1) * spaced["\n"]


def count_long(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, whole: tuple[str, ...] | None = None) -> int:
    """Tokens of a long text from overlapping chunks.

    Each chunk is encoded with offsets. Two neighbours are spliced at a place inside their overlap where
    both have a token boundary, their next tokens agree, and no token can reach over it in any context;
    what is before it is counted from the first chunk, the rest from the second. Without such a place
    the overlap is doubled, up to the whole text. ``whole`` comes from ``whole_strings``; with it such a place
    is missing only from runs of one kind of character, such as letters without any space or punctuation.
    """
    def encoded(a: int, b: int) -> tuple[list[int], list[int]]:
        e = tokenizer.encode(text[a:b], add_special_tokens=False)
        return [a + o[0] for o in e.offsets], e.ids

    total, origin, size = 0, 0, len(text)
    end = min(size, chunk + overlap)
    starts, ids = encoded(0, end)
    counted = 0  # tokens of the current chunk that lie before the last splice
    while end < size:
        reach = end - origin
        begin = max(origin + 1, end - min(overlap, reach))
        widened = overlap
        while True:
            later_end = min(size, begin + chunk + overlap)
            later_starts, later_ids = encoded(begin, later_end)
            place = _splice(text, starts, ids, later_starts, later_ids, begin, end, counted, whole)
            if place or begin <= origin + 1:
                break
            widened *= 2
            begin = max(origin + 1, end - widened)
        if place is None:  # no chunk of this reach agrees: take a longer first chunk
            end = min(size, end + chunk + widened)
            before = starts[counted] if counted < len(starts) else origin
            starts, ids = encoded(before, end)
            counted, origin = 0, before
            continue
        first, later = place
        total += first - counted
        starts, ids, counted, origin, end = later_starts, later_ids, later, begin, later_end
    return total + len(ids) - counted


def _splice(text, starts, ids, later_starts, later_ids, begin, end, counted, whole=None) -> tuple[int, int] | None:
    """Token numbers in both chunks at the first common stable boundary."""
    places = {s: j for j, s in reversed(list(enumerate(later_starts))) if s < end}
    for i in range(counted, len(starts)):
        at = starts[i]
        if at <= begin or at + 1 >= end or at not in places or not _is_cut(text, at, whole):
            continue
        j = places[at]
        span = min(AGREE, len(ids) - i - 1, len(later_ids) - j)  # the first chunk's last token may be cut off
        if ids[i : i + span] == later_ids[j : j + span]:
            return i, j
    return None


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row.

    Token counts are those of the tokenizer over the whole text, without added tokens, truncation or
    padding; the strings of special tokens inside a text count as the tokenizer's default has it.

    Texts of more than ``CHUNK`` characters are encoded in overlapping chunks and spliced (see
    ``count_long``), so memory is bounded by the chunk and the longest run without a stable boundary, not by the text:
    with a byte-level tokenizer a run of one kind of character, else one without single spaces. A text of one chunk is counted
    word by word from a cache, exactly where its white space is single spaces and line feeds between
    words, and else encoded as it is. One pass, no shuffle. ``tokenizer_path`` is read on the workers.

    A null or empty text has no bytes and no tokens. A null doc_id stays null; repeated rows are counted
    each; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_path)
        spaced, whole = units(tokenizer_path, "counts", len, False), whole_strings(tokenizer)
        for part in pieces(batches, "text"):
            sizes, counts = [], []
            for text in part.column("text").to_pylist():
                text = text or ""
                sizes.append(len(text.encode()))
                n = count_long(text, tokenizer, whole=whole) if len(text) > CHUNK else count_plain(text, spaced) if text else 0
                counts.append(len(tokenizer.encode(text, add_special_tokens=False).ids) if n is None else n)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
                                   "n_tokens": pa.array(counts, pa.int64())})

    chosen = only(docs, "doc_id", "text")
    return (chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
