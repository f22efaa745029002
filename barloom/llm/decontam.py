"""Finding benchmark passages in documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces, worker_cache
from barloom.llm.words import folded, joined, spaces, word_offsets

MAX_BENCHMARK_BYTES = 64 << 20

RESULT = ("n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>")


def windows(items: list[tuple[str, bytes]], width: int) -> list[tuple[str, int, tuple[int, ...]]]:
    """``(line, words, item numbers)`` for every distinct window of the items."""
    found: dict[str, set[int]] = {}
    for number, (_, text) in enumerate(items):
        words = folded(text).split()
        for i in range(max(1, len(words) - width + 1) if words else 0):
            found.setdefault(joined(words[i : i + width]), set()).add(number)
    return [(line, line.count(" ") - 1, tuple(sorted(numbers))) for line, numbers in found.items()]


def _automaton(patterns) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for line, size, numbers in patterns:
        out.add_word(line, (len(line), size, numbers))
    if patterns:
        out.make_automaton()
    return out


def _scan(text: bytes | None, auto: ahocorasick.Automaton, names: list[str]):
    words = folded(text).split()
    line = joined(words)
    ends, items = [], set()
    for end, (chars, size, numbers) in auto.iter(line) if len(auto) else ():
        ends.append((end - chars + 1, size))
        items.update(numbers)
    if not ends:
        return len(words), 0, [], []
    first = np.searchsorted(spaces(line), [e[0] for e in ends])
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + np.array([e[1] for e in ends]), -1)
    hit = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    starts, stops = word_offsets(text)
    spans = [{"start": int(starts[a]), "end": int(stops[b - 1])} for a, b in zip(turns[::2], turns[1::2], strict=True)]
    return len(words), int(hit.sum()), sorted({names[i] for i in items}), spans


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = 13, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` of each row.

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased. A window
    is ``width`` consecutive words of a benchmark text, or the whole text if it has fewer words but
    not none. ``n_hit`` counts the document's words that lie in any occurrence of a window, ``items``
    are the item_ids with occurring windows, as sorted texts, and ``spans`` the hit passages as code
    points of the original text. ``contaminated``: at least one word and a twentieth of them are hit.

    All windows form one Aho-Corasick automaton, built once in each Python worker; every text is
    scanned once, whole, with no shuffle. The benchmark is broadcast: it must have at most
    ``MAX_BENCHMARK_BYTES`` of text, which is checked. Items of one id count as one; a null item_id is
    named by the empty text. Null and empty texts have no words. A null doc_id stays null, repeated rows
    are scanned each, and other columns than doc_id, text and ``keep`` are ignored.
    """
    items = only(benchmark, "item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes of text; one automaton takes {MAX_BENCHMARK_BYTES}")
    rows = [("" if i is None else str(i), (t or "").encode()) for i, t in items.distinct().collect()]
    names = [n for n, _ in rows]
    sent = docs.sparkSession.sparkContext.broadcast(windows(rows, width))
    key = f"automaton {hashlib.md5(repr(sorted(rows)).encode()).hexdigest()} {width}"
    names_sent = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("benchmark")
        if key not in cache:
            cache[key] = _automaton(sent.value), names_sent.value
        auto, held = cache[key]
        for part in pieces(batches, "text"):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            found = [_scan(t, auto, held) for t in texts]
            out = {c: part.column(c) for c in ("doc_id", *keep)}
            out["n_words"] = pa.array([f[0] for f in found], pa.int64())
            out["n_hit"] = pa.array([f[1] for f in found], pa.int64())
            out["items"] = pa.array([f[2] for f in found], pa.list_(pa.string()))
            out["spans"] = pa.array([f[3] for f in found], pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.record_batch(out)

    chosen = only(docs, *dict.fromkeys(("doc_id", "text", *keep)))
    schema = ", ".join(f"`{c}` {t}" for c, t in chosen.dtypes if c == "doc_id" or c in keep)
    return (chosen.mapInArrow(run, f"{schema}, {RESULT}")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
