"""Packing tokenized documents into sequences by a mixture of sources."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces
from barloom.llm.units import id_type, word_ids
from barloom.sources.tables import stage

MAX_QUEUES = 256
STAGED = "doc_id long, part int, source string, before long, n long, ids binary"
RANGED = "doc_id long, queue int, range int, before long, n long, ids binary"
PLACED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _tokenize(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        size = np.dtype(known.width).itemsize
        last = np.array([end_id], known.width).tobytes()
        task = TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for part in pieces(batches, "text"):
            before, sizes, ids = [], [], []
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, source in zip(texts, part.column("source").to_pylist(), strict=True):
                held = b"".join(map(known.__getitem__, (text or b"").split())) + last
                before.append(so_far.get(source, 0))
                sizes.append(len(held) // size)
                so_far[source] = before[-1] + sizes[-1]
                ids.append(held)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"), "part": pa.array([task] * len(ids), pa.int32()),
                "source": part.column("source"), "before": pa.array(before, pa.int64()),
                "n": pa.array(sizes, pa.int64()), "ids": pa.array(ids, pa.binary())})
    return run


class Rounds:
    """Where the tokens of every queue lie in the one line of tokens that sequences are cut from.

    Deficit round-robin: in each round, a window of tokens, every queue gets its share of the window;
    what a share leaves below a whole token is its deficit and is carried on. After round r a queue has
    served ``floor(r * window * share)`` tokens, or all it has, so any round is found without its
    predecessors. Queues that have run out leave their place in a window to the others.
    """

    def __init__(self, sizes: list[int], shares: list[Fraction], window: int):
        self.sizes, self.window = sizes, window
        self.quanta = [(window * s.numerator, s.denominator) for s in shares]
        self.known: dict[int, tuple[list[int], int]] = {}

    def served(self, r: int) -> tuple[list[int], int]:
        """Tokens that each queue has served before round r, and their sum."""
        if r not in self.known:
            if len(self.known) > 64:
                self.known.clear()
            each = [min(t, r * q // d) for t, (q, d) in zip(self.sizes, self.quanta, strict=True)]
            self.known[r] = each, sum(each)
        return self.known[r]

    def runs(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """``(start, length, place in the line)`` of the stretches into which rounds cut tokens of a queue."""
        q, d = self.quanta[queue]
        stop = start + length
        r = start * d // q
        while start < stop:
            while self.served(r + 1)[0][queue] <= start:
                r += 1
            (now, total), (then, _) = self.served(r), self.served(r + 1)
            size = min(stop, then[queue]) - start
            turn = total + sum(then[:queue]) - sum(now[:queue])
            yield start, size, turn + start - now[queue]
            start += size


def _mixed(tail: DataFrame) -> DataFrame:
    """The documents of the shared queue with their places in it, each of its sources spread over all of it.

    A document stands where its source has got to, as a fraction of the source's tokens. The fraction is
    taken at a point within the document that the source's hash sets, or small sources would all begin, or
    end, at once. Ranges of the order are stored with sums from their start; one sum for each range gives
    the places.
    """
    point = F.pmod(F.xxhash64("source"), F.lit(1 << 32)) / F.lit(1 << 32)
    line = ["reached", "source", "first"]
    ranges = stage(
        tail.withColumn("reached", (F.col("first") + point * F.col("n")) / F.col("all"))
        .repartitionByRange(*line).sortWithinPartitions(*line)
        .select("doc_id", "queue", "n", "ids").mapInArrow(_sums, RANGED))
    sums = ranges.groupBy("queue", "range").agg(F.sum("n").alias("held"))
    order = Window.partitionBy("queue").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("range", F.coalesce(F.sum("held").over(order), F.lit(0)).alias("ahead"))
    return ranges.join(ahead, "range").select("doc_id", "queue", (F.col("ahead") + F.col("before")).alias("first"), "n", "ids")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their range and the tokens before them in it."""
    task, so_far = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        before = so_far + np.cumsum(n) - n
        so_far += int(n.sum())
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "queue": batch.column("queue"),
            "range": pa.array(np.full(len(n), task, np.int32)), "before": pa.array(before, pa.int64()),
            "n": batch.column("n"), "ids": batch.column("ids")})


def _place(rounds: Rounds, sequence: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "ids", 1 << 19):
            out: list[list] = [[] for _ in range(7)]
            columns = [part.column(c).to_pylist() for c in ("doc_id", "queue", "first", "n", "ids")]
            for doc, queue, first, n, packed in zip(*columns, strict=True):
                ids = np.frombuffer(packed, width).astype("<u4").tobytes()
                pieces_of: list[list[int]] = []
                for start, size, at in rounds.runs(queue, first, n):
                    while size:
                        length = min(size, sequence - at % sequence)
                        if pieces_of and sum(pieces_of[-1][1:]) == at and at % sequence:
                            pieces_of[-1][2] += length  # the next round goes on where the last one ended
                        else:
                            pieces_of.append([start - first, at, length])
                        start, size, at = start + length, size - length, at + length
                for start, at, length in pieces_of:
                    row = (doc, start, length, n, at // sequence, at % sequence, ids[4 * start : 4 * (start + length)])
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = [f.split()[0] for f in PLACED.split(", ")]
            yield pa.record_batch({name: pa.array(v, k) for name, v, k in zip(names, out, kinds, strict=True)})
    return run


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = 4096, end_id: int = 2, window: int = 1 << 18,
         shares: dict[str, float] | None = None) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    A document's tokens are those of its whole text and ``end_id``. Each source is a queue of documents.
    The queues are laid into one line of tokens by deficit round-robin (``Rounds``): every window of
    ``window`` tokens holds the sources in the target proportions, deficits carried from window to
    window and, as positions follow from sums, from partition to partition. The line is cut every
    ``sequence`` tokens: each token lies in exactly one piece, every sequence but the last is full, and
    pieces of a sequence follow each other without gaps. ``ids`` are little-endian unsigned 32-bit.

    ``shares`` gives target proportions by source (a source that it lacks gets its natural one, None names
    the null source; a source without rows has nothing to place); by default a source has the proportion
    that it has in all tokens, and all queues end together. Every source in ``shares`` has a queue, and so
    have the ``MAX_QUEUES - 1`` largest others. Those that are left share one, in which each source is
    spread evenly (``_mixed``): a window holds each in its natural proportion, to within a document.

    Tokens are made once and stored; places are found from one sum for each partition and source, and for
    the shared queue for each range of it, so no task holds a queue, however large.

    A null or empty text has the one token ``end_id``; a null source is a source; a null doc_id stays
    null; repeated rows are packed each; other columns are ignored. No rows give no pieces.
    """
    spark, width = docs.sparkSession, id_type(tokenizer_path)
    chosen = only(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("source"))
    tokens = stage(chosen.mapInArrow(_tokenize(tokenizer_path, end_id), STAGED))

    parts = stage(tokens.groupBy("part", "source").agg(F.sum("n").alias("n")))
    by_source = parts.groupBy("source").agg(F.sum("n").alias("n"))
    wanted = {"null" if k is None else f"={k}": Fraction(v).limit_denominator(10**6) or Fraction(v)
              for k, v in (shares or {}).items()}
    if any(w <= 0 for w in wanted.values()):
        raise ValueError("every source needs a positive share, as all its documents are packed")
    named = F.col("source").isin(list(wanted))
    own = by_source.where(named).orderBy("source").collect() if wanted else []
    own += by_source.where(~named).orderBy(F.desc("n"), "source").limit(MAX_QUEUES - 1).collect()
    total = by_source.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names, sizes = [r["source"] for r in own], [r["n"] for r in own]
    rest = len(names)
    if sum(sizes) < total:
        names, sizes = [*names, None], [*sizes, total - sum(sizes)]
    weights = [wanted.get(name) or Fraction(size, total) for name, size in zip(names, sizes, strict=True)]
    sent = spark.sparkContext.broadcast(Rounds(sizes, [w / sum(weights) for w in weights], window))

    queue = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(names[:rest]) for x in (name, i)]),
                         F.col("source")) if rest else F.lit(None)
    of_source = Window.partitionBy("source")
    order = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(parts.select(
        "part", "source", F.coalesce(queue, F.lit(rest)).cast("int").alias("queue"),
        F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ahead"), F.sum("n").over(of_source).alias("all")))
    where = (F.col("ahead") + F.col("before")).alias("first")
    placed = tokens.join(offsets.where(F.col("queue") < rest), ["part", "source"]).select(
        "doc_id", "queue", where, "n", "ids")
    if len(names) > rest:
        placed = placed.unionByName(_mixed(tokens.join(offsets.where(F.col("queue") == rest), ["part", "source"]).select(
            "doc_id", "source", "queue", where, "n", "ids", "all")))

    def run(batches):
        return _place(sent.value, sequence, width)(batches)

    return placed.mapInArrow(run, PLACED)
