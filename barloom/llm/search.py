"""Ranked lexical search: the best documents of every query, over posting lists in geometric blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces
from barloom.llm.words import folded
from barloom.sources.tables import stage

GROUP_BYTES = 1 << 18  # terms of the queries that are searched in one pass
CHUNK_BYTES = 32 << 20  # dense impacts that a task works on at once
BLOCK = 16  # documents of a posting block
SKETCH = 16  # numbers that stand for a document when a list is clustered
FIRST = 4  # best blocks of a list that are scored before the others are tested again
SEED_DOCS = 20_000
NO_ID = np.iinfo(np.int64).max
MATCHES = "query long, doc_id long, score long"


def query_terms(queries: DataFrame, id_column: str) -> DataFrame:
    """``(query, item_id, terms, size)``: a number for each row, its distinct terms and their bytes."""
    kind = dict(queries.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            terms = [sorted(set(folded(t).split())) for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch({
                "query": part.column("query"), "item_id": part.column("item_id"),
                "terms": pa.array(terms, pa.list_(pa.binary())),
                "size": pa.array([sum(map(len, t)) + 8 * len(t) for t in terms], pa.int64())})

    rows = only(queries, id_column, "text").select(
        F.monotonically_increasing_id().alias("query"), F.col(id_column).alias("item_id"), "text")
    return stage(rows.mapInArrow(run, f"query long, item_id {kind}, terms array<binary>, size long"))


def _groups(asked: DataFrame) -> tuple[DataFrame, int]:
    """Queries dealt into groups of about ``GROUP_BYTES`` by a running sum, one query at the least."""
    total = asked.agg(F.sum("size")).first()[0] or 0
    if total <= GROUP_BYTES:
        return asked.withColumn("group", F.lit(0)), 1
    n = 2 * math.ceil(total / GROUP_BYTES)
    while True:
        dealt = asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(n)).cast("int"))
        sizes = dealt.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        if sizes.where((F.col("size") > GROUP_BYTES) & (F.col("n") > 1)).isEmpty() or n > 1 << 20:
            return dealt, n
        n *= 2


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: the terms of a document that some query has, numbered, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            known = vocabulary.value
            n, terms, tfs = [], [], []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                words = folded(text).split()
                n.append(len(words))
                found = [t for t in map(known.get, words) if t is not None]
                t, tf = np.unique(np.array(found, dtype=np.int32), return_counts=True)
                terms.append(t)
                tfs.append(tf)
            yield pa.record_batch({"doc_id": part.column("doc_id").cast(pa.int64()), "n": pa.array(n, pa.int64()),
                                   "terms": pa.array(terms, pa.list_(pa.int32())),
                                   "tfs": pa.array(tfs, pa.list_(pa.int64()))})

    return stage(only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>"))


class Best:
    """The best documents that each query has met so far, and the score that a new one must reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.scores = [np.zeros(0, np.int64)] * len(floors)
        self.docs = [np.zeros(0, np.int64)] * len(floors)

    def add(self, q: int, docs: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.floors[q]
        if not fit.any():
            return
        docs, scores = np.concatenate([self.docs[q], docs[fit]]), np.concatenate([self.scores[q], scores[fit]])
        order = np.lexsort((docs, -scores))[: self.k]
        self.docs[q], self.scores[q] = docs[order], scores[order]
        if len(order) == self.k:
            self.floors[q] = max(self.floors[q], scores[order[-1]])


class Chunk:
    """Some documents as a dense matrix of impacts, and the posting lists of their terms in blocks."""

    def __init__(self, docs: np.ndarray, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, size: int):
        self.docs = docs
        of = np.repeat(np.arange(len(docs)), lengths)
        self.dense = np.zeros((len(docs), size), np.int64)
        self.dense[of, terms] = impacts
        order = np.argsort(terms, kind="stable")
        self.postings, held = of[order], terms[order]
        self.firsts = np.searchsorted(held, np.arange(size + 1))
        self.peaks = self.dense.max(axis=0)
        # random projections keep angles, so documents with like impacts have like sketches
        turn = np.random.default_rng(7).standard_normal((size, SKETCH)).astype(np.float32)
        flat = self.dense.astype(np.float32) @ turn
        self.sketch = flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-20)

    def blocks(self, t: int, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A posting list in blocks of like documents: rows, the first of each block, largest impacts by coordinate.

        Members spread over the list are centres; rows are ordered by their nearest centre and cut. Of the
        coordinates only the given terms are summed up.
        """
        rows = self.postings[self.firsts[t] : self.firsts[t + 1]]
        n = -(-len(rows) // BLOCK)
        if n > 1:
            centres = self.sketch[rows[:: max(len(rows) // n, 1)][:n]]
            rows = rows[np.argsort((self.sketch[rows] @ centres.T).argmax(axis=1), kind="stable")]
        firsts = np.arange(0, len(rows), BLOCK)
        return rows, firsts, np.maximum.reduceat(self.dense[np.ix_(rows, terms)], firsts, axis=0)


def search_chunk(chunk: Chunk, queries: list[np.ndarray], best: Best) -> None:
    """Bring every document of the chunk that may belong to a query's best to ``best``.

    A document's score is at most the sum of its terms' peaks. Terms with the smallest peaks that
    together stay below the query's floor cannot lift a document by themselves, so their lists are left
    unread. In the other lists a block is skipped only where the sum of its largest impacts over the
    query's terms is below the floor; what is left is scored exactly.
    """
    asked: dict[int, list[int]] = {}
    held = []
    for q, terms in enumerate(queries):
        there = terms[chunk.peaks[terms] > 0]
        held.append(there[np.argsort(chunk.peaks[there], kind="stable")])
        for t in there:
            asked.setdefault(int(t), []).append(q)
    reach = [np.cumsum(chunk.peaks[t]) for t in held]
    place = [{int(t): i for i, t in enumerate(h)} for h in held]
    seen = np.zeros((len(queries), len(chunk.docs)), dtype=bool)
    # short lists of telling terms come first, so floors rise early
    for t in sorted(asked, key=lambda t: (-int(chunk.peaks[t]), t)):
        needed = [q for q in asked[t] if reach[q][place[q][t]] >= best.floors[q]]
        if not needed:
            continue
        terms = np.unique(np.concatenate([held[q] for q in needed]))
        rows, firsts, summary = chunk.blocks(t, terms)
        ends = np.append(firsts[1:], len(rows))
        for q in needed:
            bounds = summary[:, np.searchsorted(terms, held[q])].sum(axis=1)
            by_bound = np.argsort(-bounds, kind="stable")
            for part in (by_bound[:FIRST], by_bound[FIRST:]):
                part = part[bounds[part] >= best.floors[q]]
                if not len(part):
                    break
                found = np.concatenate([rows[firsts[b] : ends[b]] for b in part])
                found = found[~seen[q, found]]
                seen[q, found] = True
                best.add(q, chunk.docs[found], chunk.dense[np.ix_(found, held[q])].sum(axis=1))


def _impacts(weights: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n: np.ndarray, lengths: np.ndarray,
             docs: int, total: int) -> np.ndarray:
    """What each term of a document adds to its score, in 64-bit integers."""
    if int(n.max(initial=0)) * 90 * docs < 1 << 62:
        m = 10 + 90 * n * docs // total
    else:
        m = np.array([10 + 90 * int(x) * docs // total for x in n], dtype=np.int64)
    return weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, lengths)))


def _scan(vectors: DataFrame, sent, floors: np.ndarray, k: int) -> DataFrame:
    """The best documents of every query in each task, none below the query's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, docs, total = sent.value
        best = Best(floors, k)
        rows = max(CHUNK_BYTES // (8 * max(len(weights), 1)), 64)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                terms, tfs = part.column("terms"), part.column("tfs")
                lengths = np.diff(terms.offsets.to_numpy())
                n = part.column("n").to_numpy()
                ids = pa.compute.fill_null(part.column("doc_id"), NO_ID).to_numpy()
                flat = terms.flatten().to_numpy()
                impacts = _impacts(weights, flat, tfs.flatten().to_numpy(), n, lengths, docs, total)
                search_chunk(Chunk(ids, lengths, flat, impacts, len(weights)), queries, best)
        found = [len(d) for d in best.docs]
        ids = np.concatenate([*best.docs, np.zeros(0, np.int64)])
        yield pa.record_batch({"query": pa.array(np.repeat(np.arange(len(queries)), found), pa.int64()),
                               "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                               "score": pa.array(np.concatenate([*best.scores, np.zeros(0, np.int64)]), pa.int64())})

    return vectors.mapInArrow(run, MATCHES)


def _ranked(matches: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floors(vectors: DataFrame, sent, size: int, k: int, rows: int) -> np.ndarray:
    """A score that each query's last result reaches for sure: its k-th best among some documents.

    Floors decide only what is skipped; any set of documents gives the same result.
    """
    floors = np.ones(size, np.int64)
    if rows > 2 * SEED_DOCS:
        some = vectors.sample(SEED_DOCS / rows, seed=11)
        for r in _ranked(_scan(some, sent, floors, k), k).where(F.col("rank") == k).collect():
            floors[r["query"]] = max(r["score"], 1)
    return floors


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "item_id") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every query, equal scores by doc_id.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Scores are sums of
    integer impacts over a query's distinct terms; the formula stands in ``_impacts`` and in the weights
    below. Documents are tokenised once, kept as sparse vectors over the terms of the queries, and
    searched by ``search_chunk`` where they lie: only a task's best documents are shuffled, and none
    below the floors that some documents gave before. So neither a long posting list nor a group of
    copies meets in one task.

    Queries are sent to the workers in groups whose terms hold about 256 KB, each with its own pass over
    the documents; a single query must fit by itself. Every row of either table counts on its own, also
    where ids repeat; a document without an id comes after equal ones and is returned with a null. Null
    and empty texts have no terms: such documents are not counted, such queries have no rows. Only
    documents with a score above 0 are returned. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked, groups = _groups(query_terms(queries, id_column))
    parts = []
    for g in range(groups):
        # bounded by GROUP_BYTES, or one query
        rows = asked.where((F.col("group") == g) & (F.size("terms") > 0)).select("query", "item_id", "terms").collect()
        if not rows:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        vectors = _vectors(docs, spark.sparkContext.broadcast(vocabulary))
        stats = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("total"), F.count("*").alias("rows")).first()
        if not stats["docs"]:
            continue
        df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term
        weights = np.array([math.floor(1000 * math.log((2 * stats["docs"] + 2) / (2 * df.get(t, 0) + 1)))
                            for t in range(len(vocabulary))], dtype=np.int64)
        numbered = [np.array([vocabulary[bytes(t)] for t in r["terms"]]) for r in rows]
        sent = spark.sparkContext.broadcast((numbered, weights, stats["docs"], stats["total"]))
        floors = _floors(vectors, sent, len(rows), k, stats["rows"])
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      f"query long, item_id {dict(asked.dtypes)['item_id']}")
        parts.append(_ranked(_scan(vectors, sent, floors, k), k).join(names, "query")
                     .select("item_id", "rank", "doc_id", "score"))
    if not parts:
        kind = dict(asked.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
