"""Hard negatives of embeddings: a vertical scan over columnar blocks that shrinks candidates by bounds."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import only
from barloom.sources.tables import stage

ROWS = 4096  # rows of a block
ANCHORS = 256  # anchors of a block
LANE_BYTES = 32 << 20  # components that a task holds of rows, and of anchors
HELD = 2  # bytes of a component in a block, unless it is large
STEP = 8  # dimensions read between two cuts
EXACT = float(1 << 53)  # integers up to here are exact in doubles
LARGEST = float(1 << 62)
NO_ID = np.iinfo(np.int64).max
NO_FLOOR = -(1 << 62)
SEED_SHARE = 16
BLOCKS = "dim long, n long, ids binary, labels binary, rows binary, columns binary"
HITS = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, row long, id long, score long"


def quantised(vectors: DataFrame, anchor: Column, label: Column) -> DataFrame:
    """``(row, vec_id, label, anchor, x)``: a number for each row that takes part, and its integer components."""
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = only(vectors, "vec_id", "embedding", "label").where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    return stage(rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("x")))


def _packer(size: int, extra: tuple[str, ...] = ()) -> Callable:
    """Rows into blocks of at most ``size`` of one dimension, their components column by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pa.compute.list_value_length(batch.column("x")).to_numpy()
            for dim in np.unique(dims):
                of_dim = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for at in range(0, of_dim.num_rows, size):
                    part = of_dim.slice(at, size)
                    n = part.num_rows
                    x = np.floor(256.0 * part.column("x").flatten().to_numpy().reshape(n, dim)).T
                    if x.size and np.abs(x).max() >= EXACT:
                        raise ValueError("a component is too large for 64-bit scores")
                    kind = np.int16 if not x.size or np.abs(x).max() < 32_000 else np.int64
                    ids = pa.compute.fill_null(part.column("vec_id"), NO_ID).to_numpy()
                    made = {"dim": [int(dim)], "n": [n], "ids": [ids.tobytes()],
                            "labels": [part.column("label").to_numpy().tobytes()],
                            "rows": [part.column("row").to_numpy().tobytes()],
                            "columns": [np.ascontiguousarray(x, dtype=kind).tobytes()]}
                    yield pa.record_batch({k: pa.array(v, pa.int64() if k in ("dim", "n") else pa.binary())
                                           for k, v in made.items()} | {
                        c: pa.array([part.column(c).to_pylist()], pa.list_(pa.list_(pa.list_(pa.int64())))) for c in extra})

    return run


class Block:
    """A block in memory: ids, labels, row numbers and components by dimension."""

    def __init__(self, row: dict):
        self.ids, self.labels, self.rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "rows"))
        kind = np.int64 if len(row["columns"]) == 8 * row["dim"] * row["n"] else np.int16
        self.columns = np.frombuffer(row["columns"], kind).reshape(row["dim"], row["n"]).astype(np.float64)
        self.low = self.columns.min(axis=1, initial=np.inf)
        self.high = self.columns.max(axis=1, initial=-np.inf)


def vertical_scan(block: Block, q: np.ndarray, alive: np.ndarray,
                  cut: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that no bound ruled out, with their exact scores.

    Dimensions are read in descending magnitude of the anchor, ``STEP`` at a time and for the remaining
    candidates alone. What the unread dimensions can still add lies between sums of their least and
    largest contributions, taken from each dimension's extremes in the block; ``cut`` gets the candidates'
    lower and upper bounds and says which stay.
    """
    order = np.argsort(-np.abs(q), kind="stable")
    if not len(alive):
        return alive, np.zeros(0, np.int64)
    ends = np.stack([q * block.low, q * block.high])[:, order]
    if np.abs(ends).max(axis=0, initial=0).sum() >= EXACT:
        exact = [sum(int(a) * int(b) for a, b in zip(q, block.columns[:, i], strict=True)) for i in alive]
        if any(abs(s) >= LARGEST for s in exact):
            raise ValueError("a score does not fit 64 bits")
        return alive, np.array(exact, dtype=np.int64)
    least, most = (np.append(np.cumsum(e[::-1])[::-1], 0.0) for e in (ends.min(axis=0), ends.max(axis=0)))
    scores = np.zeros(len(alive))
    for at in range(0, len(order), STEP):
        dims = order[at : at + STEP]
        columns = block.columns[dims]
        # a few dimensions of all rows are read sooner than those of most rows are picked out
        scores += (q[dims] @ columns)[alive] if 4 * len(alive) > columns.shape[1] else q[dims] @ columns[:, alive]
        done = min(at + STEP, len(order))
        if done < len(order):
            stay = cut(scores + least[done], scores + most[done])
            if not stay.all():
                alive, scores = alive[stay], scores[stay]
                if not len(alive):
                    break
    return alive, scores.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best, equal scores by id."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= _kth(scores, k))
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def nearest_alike(block: Block, a: dict, k: int) -> Iterator[tuple]:
    """The anchor's best rows of its own label in the block."""
    floor = a["limits"][0][0] if a["limits"] else -np.inf
    alive = np.flatnonzero((block.labels == a["label"]) & (block.rows != a["row"]))

    def cut(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= max(floor, _kth(lower, k))

    alive, scores = vertical_scan(block, a["q"], alive, cut)
    for i in _first(scores, block.ids[alive], k):
        if scores[i] >= floor:
            yield a["row"], a["id"], 0, None, None, block.rows[alive[i]], block.ids[alive[i]], scores[i]


def hard_unlike(block: Block, a: dict, k: int) -> Iterator[tuple]:
    """For each of the anchor's positives, the best rows of other labels in its window in the block.

    ``limits`` holds (positive, positive_id, positive_score, low, high, floor).
    """
    limits = [w for w in a["limits"] if w[3] <= w[4]]
    if not limits:
        return
    alive = np.flatnonzero(block.labels != a["label"])

    # with a floor for each positive, one range that spans all windows cuts as much and is looked at once
    bottom, top = min(max(w[3], w[5]) for w in limits), max(w[4] for w in limits)
    floored = all(w[5] > NO_FLOOR for w in limits)

    def cut(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if floored:
            return (upper >= bottom) & (lower <= top)
        stay = np.zeros(len(lower), dtype=bool)
        for _, _, _, low, high, floor in limits:
            sure = lower[(lower >= low) & (upper <= high)]
            stay |= (upper >= max(low, floor, _kth(sure, k))) & (lower <= high)
        return stay

    alive, scores = vertical_scan(block, a["q"], alive, cut)
    for positive, positive_id, positive_score, low, high, floor in limits:
        inside = np.flatnonzero((scores >= max(low, floor)) & (scores <= high))
        for i in inside[_first(scores[inside], block.ids[alive[inside]], k)]:
            yield (a["row"], a["id"], positive, positive_id, positive_score,
                   block.rows[alive[i]], block.ids[alive[i]], scores[i])


def _dealt(spark: SparkSession, blocks: int, rows: int, anchors: int, components: tuple[int, int]) -> tuple[int, int]:
    """Numbers of lanes, which share the blocks of rows, and of crews, which share those of anchors.

    Every lane meets every crew, so rows are moved once a crew and anchors once a lane. There are about as many pairs
    as the session has partitions, dealt so that least is moved, and at least so many that a lane's or a crew's
    ``components`` in all stay under ``LANE_BYTES``.
    """
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    crews = max(round(math.sqrt(tasks * anchors / max(rows, 1))), -(-HELD * components[1] // LANE_BYTES))
    crews = max(min(crews, -(-anchors // ANCHORS)), 1)
    return max(min(max(-(-tasks // crews), -(-HELD * components[0] // LANE_BYTES)), blocks), 1), crews


def _scan(blocks: DataFrame, anchors: DataFrame, lanes: int, crews: int, search: Callable, k: int) -> DataFrame:
    """``search`` for every anchor of every block pair of one dimension.

    Blocks of rows are dealt to lanes and blocks of anchors to crews; a task scans the blocks of a lane for a crew,
    one after the other, whatever ids or labels they hold. Both are grouped by lane and crew and not joined, so
    no session takes the anchors of all lanes for a small table to broadcast, and no block is repeated for each
    block of anchors.
    """

    def run(rows: pa.Table, asking: pa.Table) -> pa.Table:
        out = [pa.schema([(c.split()[0], pa.int64()) for c in HITS.split(", ")]).empty_table()]
        for i in range(rows.num_rows if asking.num_rows else 0):
            block = Block({c: rows.column(c)[i].as_py() for c in rows.column_names})
            block.low, block.high = (np.where(np.isfinite(e), e, 0.0) for e in (block.low, block.high))
            for at in range(asking.num_rows):
                row = {c: asking.column(c)[at].as_py() for c in asking.column_names}
                asked = Block(row)
                found = [hit for j in range(row["n"]) for hit in search(block, {
                    "q": asked.columns[:, j], "row": asked.rows[j], "id": asked.ids[j], "label": asked.labels[j],
                    "limits": row["limits"][j]}, k)]
                if found:
                    columns = [pa.array([None if v is None else int(v) for v in c], pa.int64())
                               for c in zip(*found, strict=True)]
                    out.append(pa.table(columns, names=out[0].column_names))
        return pa.concat_tables(out)

    def met(frame: DataFrame, own: str, by: str, n: int, other: str, m: int) -> DataFrame:
        """Each block in a share of its own kind and in all of the other's; a number of partitions is named, as
        the blocks' bytes do not tell the time that they take."""
        return (frame.withColumn(own, F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
                .repartition(lanes * crews, "lane", "crew", "dim").groupBy("lane", "crew", "dim"))

    return (met(blocks, "lane", "block", lanes, "crew", crews)
            .cogroup(met(anchors, "crew", "rows", crews, "lane", lanes)).applyInArrow(run, HITS))


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    Components x become floor(256 x); a score is the integer inner product with the anchor. An anchor's
    positives are its ``positives`` best other rows of the same label; the negatives of a positive are the
    ``negatives`` best rows of other labels whose score is within ``window`` percent of the positive's, which
    holds for none if that is negative. Higher scores come first, equal ones by vec_id, then by input row.
    ``anchor`` and ``label`` are expressions over vec_id and label.

    Rows become columnar blocks and every block of anchors is scanned against every block of rows, by
    dimension, with candidates dropped as soon as bounds exclude them (``vertical_scan``). A first scan over a
    sixteenth of the blocks gives each anchor floors that its last result reaches for sure, so the whole
    scan passes on few rows besides the results. Work is anchors times rows at the worst; a task holds the
    blocks of a lane and of a crew of anchors (``_dealt``), and no table of blocks goes through the driver.

    Rows with a null label or vector, or any null or non-finite component take no part. Vectors of different
    lengths are not compared. A null vec_id is no anchor by a comparison with null, but may be a result,
    after equal ones, as null. Rows that repeat a vec_id count each. No rows give none. Scores that do
    not fit 64 bits raise.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, anchor, label)
    blocks = stage(rows.mapInArrow(_packer(ROWS), BLOCKS)
                   .withColumn("block", F.monotonically_increasing_id())
                   .withColumn("share", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(SEED_SHARE)).cast("int")))
    asked = stage(rows.where("anchor").drop("anchor"))
    n_blocks, n_rows, size = (v or 0 for v in blocks.agg(F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("dim"))).first())
    n_asked, asked_size = (v or 0 for v in asked.agg(F.count("*"), F.sum(F.size("x"))).first())
    parts = max(-(-n_asked // ANCHORS), 1)
    every = _dealt(spark, n_blocks, n_rows, n_asked, (size, asked_size))
    few = _dealt(spark, -(-n_blocks // SEED_SHARE), n_rows // SEED_SHARE, n_asked, (size // SEED_SHARE, asked_size))

    def packed(limits: DataFrame | None) -> DataFrame:
        """Anchors in blocks, each with its limits."""
        if limits is None:
            held = asked.withColumn("limits", F.array().cast("array<array<long>>"))
        else:
            held = asked.join(limits.withColumnRenamed("anchor", "row"), "row", "left").withColumn(
                "limits", F.coalesce("limits", F.array().cast("array<array<long>>")))
        return stage(held.repartition(parts).mapInArrow(
            _packer(ANCHORS, ("limits",)), f"{BLOCKS}, limits array<array<array<long>>>"))

    def found(limits: DataFrame | None, search: Callable, k: int, with_floors: Callable) -> DataFrame:
        anchors = packed(limits)
        if n_blocks > 2 * SEED_SHARE:
            some = _best(_scan(blocks.where("share = 0"), anchors, *few, search, k), k).where(F.col("rank") == k)
            anchors = packed(with_floors(limits, some.select("anchor", "positive", F.col("score").alias("floor"))))
        return stage(_best(_scan(blocks, anchors, *every, search, k), k))

    alike = found(None, nearest_alike, positives, lambda _, floors: floors.groupBy("anchor").agg(
        F.array(F.array(F.max("floor"))).alias("limits")))

    low, high = window
    windows = stage(alike.select(
        "anchor", F.col("rank").cast("long").alias("positive"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")).withColumns({
            # in whole numbers: the least n with low * score <= 100 n, and the largest with 100 n <= high * score
            "low": F.expr(f"(positive_score * {low} + 99 - pmod(positive_score * {low} + 99, 100)) div 100"),
            "high": F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100")}))
    none = F.lit(NO_FLOOR)

    def limits_of(frame: DataFrame, floor: Column) -> DataFrame:
        return frame.groupBy("anchor").agg(F.collect_list(F.array(
            "positive", "positive_id", "positive_score", "low", "high", floor)).alias("limits"))

    unlike = found(limits_of(windows, none), hard_unlike, negatives, lambda _, floors: limits_of(
        windows.join(floors, ["anchor", "positive"], "left"), F.coalesce("floor", none)))

    def as_id(name: str) -> Column:
        return F.when(F.col(name) != F.lit(NO_ID), F.col(name))

    return unlike.select(as_id("anchor_id").alias("anchor_id"), as_id("positive_id").alias("positive_id"), "rank",
                         as_id("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
