"""Similarity join of documents over their sets of word n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, only, pieces
from barloom.llm.graph import components
from barloom.llm.shingles import set_identity, shingle_sets
from barloom.sources.tables import stage

MOST_BITS = 25  # binary digits of a bit's number in the bitmaps that choose columns and texts: 4 MB
SPARSE = 16  # documents of a column whose pairs are counted one by one
TILE_ROWS, TILE_GRAMS = 1024, 1 << 20  # of one block of a tile, about
COLUMNS = 2048  # multiplied at once


def bounds(n: int, least: Fraction) -> tuple[int, int, int, int]:
    """``(width, shared, dropped, fewest)`` for a set of ``n`` n-grams and a smallest Jaccard similarity.

    A partner shares at least ``need = ceil(least * n)`` n-grams with it. So two partners' first
    ``n - need + shared`` n-grams, in one order for all documents, have ``shared`` or more in common:
    this is the block of columns that is multiplied first. Of it, a document may leave out its
    ``dropped`` most frequent columns: fewer than any partner must share. It then still shares
    ``fewest`` columns or more with any partner.
    """
    def need(m: int) -> int:
        return -(-least.numerator * m // least.denominator)

    def shared(m: int) -> int:
        return min(need(m), 1 + (m - need(m) + 1) // 2)

    def dropped(m: int) -> int:
        return (shared(need(m)) - 1) // 2

    largest = n * least.denominator // least.numerator
    return n - need(n) + shared(n), shared(n), dropped(n), max(1, shared(need(n)) - dropped(largest))


def _first_block(k: int, least: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), k)
            ids = [set_identity(s) for s in sets]
            facts = [bounds(len(s), least) for s in sets]
            firsts = [s[: f[0]] for s, f in zip(sets, facts, strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in firsts])]).astype(np.int32)
            flat = np.concatenate(firsts).view(np.int64)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "id1": pa.array([i[0] for i in ids], pa.int64()),
                "id2": pa.array([i[1] for i in ids], pa.int64()),
                "shared": pa.array([f[1] for f in facts], pa.int32()),
                "dropped": pa.array([f[2] for f in facts], pa.int32()),
                "fewest": pa.array([f[3] for f in facts], pa.int32()),
                "grams": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            })
    return run


def _whole_rows(k: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for part in pieces(batches, "text"):
            # a null doc_id has a hash like any other
            part = part.filter(pa.array(_is_set(bits, part.column("bit").to_numpy())))
            if not part.num_rows:
                continue
            sets = shingle_sets(part.column("text").to_pylist(), k)
            ids = [set_identity(s) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"),
                "id1": pa.array([i[0] for i in ids], pa.int64()),
                "id2": pa.array([i[1] for i in ids], pa.int64()),
                "grams": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))),
            })
    return run


def _bits_for(members: int) -> int:
    """Size of a bitmap: 16 bits for each member while that is within ``MOST_BITS``."""
    return 1 << min(max(16 * members, 1 << 16).bit_length(), MOST_BITS)


def _bitmap(bits: DataFrame, size: int) -> np.ndarray:
    """The bits set in a column ``bit``, as ``size / 64`` words; they are put together in Spark."""
    words = (bits.groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("value")).toArrow())  # size / 64 rows at the most
    out = np.zeros(size >> 6, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("value").to_numpy()
    return out


def _is_set(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 6] >> (bits & 63)) & 1 == 1


def _likely(rows: DataFrame, dense: DataFrame) -> DataFrame:
    """``(doc_id, grams)`` without most of the n-grams that no other document has.

    A bitmap over hashes of the columns that several documents have is broadcast; it spares the other n-grams
    the shuffle. The join after it is exact.
    """
    size = _bits_for(dense.count())
    bits = _bitmap(dense.select(F.col("gram").bitwiseAND(F.lit(size - 1)).alias("bit")), size)
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("grams")
            flat = grams.flatten().to_numpy()
            stays = _is_set(sent.value, flat & (size - 1))
            ends = np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], np.cumsum(pa.compute.list_value_length(grams).to_numpy())])]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "grams": pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(flat[stays]))})

    return rows.select("doc_id", "grams").mapInArrow(run, "doc_id long, grams array<long>")


def _of_documents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose documents are wanted, and some others, by a bitmap over hashed doc_ids; for a join after it."""
    size = _bits_for(4 * wanted.count())
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    sent = rows.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(bit.alias("bit")), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = _is_set(sent.value, batch.column("bit").to_numpy())
            yield batch.filter(pa.array(stays)).select(["doc_id", "grams"])

    return rows.select("doc_id", "grams", bit.alias("bit")).mapInArrow(run, "doc_id long, grams array<long>")


def _rows_of(wanted: DataFrame, reps: DataFrame, docs: DataFrame, k: int, unique: bool) -> DataFrame:
    """Whole incidence rows ``(doc_id, grams)`` of the wanted documents, and of a few others.

    A bitmap over hashed doc_ids, broadcast, spares most other texts the work and all texts the shuffle. Joins
    by doc_id leave the others out. Where doc_ids repeat, an exact join keeps one row of equal ones.
    """
    wanted = stage(wanted.distinct().join(reps.select("doc_id", "id1", "id2"), "doc_id"))
    size = _bits_for(4 * wanted.count())
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(bit.alias("bit")), size))
    rows = docs.withColumn("bit", bit).mapInArrow(
        _whole_rows(k, sent), "doc_id long, id1 long, id2 long, grams array<long>")
    if not unique:
        rows = rows.dropDuplicates(["doc_id", "id1", "id2"]).join(wanted, ["doc_id", "id1", "id2"], "left_semi")
    return stage(rows.select("doc_id", "grams"))


def _overlaps(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and overlap counts of a tile's rows: the product of its incidence rows, columns in blocks, added up."""
    parts = [np.asarray(g) for g in tile.column("grams").combine_chunks().to_numpy(zero_copy_only=False)]
    sizes = np.array([len(g) for g in parts])
    grams, column = np.unique(np.concatenate(parts), return_inverse=True)
    row = np.repeat(np.arange(len(parts)), sizes)
    held = np.bincount(column, minlength=len(grams)) > 1  # other columns make no product
    number = np.cumsum(held) - 1
    row, column = row[held[column]], number[column[held[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    overlap = np.zeros((len(parts), len(parts)), dtype=np.float32)
    for low in range(0, int(held.sum()), COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        block = np.zeros((len(parts), COLUMNS), dtype=np.float32)
        block[row[a:b], column[a:b] - low] = 1
        overlap += block @ block.T
    return sizes, overlap


def _meeting(tile: pa.Table) -> np.ndarray:
    """Which rows of a tile meet there and are not yet of one component."""
    left = tile.column("left").to_numpy(zero_copy_only=False)
    right = tile.column("right").to_numpy(zero_copy_only=False)
    part = tile.column("component").to_numpy()
    return ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :])) & (part[:, None] != part[None, :])


def _partners(least: Fraction):
    """Rows of one tile of first blocks that have a possible partner in it: enough overlap for their sizes."""
    def run(tile: pa.Table) -> pa.Table:
        overlap = _overlaps(tile)[1]
        fewest, low, high = (tile.column(c).to_numpy() for c in ("fewest", "n_min", "n_max"))
        near = overlap >= np.maximum(fewest[:, None], fewest[None, :])
        near &= (np.minimum(high[:, None], high[None, :]) * least.denominator
                 >= np.maximum(low[:, None], low[None, :]) * least.numerator)
        found = (near & _meeting(tile)).any(axis=1)
        give_back()
        return tile.select(["pivot", "doc_id"]).filter(pa.array(found))
    return run


def _product(least: Fraction):
    """Links of one tile of whole rows; of those found, the ones that join its rows into the same groups as all."""
    def run(tile: pa.Table) -> pa.Table:
        names = tile.column("doc_id").to_numpy()
        sizes, overlap = _overlaps(tile)
        either = sizes[:, None] + sizes[None, :] - overlap
        near = (overlap * least.denominator >= either * least.numerator) & _meeting(tile)
        group = np.arange(len(names))

        def top(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        links = []
        for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            x, y = top(i), top(j)
            if x != y:
                group[y] = x
                links.append((names[i], names[j]))
        give_back()
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})
    return run


def _tiled(rows: DataFrame, size: str) -> DataFrame:
    """The rows of each pivot with the tiles ``(i, j)`` they go to, each of bounded rows and n-grams (``size``).

    A row outside the main component (``inner`` false) of block i meets inner blocks as (i, -j) and other
    outer blocks as (min, max), those of its own block in the first of these tiles; an inner row meets
    every outer block.
    """
    def tiles_for(inner: str) -> Column:
        wide = F.greatest(F.count_if(F.expr(inner)) / TILE_ROWS,
                          F.coalesce(F.sum(F.when(F.expr(inner), F.col(size))), F.lit(0)) / TILE_GRAMS)
        return F.ceil(wide).cast("int")

    counts = rows.groupBy("pivot").agg(tiles_for("inner").alias("ins"), tiles_for("NOT inner").alias("outs"))
    block = F.pmod(F.xxhash64("doc_id"), F.when(F.col("inner"), F.col("ins")).otherwise(F.col("outs"))).cast("int")
    outers = F.when(F.col("outs") > 0, F.sequence(F.lit(0), F.col("outs") - 1)).otherwise(F.array().cast("array<int>"))
    inners = F.when(F.col("ins") > 0, F.sequence(F.lit(1), F.col("ins"))).otherwise(F.array().cast("array<int>"))

    def tile(i, j, is_left, is_right):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), is_left.alias("left"), is_right.alias("right"))

    yes, no = F.lit(True), F.lit(False)
    met = F.when(F.col("inner"), F.transform(outers, lambda o: tile(o, -(F.col("block") + 1), no, yes))).otherwise(
        F.concat(F.transform(inners, lambda v: tile(F.col("block"), -v, yes, v == 1)),
                 F.transform(F.filter(outers, lambda o: (o != F.col("block")) | (F.col("ins") == 0)),
                             lambda o: tile(F.least("block", o), F.greatest("block", o),
                                            F.col("block") <= o, F.col("block") >= o))))
    return (rows.join(counts, "pivot").withColumn("block", block)
            .select(*rows.columns, F.explode(met).alias("t")).select(*rows.columns, "t.*"))


def ngram_components(docs: DataFrame, k: int = 5, least: Fraction | str = "0.8") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each document.

    Two documents are linked when the Jaccard similarity of their sets of ``k``-word shingles is at
    least ``least``; a component is what links reach and is named by its smallest doc_id.

    The links are entries of the product of the sparse document-by-n-gram matrix with its transpose,
    computed in blocks. Equal sets are one row of it. The columns are ordered by n-gram hash and
    every row's first block is multiplied first (see ``bounds``): n-grams that one document has make
    no product, and documents that share too few columns to have a partner go. For columns of up to
    ``SPARSE`` documents, overlap counts are added up by pair, pairs below the size-derived bounds go, and
    the rest is compared over whole rows. A pair that these bounds drop shares so many denser columns, such
    as those of a large group of copies, that each document may spare half of its bound, the most frequent
    ones; a document without others, whatever passages it shares, has no partner there. No dense column
    emits its pairs. First every document is compared with the column's best connected one, the pivot. Then
    all columns of a pivot form one group of rows, those outside its largest component are multiplied
    with all others in tiles of bounded size: their first blocks, which leaves the rows that have a possible
    partner in another component, then the whole rows of these. A tile returns only links that join its rows. So every pair is compared whose link could join two components: components are
    those of all links. No candidate is capped.

    Documents whose text is null, empty or without words have ``n_shingles`` 0 and are linked with
    nothing. A null doc_id is kept in its row; where others have an equal set its component is theirs,
    else it is null and the row links nothing. Rows of one doc_id with different texts are one node with several
    sets. Repeated rows are returned repeatedly. Columns other than doc_id and text are ignored.
    """
    least = Fraction(least)
    docs = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sets = stage(docs.mapInArrow(_first_block(k, least), "doc_id long, n long, id1 long, id2 long, "
                                                         "shared int, dropped int, fewest int, grams array<long>"))
    unique = sets.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()

    # one row of the matrix for each class: its first block, which equal sets share
    held = ("shared", "dropped", "fewest", "grams")
    found = stage(sets.where("n > 0").groupBy("n", "id1", "id2").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in held]))
    classes = found.select("rep", "n", "id1", "id2")
    rows = found.where("rep IS NOT NULL").withColumnRenamed("rep", "doc_id")
    reps = rows.select("doc_id", "n", "id1", "id2")

    facts = stage(rows.groupBy("doc_id").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"),
                                             F.min("shared").alias("shared"), F.min("dropped").alias("dropped"),
                                             F.min("fewest").alias("fewest")))
    dense = stage(rows.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("size")).where("size > 1"))
    by_row = _likely(rows, dense).select("doc_id", F.explode("grams").alias("gram")).join(dense, "gram").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("s"), "gram"))).alias("heavy"),
        F.sum("size").alias("reach"))
    lightest = F.slice("heavy", F.col("dropped") + 1, F.size("heavy"))
    index = stage(by_row.join(facts.select("doc_id", "dropped", "fewest"), "doc_id").withColumn("light", lightest)
                  .where("size(light) >= fewest")
                  .select("doc_id", "reach", "fewest", F.explode("light").alias("entry"))
                  .select("doc_id", "reach", "fewest", F.col("entry.gram").alias("gram")))
    # columns that only rows with too few others had are gone by now; rows that lived on them go too
    alive = index.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1").select("gram")
    lights = stage(index.join(alive, "gram").groupBy("doc_id").agg(
        F.collect_list("gram").alias("grams"), F.first("reach").alias("reach"), F.first("fewest").alias("fewest"))
        .where("size(grams) >= fewest"))
    index = lights.select("doc_id", "reach", "fewest", F.explode("grams").alias("gram"))
    columns = stage(index.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1"))

    # all pairs of sparse columns
    sparse = index.join(columns.where(F.col("size") <= SPARSE), "gram").select("gram", "doc_id")
    pairs = (sparse.alias("x").join(sparse.alias("y"), "gram").where("x.doc_id < y.doc_id")
             .groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).agg(F.count("*").alias("overlap")))
    # each document of a dense column with the column's pivot, past the document's spare columns
    spared = F.slice("heavy", F.expr("fewest div 2").cast("int") + 1, F.size("heavy"))
    kept = stage(index.join(columns.where(F.col("size") > SPARSE), "gram").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("s"), "gram"))).alias("heavy"),
        F.first("fewest").alias("fewest"), F.first("reach").alias("reach"))
        .select("doc_id", "reach", F.explode(spared).alias("entry"))
        .select("doc_id", "reach", F.col("entry.gram").alias("gram")))
    pivots = (kept.groupBy("gram").agg(F.count("*").alias("size"), F.max(F.struct("reach", "doc_id")).alias("best"))
              .where("size > 1").select("gram", F.col("best.doc_id").alias("pivot")))
    members = stage(kept.join(pivots, "gram").groupBy("pivot", "doc_id").agg(F.count("*").alias("overlap")))
    with_pivot = members.where("pivot <> doc_id").select(
        F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b"), F.col("overlap") * 3)
    pairs = stage(_bounded(pairs.union(with_pivot), facts, least))
    rows = _rows_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(members.select("doc_id")),
                    reps, docs, k, unique)
    one = rows.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    two = rows.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    first = stage(pairs.join(one, "a").join(two, "b")
                  .select("a", "b", both.alias("both"), (F.size("x") + F.size("y") - both).alias("either"))
                  .where(F.col("both") * least.denominator >= F.col("either") * least.numerator)
                  .select("a", "b").distinct())
    found = stage(components(first)).withColumnRenamed("node", "doc_id")

    # groups of a pivot that hold several components, in tiles
    named = members.join(found, "doc_id", "left").select(
        "pivot", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    main = (named.groupBy("pivot", "component").agg(F.count("*").alias("c"))
            .groupBy("pivot").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count("*").alias("parts"))
            .where("parts > 1"))
    open_rows = stage(named.join(main, "pivot").join(facts.select("doc_id", "n_min", "n_max", "fewest"), "doc_id").select(
        "pivot", "doc_id", "component", "n_min", "n_max", "fewest", (F.col("component") == F.col("main")).alias("inner")))
    hopeful = (_tiled(open_rows, "n_max").join(lights.select("doc_id", "grams"), "doc_id").groupBy("pivot", "i", "j")
               .applyInArrow(_partners(least), "pivot long, doc_id long").distinct())
    open_rows = stage(open_rows.join(hopeful, ["pivot", "doc_id"], "left_semi"))
    second = stage(_tiled(open_rows, "n_max").join(_of_documents(rows, open_rows), "doc_id").groupBy("pivot", "i", "j")
                   .applyInArrow(_product(least), "a long, b long"))
    found = components(first.unionByName(second)).withColumnRenamed("node", "rep")

    named = classes.join(found, "rep", "left").select(
        "n", "id1", "id2", F.coalesce("component", "rep").alias("component"))
    return (sets.select("doc_id", "n", "id1", "id2").join(named, ["n", "id1", "id2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))


def _bounded(overlaps: DataFrame, facts: DataFrame, least: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` whose overlap in sparse columns reaches the bound that their sizes give.

    A pair below it shares more dense columns than either document may spare.
    """
    one = facts.select(F.col("doc_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in facts.columns[1:]])
    two = facts.select(F.col("doc_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in facts.columns[1:]])
    needed = (F.least("a_shared", "b_shared") - F.greatest("a_dropped", "b_dropped")
              - F.floor(F.greatest("a_fewest", "b_fewest") / 2))
    small, large = F.least("a_n_max", "b_n_max"), F.greatest("a_n_min", "b_n_min")
    return (overlaps.join(one, "a").join(two, "b")
            .where((F.col("overlap") >= needed) & (small * least.denominator >= large * least.numerator))
            .select("a", "b").distinct())
