"""Near-duplicate embeddings by hashing to points of the E8 lattice."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, only
from barloom.llm.graph import components
from barloom.llm.shingles import mix
from barloom.sources.tables import stage

COPIES = 4  # groups of a label, and so copies of its vectors, but for labels of many groups of the size below
GROUP_BYTES = 64 << 20  # components of a group; a task holds two groups
LEAST_BYTES = 1 << 20  # a smaller label is one group
CHUNK = 8192  # vectors hashed at once
TILE_ROWS = 2048  # vectors of a cell that are compared at once, on either side
PAIRS = 1 << 18  # pairs looked at in full at once

def _even_points(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates and an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of the rows: the nearer of the even points and the even points moved by a half."""
    whole, half = _even_points(x), _even_points(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice, from a point to its neighbours."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if s.count(-0.5) % 2 == 0]
    return np.array(out)


def projections(dim: int, tables: int, seed: int) -> np.ndarray:
    """``tables`` random maps to eight dimensions that keep lengths on average; of fewer dimensions, embeddings."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        q, _r = np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))
        out.append(q[:dim] * np.sqrt(max(dim, 8) / 8))
    return np.array(out)


def cells(unit: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the keys of its own cells, by table, and of the neighbouring cells nearest to it."""
    around = e8_neighbours()
    home, near = [], []
    for t, p in enumerate(projections(unit.shape[1], tables, seed)):
        x = unit @ p / scale
        at = nearest_e8(x)
        order = np.argsort(-((x - at) @ around.T), axis=1, kind="stable")[:, :probes]
        home.append(_keys(at, t))
        near.append(np.stack([_keys(at + around[order[:, i]], t) for i in range(probes)], axis=1))
    return np.stack(home, axis=1), np.concatenate(near, axis=1)


def _keys(points: np.ndarray, number: int) -> np.ndarray:
    h = np.full(len(points), number + 1, dtype=np.uint64)
    for column in (points * 2).astype(np.int64).T:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return h.view(np.int64)


def _numbered(units: Iterator[np.ndarray], tables: int, probes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``cells`` with a table's cells numbered from 0; a neighbouring cell where no row lies is -1."""
    parts = [cells(unit, tables, probes, scale, seed) for unit in units]
    home, near = (np.concatenate(p) for p in zip(*parts, strict=True))
    near = near.reshape(len(home), tables, probes)
    homes, nears = np.empty(home.shape, np.int32), np.empty(near.shape, np.int32)
    for t in range(tables):
        known, homes[:, t] = np.unique(home[:, t], return_inverse=True)
        at = np.minimum(np.searchsorted(known, near[:, t]), len(known) - 1)
        nears[:, t] = np.where(known[at] == near[:, t], at, -1)
    return homes, nears


def _by_cell(numbers: np.ndarray, rows: np.ndarray, n: int) -> Callable[[int], np.ndarray]:
    """The rows of a cell, by its number."""
    order = np.argsort(numbers, kind="stable")
    ends = np.searchsorted(numbers[order], np.arange(n + 1))
    rows = rows[order]
    return lambda c: rows[ends[c] : ends[c + 1]]


class Tile:
    """Vectors of a label, of one length: of one group and the links within it, or of two and the links ``across``.

    ``side`` says which of two groups a vector is of. Rows lie by ``reps``.
    """

    def __init__(self, x: np.ndarray, reps: np.ndarray, copies: np.ndarray, shared: np.ndarray, side: np.ndarray,
                 across: bool):
        self.x, self.reps, self.copies, self.shared, self.side = x, reps, copies, shared, side
        self.unit = np.empty(x.shape, np.float32)
        self.linked, self.root = np.zeros(len(x), np.int64), np.arange(len(x))
        self.across = across
        self.edges: list[np.ndarray] = []  # links whose ends are not united yet
        self.waiting = 0
        self.pairs: list[np.ndarray] = []

    def search(self, least: float, tables: int, probes: int, scale: float, seed: int) -> None:
        self.home, self.near = _numbered(self._units(), tables, probes, scale, seed)
        self.least, self.band = least, (self.x.shape[1] + 8) * 2.0**-23  # twice what rounding to single floats can change
        for t in range(tables):
            n = int(self.home[:, t].max()) + 1
            homes, guests = [], []
            for rows in ([np.flatnonzero(self.side == s) for s in (0, 1)] if self.across else [np.arange(len(self.x))]):
                homes.append(_by_cell(self.home[rows, t], rows, n))
                probed, of = self.near[rows, t].ravel(), np.repeat(rows, probes)
                guests.append(_by_cell(probed[probed >= 0], of[probed >= 0], n))
            for c in range(n):
                self._meet(t, c, homes[0](c), np.concatenate([homes[-1](c), guests[-1](c)]))
                if self.across:
                    self._meet(t, c, homes[1](c), guests[0](c))
        self._unite()

    def _units(self) -> Iterator[np.ndarray]:
        for at in range(0, len(self.x), CHUNK):
            x = self.x[at : at + CHUNK].astype(np.float64)
            # divided by the largest component, no square overflows or vanishes
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            self.unit[at : at + CHUNK] = x
            yield x

    def _meet(self, t: int, c: int, hosts: np.ndarray, others: np.ndarray) -> None:
        """Compare those at home in a cell with others at home there or probing it."""
        for i in range(0, len(hosts), TILE_ROWS):
            a = hosts[i : i + TILE_ROWS]
            for j in range(0, len(others), TILE_ROWS):
                b = others[j : j + TILE_ROWS]
                cosine = self.unit[a] @ self.unit[b].T
                near = cosine >= self.least - self.band
                if not near.any():
                    continue
                for before in range(t):
                    near &= self.home[a, before][:, None] != self.home[b, before]
                p, q = np.nonzero(near)
                for at in range(0, len(p), PAIRS):
                    part = slice(at, at + PAIRS)
                    self._link(t, c, a[p[part]], b[q[part]], cosine[p[part], q[part]])

    def _link(self, t: int, c: int, a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> None:
        """Take the pairs that are linked and have not met before: in an earlier table, or in this one the other way."""
        theirs = self.home[b, t]
        new = (theirs == c) & (self.across | (a < b)) | (c < theirs)
        back = np.flatnonzero(c > theirs)
        new[back] = ~(self.near[a[back], t] == theirs[back, None]).any(axis=1)
        new &= self.reps[a] != self.reps[b]
        a, b, cosine = a[new], b[new], cosine[new]
        for before in range(t):
            new = ~((self.near[a, before] == self.home[b, before][:, None]).any(axis=1)
                    | (self.near[b, before] == self.home[a, before][:, None]).any(axis=1))
            a, b, cosine = a[new], b[new], cosine[new]
        sure = cosine >= self.least + self.band
        sure[~sure] = self._cosines(a[~sure], b[~sure]) >= self.least
        a, b = a[sure], b[sure]
        apart = self.shared[a] | self.shared[b]
        if apart.any():
            self.pairs.append(self.reps[np.stack([a[apart], b[apart]])])
            a, b = a[~apart], b[~apart]
        np.add.at(self.linked, a, self.copies[b])
        np.add.at(self.linked, b, self.copies[a])
        self.edges.append(np.stack([a, b]))
        self.waiting += len(a)
        if self.waiting > PAIRS:
            self._unite()

    def _cosines(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In doubles, added up in the order of the components."""
        def dot(p, q):
            total = np.zeros(len(p))
            for d in range(p.shape[1]):
                total += p[:, d] * q[:, d]
            return total

        x, y = (self.x[rows].astype(np.float64) for rows in (a, b))
        x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
        return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))

    def _unite(self) -> None:
        """Hang the ends of the links found since on the smallest row that they reach."""
        if not self.edges:
            return
        ends, self.edges, self.waiting = np.concatenate(self.edges, axis=1), [], 0
        while True:
            roots = self.root[ends]
            ends = ends[:, roots[0] != roots[1]]
            if not ends.size:
                return
            low, high = np.sort(self.root[ends], axis=0)
            np.minimum.at(self.root, high, low)
            while not np.array_equal(further := self.root[self.root], self.root):
                self.root = further


def _links(least: float, tables: int, probes: int, scale: float, seed: int):
    """``(a, b, linked)`` of a tile: for a row a with links the smallest row b that they reach and the number of
    rows linked with it; each link with an end that is shared, without a number."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        across = key[1].as_py() != key[2].as_py()
        dims = pa.compute.list_value_length(table.column("x")).to_numpy()
        out: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        apart = [np.zeros((2, 0), np.int64)]
        for dim in np.unique(dims):
            rows = table.filter(pa.array(dims == dim)) if (dims != dim).any() else table
            flat = [chunk.flatten().to_numpy() for chunk in rows.column("x").chunks]
            x = np.concatenate(flat).reshape(-1, dim)
            order = np.argsort(reps := rows.column("rep").to_numpy(), kind="stable")
            tile = Tile(x[order], reps[order], rows.column("copies").to_numpy()[order],
                        rows.column("shared").to_numpy()[order], rows.column("side").to_numpy()[order], across)
            del rows, flat, x
            tile.search(least, tables, probes, scale, seed)
            met = np.flatnonzero(tile.linked)
            out.append((tile.reps[met], tile.reps[tile.root[met]], tile.linked[met]))
            apart += tile.pairs
        a, b, linked = (np.concatenate(c) for c in zip(*out, strict=True))
        low, high = np.sort(np.concatenate(apart, axis=1), axis=0)
        give_back()
        return pa.table({"a": np.concatenate([a, low]), "b": np.concatenate([b, high]),
                         "linked": pa.array(np.concatenate([linked, np.zeros(len(low), np.int64)]),
                                            mask=np.arange(len(a) + len(low)) >= len(a))})
    return run


def near_embeddings(vectors: DataFrame, least: float = 0.98, tables: int = 4, probes: int = 8, scale: float = 0.6,
                    seed: int = 8) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vec_id, embedding, label``.

    Two vectors are linked when their labels are equal and their cosine, in doubles, is at least
    ``least``. ``n_links`` counts linked rows, ``component_id`` is the smallest vec_id that links reach,
    ``kept`` says whether that is the row's own.

    Equal vectors of a label are one vector with a count, so a vector that fills a third of the table is
    hashed once. In each of ``tables`` tables a vector is projected at random to eight dimensions,
    divided by ``scale`` and decoded to the nearest E8 point, its cell. A vector meets those in its cell
    and, as a probe, those in the ``probes`` neighbouring cells nearest to it. Every pair that meets is
    compared exactly, so no link is below the threshold; links are missed only where all tables part
    two vectors (the tests measure recall against all pairs). Cells are never capped.

    A label's vectors are dealt to groups by a hash, and every two groups, and every group with itself, are a
    tile, in which a task looks up the cells. A pair is in one tile and counts where it meets first there, so
    pairs are compared in memory, a block of a cell at a time, and are never rows: a tile gives a row for
    each vector with links. What is moved is each vector once for each group of its label, of which there are at
    most ``COPIES`` unless the label's vectors are larger than as many groups of ``GROUP_BYTES``.
    Where only its identity counts, two hashes of 64 bits stand for a vector.

    Null vectors, and those with null or non-finite components or only zeros, are linked with nothing,
    like rows without a label or a vec_id. Vectors of different lengths are never linked. Rows of one
    vec_id with different vectors are one node; links of such nodes are counted as rows, after the tiles.
    Other columns are ignored; no rows give none.
    """
    rows = only(vectors, "vec_id", "embedding", "label").withColumn("vec_id", F.col("vec_id").cast("long"))
    sound = F.coalesce((F.size("embedding") > 0)
                       & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
                       & F.exists("embedding", lambda v: v != 0), F.lit(False))
    usable = rows.where(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    identity = ["label", "h1", "h2"]
    named = usable.select("vec_id", "label", F.xxhash64(F.lit(1), "embedding").alias("h1"),
                          F.xxhash64(F.lit(2), "embedding").alias("h2"), F.size("embedding").alias("dims"))
    classes = stage(named.groupBy(*identity).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.max("dims").alias("dims")))
    nodes = classes.groupBy("rep").agg(F.sum("copies").alias("copies"), F.count("*").alias("vectors"))
    shared = stage(nodes.where("vectors > 1").select("rep", F.lit(True).alias("shared")))

    single = dict(rows.dtypes)["embedding"] == "array<float>"
    width, whole = 4 if single else 8, classes.agg(F.sum("dims")).first()[0] or 1
    share = F.least(F.lit(COPIES), F.ceil(F.sum("dims") * COPIES**2 / F.lit(whole)), F.ceil(F.sum("dims") * width / F.lit(LEAST_BYTES)))
    sizes = stage(classes.groupBy("label").agg(F.greatest(
        share, F.ceil(F.sum("dims") * width / F.lit(GROUP_BYTES))).cast("int").alias("groups")))
    own = F.pmod(F.xxhash64("rep"), F.col("groups")).cast("int")
    dealt = (usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
             .join(sizes, "label").join(shared, "rep", "left")
             .select("label", "rep", "copies", F.coalesce("shared", F.lit(False)).alias("shared"), own.alias("own"),
                     F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("other"),
                     (F.col("embedding") if single else F.col("embedding").cast("array<double>")).alias("x"))
             .select("label", "rep", "copies", "shared", "x", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("side")))
    found = stage(dealt.groupBy("label", "i", "j").applyInArrow(
        _links(least, tables, probes, scale, seed), "a long, b long, linked long"))

    apart = found.where("linked IS NULL").select("a", "b").distinct()
    both = apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(nodes.select(F.col("rep").alias("b"), "copies"), "b").select("a", F.col("copies").alias("linked"))
    linked = (found.where("linked IS NOT NULL").select("a", "linked").unionByName(counted)
              .groupBy(F.col("a").alias("rep")).agg(F.sum("linked").alias("linked")))
    reached = components(found.select("a", "b")).withColumnRenamed("node", "rep")
    facts = (classes.join(linked, "rep", "left").join(reached, "rep", "left").select(
        *identity, (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")))
    joined = named.join(facts, identity).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
