"""Helpers that several text operators use."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, by exact name.

    Every other column is renamed by position first, so that an extra column whose name differs in
    case only, or repeats, cannot make a reference ambiguous. Of equal names the first counts.
    """
    seen: set[str] = set()
    new = []
    for i, c in enumerate(df.columns):
        new.append(c if c in names and c not in seen else f"__extra_{i}")
        seen.add(c)
    missing = [c for c in names if c not in seen]
    if missing:
        raise ValueError(f"input lacks the columns {missing}")
    return df.toDF(*new).select(*names)


def give_back() -> None:
    """Return freed memory to the system; else a worker keeps what its largest batch took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def pieces(batches: Iterator[pa.RecordBatch], sized_by: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of one column, one row at the least.

    Arrow batches are cut by rows; this keeps what is worked on at once bounded by bytes.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(sized_by)), 0).to_pylist()
        first = held = 0
        for i, size in enumerate(sizes):
            if i > first and held + size > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if len(sizes) > first:
            yield batch.slice(first)
        del batch
        give_back()


def lower_ascii(text):
    """A-Z lower-cased, everything else as it is.

    ``lower`` gives just that for pure ASCII, which is most text; ``translate`` is exact for the rest.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def worker_cache(use: str) -> dict:
    """A dictionary that lives as long as the Python process, for tables that its tasks share.

    It holds the tables of one use at a time: those of another operator are dropped, so a worker that
    serves many operators needs no more memory than the largest of them.
    """
    held = sys.__dict__.setdefault("_barloom_cache", {})
    if use not in held:
        held.clear()
        gc.collect()
        held[use] = {}
    return held[use]
