"""Staging between steps, warehouse scans and parameterised lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.columns import as_date
from barloom.session import new_scratch
from barloom.sources.files import stored_bytes

TASK_BYTES = 1 << 20, 8 << 20  # least and most of stored rows for a task


def task_count(spark: SparkSession, path: str) -> int:
    """Number of tasks to deal a stored table's rows to: three a core, for tables large enough, and more where
    a task's share would be over 8 MB, so that its memory does not grow with the table."""
    total, (least, most) = stored_bytes(spark, path), TASK_BYTES
    share = min(max(total // (3 * spark.sparkContext.defaultParallelism), least), most)
    return max(1, -(-total // share))


def plain_numbers(schema: T.StructType) -> dict[str, str]:
    """Writer options that leave prices and ratios without a dictionary: they repeat too seldom to fill one, and
    trying costs as much as writing them."""
    return {f"parquet.enable.dictionary#{f.name}": "false" for f in schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.DecimalType))}


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This is the hand-over between steps. Later readers start from the files, so a lost executor
    costs the current stage only and no step is computed twice.
    """
    path = path or new_scratch(df.sparkSession, "stage")
    df.write.mode("errorifexists").options(**plain_numbers(df.schema)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, path: str | None = None, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``stage``, with counts of the rows taken while they are written."""
    seen = Observation()
    out = stage(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), path)
    return out, seen.get


def since(fact: DataFrame, day: Column) -> DataFrame:
    """Rows on or after ``day``; where the table is laid out by year, whole years are pruned."""
    kept = fact.where(F.col("date") >= day)
    return kept.where(F.col("year") >= F.year(day)) if "year" in fact.columns else kept


def before(fact: DataFrame, day: Column) -> DataFrame:
    """Rows before ``day``, the other side of ``since``."""
    kept = fact.where(F.col("date") < day)
    return kept.where(F.col("year") <= F.year(day)) if "year" in fact.columns else kept


def days_back(as_of: dt.date | str | Column | None, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)


def lookup(spark: SparkSession, query: str, args: dict, **tables: DataFrame) -> DataFrame:
    """Run a query text with named parameters over the given tables (``{name}`` in the text)."""
    return spark.sql(query, args=args, **tables)
