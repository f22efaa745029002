"""Idempotent load: first write wins, one outcome per ticker."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import as_timestamp
from barloom.operators.constraints import storage_cast
from barloom.schemas import FACT, FACT_INPUT, PRICES, RAW_BARS, TEXT_LIMITS, required_columns

KEY = ["date", "ticker"]


def project(df: DataFrame, *keep: str) -> DataFrame:
    """The fact columns the input has, in table order, and any columns named in ``keep``."""
    return df.select(*[c for c in [*FACT_INPUT, *keep] if c in df.columns])


def first_per_key(batch: DataFrame, order: str = "src_seq") -> DataFrame:
    """One row per (date, ticker), the first in input order, with the number of copies.

    Copies fold in the map tasks, so a key that fills the batch does not travel as rows. ``order`` must be
    unique within a key.
    """
    values = [c for c in batch.columns if c not in (*KEY, order)]
    return batch.groupBy(*KEY).agg(*[F.min_by(c, order).alias(c) for c in values],
                                   F.count(F.lit(1)).alias("copies"))


def stored_keys(fact: DataFrame, dates_of: DataFrame) -> DataFrame:
    """Keys of a batch that the fact table already has.

    The batch's dates are scalar subqueries that Spark turns into scan filters, so other years are not
    read; the semi join leaves the batch's own keys, so a ticker whose batch reaches far back does not
    bring along the keys of others. For an increment few or no keys are left; staged, their measured
    size lets Spark broadcast them and leave the batch where it is.
    """
    low, high = dates_of.agg(F.min("date")).scalar(), dates_of.agg(F.max("date")).scalar()
    reachable = fact.where((F.col("date") >= low) & (F.col("date") <= high))
    if "year" in fact.columns:
        reachable = reachable.where((F.col("year") >= F.year(low)) & (F.col("year") <= F.year(high)))
    return reachable.select(*KEY).join(dates_of.select(*KEY), KEY, "left_semi")


def mark_existing(batch: DataFrame, keys: DataFrame) -> DataFrame:
    """Flag keys the fact table already has.

    One left join gives both the rows to insert and the skipped counts. Both sides are unique on the
    join key, so it cannot skew.
    """
    if "copies" not in batch.columns:
        batch = batch.withColumn("copies", F.lit(1).cast("bigint"))
    return (batch.join(keys.select(*KEY, F.lit(True).alias("found")), KEY, "left")
            .withColumn("stored", F.coalesce("found", F.lit(False))).drop("found"))


def mark_new(batch: DataFrame) -> DataFrame:
    """``mark_existing`` of a batch whose keys are known to be new."""
    if "copies" not in batch.columns:
        batch = batch.withColumn("copies", F.lit(1).cast("bigint"))
    return batch.withColumn("stored", F.lit(False))


def new_rows(marked: DataFrame) -> DataFrame:
    return marked.where(~F.col("stored")).drop("stored", "copies")


def load_counts(marked: DataFrame) -> DataFrame:
    """Attempted, inserted and skipped rows per ticker; copies within the batch are skipped rows."""
    attempted, inserted = F.sum("copies"), F.count_if(~F.col("stored"))
    return marked.groupBy("ticker").agg(
        attempted.alias("attempted"), inserted.alias("inserted"), (attempted - inserted).alias("skipped"))


def row_error(batch: DataFrame) -> DataFrame:
    """The batch in storage types with ``row_error``: why a row cannot be stored, null where it can."""
    typed = storage_cast(project(batch))
    required = [c for c in required_columns("fact_stock_prices") if c in typed.columns]
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    too_long = F.char_length("ticker") > TEXT_LIMITS["fact_stock_prices"]["ticker"]
    return typed.withColumn("row_error", (
        F.when(F.col("overflow").isNotNull(), F.concat(F.lit("numeric field overflow in column "), F.col("overflow")))
        .when(missing.isNotNull(), F.concat(F.lit("null value in column "), missing))
        .when(too_long, F.lit("value too long for column ticker"))))


def unfit(batch: DataFrame) -> Column:
    """Whether a row has a ``row_error``, as a column of the batch itself; true at times where it has none.

    Bounds that are stricter than the storage types' by a rounding step stand for the casts.
    """
    limits = {c: 99_999_999.0 for c in [*PRICES, "moving_avg_7"]} | {c: 9_999.0 for c in ("daily_return", "volatility_7")}
    required = set(required_columns("fact_stock_prices"))
    kinds = dict(batch.dtypes)
    odd = [F.col(c).isNull() for c in required if c in batch.columns]
    for c, most in limits.items():
        if c in batch.columns:
            value = F.col(c)
            odd.append(F.coalesce(F.abs(value) >= most, F.lit(False)))
            if kinds[c] in ("double", "float") and c in required:
                odd.append(F.isnan(value))
    odd.append(F.coalesce(F.char_length("ticker") > TEXT_LIMITS["fact_stock_prices"]["ticker"], F.lit(False)))
    return reduce(or_, odd)


def failed_tickers(batch: DataFrame, dim: DataFrame) -> DataFrame:
    """Tickers that cannot load, with the reason.

    A ticker loads as a whole or not at all: one row with a value that does not fit, a missing value or
    an unknown ticker fails all its rows and no other's. Rows are reduced to one per ticker before the
    shuffle, and the dimension is joined to those.
    """
    known = dim.select("ticker", F.lit(True).alias("known"))
    unknown = F.when(F.col("known").isNull(), F.concat(F.lit("ticker "), F.col("ticker"), F.lit(" is not in dim_company")))
    return (row_error(batch).groupBy("ticker").agg(F.min("row_error").alias("row_error")).join(known, "ticker", "left")
            .select("ticker", F.coalesce("row_error", unknown).alias("error_message"))
            .where(F.col("error_message").isNotNull()))


def row_hash(rows: DataFrame) -> Column:
    """A hash of a raw row's own values, whatever else is known of it; 256 bits, so that no two rows share one."""
    own = [c for c in [*RAW_BARS.fieldNames(), "bad_date"] if c in rows.columns]
    return F.sha2(F.to_json(F.struct(*own)), 256)


def fact_rows(rows: DataFrame, run_ts=None) -> DataFrame:
    """Rows in the fact table's columns and types, with the load time filled in.

    Metrics the input did not carry are NULL, as an insert with a shorter column list leaves them.
    """
    if "loaded_at" not in rows.columns:
        rows = rows.withColumn("loaded_at", as_timestamp(run_ts))
    present = set(rows.columns)
    return rows.selectExpr(*[
        f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in FACT.fields])
