"""Table constraints as violation queries: an empty result means the constraint holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import finite_or_null
from barloom.schemas import PRICE, PRICES, RATIO


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs per column that must not hold any; one aggregation for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.explode(pairs).alias("v")).select("v.*").where("violations > 0")


def enum_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows per value outside the list. NULL passes, as in a CHECK constraint."""
    return (df.where(~F.col(column).isin(allowed))
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("violations")))


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Number of texts per column that are longer than its limit."""
    counts = df.agg(*[F.count_if(F.char_length(c) > n).alias(c) for c, n in limits.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in limits])
    return counts.select(F.explode(pairs).alias("v")).select("v.*").where("violations > 0")


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1))


def storage_cast(df: DataFrame) -> DataFrame:
    """Cast to the stored types.

    A value that does not fit becomes NULL and is named in ``overflow``, so the caller can fail that
    ticker instead of the whole job. The price range is taken from the stored decimals. Columns the
    input does not have are left out.
    """
    types = {c: PRICE for c in [*PRICES, "moving_avg_7"]} | {c: RATIO for c in ("daily_return", "volatility_7")}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in types if c in df.columns]
    lost = [F.when(_clean(c, kinds).isNotNull() & _fit(c, kinds, types[c]).isNull(), F.lit(c))
            for c in present]
    out = df.withColumn("overflow", F.coalesce(*lost) if lost else F.lit(None).cast("string"))
    out = out.select(*[_fit(c, kinds, types[c]).alias(c) if c in present else F.col(c) for c in out.columns])
    if {"high", "low"} <= set(present):
        out = out.withColumn("price_range", (F.col("high") - F.col("low")).try_cast(PRICE))
    return out


def _clean(name: str, kinds: dict) -> Column:
    return finite_or_null(name, kinds[name])


def _fit(name: str, kinds: dict, to) -> Column:
    return _clean(name, kinds).try_cast(to)
