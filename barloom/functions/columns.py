from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite_or_null(name: str, dtype: T.DataType) -> Column:
    """NaN becomes NULL: Spark sorts NaN above every number and lets it poison averages."""
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c).alias(name)
    return c


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[finite_or_null(f.name, f.dataType) for f in df.schema.fields])


def number_text(c: Column) -> Column:
    """Shortest plain decimal text of a double.

    Java switches to exponent notation outside [1e-3, 1e7), so those values go through a decimal.
    """
    plain = F.abs(c).between(F.lit(1e-3), F.lit(9999999.0)) | (c == 0)
    return F.when(plain, c.cast("string")).otherwise(
        F.regexp_replace(c.try_cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1"))


def percent_text(ratio: Column) -> Column:
    """A ratio as percent text with two decimals, rounded on exact decimals.

    A ratio too large for that is shown as the double it is, so that one value cannot stop a run.
    """
    percent = F.round(ratio.try_cast("decimal(20,6)") * F.lit(100).cast("decimal(3,0)"), 2)
    return F.concat(F.coalesce(percent.cast("decimal(24,2)").cast("string"), (ratio * 100).cast("string")), F.lit("%"))


def is_trading_day(day: Column) -> Column:
    """Monday to Friday; public holidays are not known here."""
    return F.weekday(day) < 5


def as_date(value: dt.date | str | Column | None) -> Column:
    """A report date: a given one, or today's."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def as_timestamp(value: dt.datetime | str | Column | None) -> Column:
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")
