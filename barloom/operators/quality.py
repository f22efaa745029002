"""The quality cascade.

Checks run in a fixed order and each sees only the rows the earlier ones kept: unreadable date, null
values, duplicate key, non-positive price, high below low, volume. Here the whole cascade is one
aggregation per (ticker, date) followed by row-local expressions:

* ``check_bars`` folds all copies of a key into one row, with a count per kind of loss and the values
  of the first complete copy. The fold is partially aggregated before the shuffle, so a key or ticker
  that holds a large share of the input arrives as one row per map task.
* The result has at most one dated row per ticker and calendar day. That bounds every later
  per-ticker group by the calendar, whatever the input size.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import nan_to_null, number_text, percent_text
from barloom.schemas import CHECKS, EXTREME_RETURN, PRICES, REQUIRED, VALUES

KEY = ["ticker", "date"]
NEGATIVE_DATES_SHOWN = 5


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in df.columns]


def missing_column_issues(tickers: DataFrame, missing: list[str]) -> DataFrame:
    """One issue per ticker of a batch that lacks required columns."""
    listed = "[" + ", ".join(f"'{c}'" for c in missing) + "]"
    return tickers.select(
        "ticker",
        F.lit(None).cast("date").alias("issue_date"),
        F.lit("missing_columns").alias("check_name"),
        F.lit(CHECKS["missing_columns"]).alias("severity"),
        F.lit(f"Required columns missing: {listed}").alias("description"),
        F.lit(None).cast("string").alias("raw_value"),
    ).where(F.lit(bool(missing)))


def check_bars(raw: DataFrame, order: str = "src_seq") -> DataFrame:
    """One row per (ticker, date): loss counts, first complete copy, and its verdict.

    ``order`` must be unique within a key; the smallest complete copy survives. With a numeric order
    column all buffers are fixed-width and the fold is a hash aggregation. NaN counts as missing.
    """
    raw = nan_to_null(raw)
    if "bad_date" not in raw.columns:
        raw = raw.withColumn("bad_date", F.lit(None).cast("string"))
    if "ticker" not in raw.columns:
        raw = raw.withColumn("ticker", F.lit(None).cast("string"))
    readable = F.col("bad_date").isNull()
    complete = reduce(and_, [F.col(c).isNotNull() for c in REQUIRED])
    rank = F.when(complete, F.col(order))

    per_key = raw.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~readable).alias("n_bad_date"),
        F.count_if(readable & ~complete).alias("n_incomplete"),
        *[F.count_if(readable & F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
        F.count_if(complete).alias("n_copies"),
        *[F.min_by(c, rank).alias(c) for c in VALUES],
    )
    return per_key.withColumn("verdict", survivor_verdict())


def survivor_verdict() -> Column:
    """Verdict on the first complete copy of a key; NULL where there is none."""
    return (F.when(F.col("n_copies") == 0, F.lit(None).cast("string"))
            .when(F.least(*PRICES) <= 0, "negative_price")
            .when(F.col("high") < F.col("low"), "high_lt_low")
            .when(F.col("volume") < 0, "negative_volume")
            .otherwise("ok"))


def clean_bars(checked: DataFrame) -> DataFrame:
    """Rows that passed every check. Zero volume passes."""
    return checked.where(F.col("verdict") == "ok").select("date", "ticker", *VALUES)


def verdict_counts(checked: DataFrame) -> DataFrame:
    """Input rows per ticker and verdict; the counts add up to the input."""
    parts = F.array(
        F.struct(F.lit("date_format").alias("verdict"), F.col("n_bad_date").alias("n")),
        F.struct(F.lit("null_values").alias("verdict"), F.col("n_incomplete").alias("n")),
        F.struct(F.lit("duplicate_rows").alias("verdict"),
                 F.greatest(F.col("n_copies") - 1, F.lit(0)).alias("n")),
        F.struct(F.col("verdict"), F.when(F.col("n_copies") > 0, 1).otherwise(0).cast("bigint").alias("n")),
    )
    return (checked.select("ticker", F.explode(parts).alias("p")).where("p.n > 0")
            .groupBy("ticker", F.col("p.verdict").alias("verdict"))
            .agg(F.sum("p.n").alias("n_rows")))


# check, column, SQL for the number of rows of a key it found
FINDINGS = [
    ("date_format", None, "n_bad_date"),
    *[("null_values", c, f"null_{c}") for c in REQUIRED],
    ("duplicate_rows", None, "n_copies - 1"),
    *[("negative_price", c, f"if(n_copies > 0 AND {c} <= 0, 1, 0)") for c in PRICES],
    ("high_lt_low", None, "if(verdict = 'high_lt_low', 1, 0)"),
    ("zero_volume", None, "if(verdict IN ('ok', 'negative_volume') AND volume = 0, 1, 0)"),
    ("negative_volume", None, "if(verdict = 'negative_volume', 1, 0)"),
]


def findings(checked: DataFrame) -> DataFrame:
    """Everything the cascade found, one row per key, check and column, with a row count ``n``.

    Clean keys are filtered out first, so the unpivot runs over the damaged share only.
    """
    cells = ", ".join(f"'{check}', {repr(column) if column else 'NULL'}, bigint({n})"
                      for check, column, n in FINDINGS)
    damaged = checked.where("n_rows > 1 OR verdict IS NULL OR verdict <> 'ok' OR volume = 0")
    return damaged.selectExpr(
        "ticker", "date", "high", "low", f"stack({len(FINDINGS)}, {cells}) AS (check_name, column, n)").where("n > 0")


def cascade_issues(checked: DataFrame) -> DataFrame:
    """Issue rows of the cascade: one per ticker, check and column, or per data row for high < low.

    Dates are gathered for non-positive prices alone, at most one per calendar day and column.
    """
    per_row = F.when(F.col("check_name") == "high_lt_low", F.col("date"))
    seen_on = F.when(F.col("check_name") == "negative_price", F.col("date"))
    grouped = (findings(checked)
               .groupBy("ticker", "check_name", "column", per_row.alias("issue_date"))
               .agg(F.sum("n").alias("n"),
                    F.slice(F.sort_array(F.collect_list(seen_on)), 1, NEGATIVE_DATES_SHOWN).alias("dates"),
                    F.min("high").alias("high"), F.min("low").alias("low")))
    n = F.col("n").cast("string")
    column = F.concat(F.lit("Column '"), F.col("column"), F.lit("' has "), n)
    check = F.col("check_name")
    high, low = number_text(F.col("high")), number_text(F.col("low"))
    description = (
        F.when(check == "date_format", F.concat(F.lit("Cannot parse dates: "), n, F.lit(" row(s)")))
        .when(check == "null_values", F.concat(column, F.lit(" null value(s)")))
        .when(check == "duplicate_rows", F.concat(n, F.lit(" duplicate (date, ticker) row(s) found")))
        .when(check == "negative_price", F.concat(column, F.lit(" non-positive value(s)")))
        .when(check == "high_lt_low", F.concat(F.lit("High ("), high, F.lit(") < Low ("), low, F.lit(")")))
        .when(check == "zero_volume", F.concat(n, F.lit(" row(s) with zero volume")))
        .otherwise(F.concat(n, F.lit(" row(s) with negative volume"))))
    raw = (F.when(check == "negative_price",
                  F.concat(F.lit("["), F.array_join(F.col("dates").cast("array<string>"), ", "), F.lit("]")))
           .when(check == "high_lt_low", F.concat(F.lit("high="), high, F.lit(" low="), low)))
    return grouped.select("ticker", "issue_date", "check_name", _severity(check).alias("severity"),
                          description.alias("description"), raw.alias("raw_value"))


def extreme_return_issues(enriched: DataFrame) -> DataFrame:
    """One warning per bar whose return is beyond the limit in either direction."""
    r = F.col("daily_return")
    return enriched.where(F.abs(r) > EXTREME_RETURN).select(
        "ticker", F.col("date").alias("issue_date"),
        F.lit("extreme_return").alias("check_name"),
        F.lit(CHECKS["extreme_return"]).alias("severity"),
        F.concat(F.lit("Daily return "), percent_text(r), F.lit(" exceeds ±50%")).alias("description"),
        number_text(r.cast("double")).alias("raw_value"))


def _severity(check: Column) -> Column:
    pairs = [F.lit(x) for kv in CHECKS.items() for x in kv]
    return F.create_map(*pairs)[check]


def batch_summary(checked: DataFrame, issues: DataFrame) -> DataFrame:
    """Per ticker of the batch: rows in, clean rows, and issues by severity.

    ``issues`` are those of the cascade; extreme returns are found later and do not count here.
    """
    rows = checked.groupBy("ticker").agg(
        F.sum("n_rows").alias("raw_rows"),
        F.count_if(F.col("verdict") == "ok").alias("clean_rows"))
    counts = issues.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"))
    zero = F.lit(0).cast("bigint")
    joined = rows.join(counts.withColumnRenamed("ticker", "issue_ticker"),
                       F.col("ticker").eqNullSafe(F.col("issue_ticker")), "left")
    return joined.select(
        "ticker", "raw_rows", "clean_rows",
        *[F.coalesce(c, zero).alias(c) for c in ("total_issues", "errors", "warnings")],
        F.col("total_issues").isNull().alias("checks_passed"))
