"""Analytical and audit reports.

Metrics are aggregated per ticker before the company join, so the join sees one row per ticker. No
side is forced to broadcast: the dimension grows with the number of tickers, and Spark broadcasts it
when its size allows. Date-bounded reports take ``as_of`` (default today) and prune the scan by date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sources.tables import days_back, lookup, since

Day = dt.date | str | Column | None
PERCENT = "decimal(18,2)"
MOST_ROWS = 10_000


class GateFailed(RuntimeError):
    """A run left unresolved ERROR issues."""


def _exact_mean(c: str) -> Column:
    """Mean of a decimal column without the intermediate rounding of avg()."""
    return F.sum(c) / F.count(c).cast("decimal(20,0)")


def best_performer(fact: DataFrame, dim: DataFrame, as_of: Day = None, days: int = 90) -> DataFrame:
    """Return in percent between the first and last date in the window.

    Both dates are those of the whole window, not of the ticker: a ticker without a bar on either one
    has no return, and sorts first.
    """
    recent = since(fact, days_back(as_of, days))
    first = recent.agg(F.min("date")).scalar()
    last = recent.agg(F.max("date")).scalar()
    per_ticker = recent.groupBy("ticker").agg(
        F.max(F.when(F.col("date") == first, F.col("close"))).alias("first_close"),
        F.max(F.when(F.col("date") == last, F.col("close"))).alias("last_close"))
    gain = (F.col("last_close") - F.col("first_close")) / F.nullif(F.col("first_close"), F.lit(0).cast("decimal(12,4)"))
    return (per_ticker.join(dim.select("ticker", "company_name"), "ticker")
            .select("ticker", "company_name", F.round(gain * 100, 2).cast(PERCENT).alias("total_return_pct"))
            .orderBy(F.desc_nulls_first("total_return_pct")))


def range_return(fact: DataFrame, dim: DataFrame, as_of: Day = None, days: int = 90) -> DataFrame:
    """Spread between the highest and lowest close in the window, in percent of the lowest."""
    per_ticker = since(fact, days_back(as_of, days)).groupBy("ticker").agg(
        F.max("close").alias("high_close"), F.min("close").alias("low_close"))
    spread = (F.col("high_close") - F.col("low_close")) / F.col("low_close")
    return (per_ticker.join(dim.select("ticker", "company_name"), "ticker")
            .select("ticker", "company_name", F.round(spread * 100, 2).cast(PERCENT).alias("return_pct"))
            .orderBy(F.desc_nulls_first("return_pct")))


def most_volatile(fact: DataFrame, dim: DataFrame, as_of: Day = None, days: int = 90) -> DataFrame:
    """Mean volatility and deviation of returns, over the rows that have a volatility."""
    per_ticker = (since(fact, days_back(as_of, days)).where(F.col("volatility_7").isNotNull())
                  .groupBy("ticker").agg(
                      F.round(_exact_mean("volatility_7"), 6).cast("decimal(18,6)").alias("avg_volatility"),
                      F.round(F.stddev_samp("daily_return"), 6).cast("decimal(18,6)").alias("stddev_return")))
    return (per_ticker.join(dim.select("ticker", "company_name"), "ticker")
            .select("ticker", "company_name", "avg_volatility", "stddev_return")
            .orderBy(F.desc_nulls_first("avg_volatility")))


def close_stats(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean, lowest and highest close and the number of days, over the whole history."""
    per_ticker = fact.groupBy("ticker").agg(
        F.round(_exact_mean("close"), 2).cast(PERCENT).alias("avg_close"),
        F.round(F.min("close"), 2).cast(PERCENT).alias("min_close"),
        F.round(F.max("close"), 2).cast(PERCENT).alias("max_close"),
        F.count(F.lit(1)).alias("trading_days"))
    return (per_ticker.join(dim.select("ticker", "company_name"), "ticker")
            .select("ticker", "company_name", "avg_close", "min_close", "max_close", "trading_days")
            .orderBy(F.desc_nulls_first("avg_close")))


def close_stats_of_years(days: DataFrame, dim: DataFrame) -> DataFrame:
    """``close_stats`` from sums and extremes by ticker and year (``operators.days``)."""
    per_ticker = days.groupBy("ticker").agg(
        F.round(F.sum("sum_close") / F.sum("n").cast("decimal(20,0)"), 2).cast(PERCENT).alias("avg_close"),
        F.round(F.min("min_close"), 2).cast(PERCENT).alias("min_close"),
        F.round(F.max("max_close"), 2).cast(PERCENT).alias("max_close"), F.sum("n").alias("trading_days"))
    return (per_ticker.join(dim.select("ticker", "company_name"), "ticker")
            .select("ticker", "company_name", "avg_close", "min_close", "max_close", "trading_days")
            .orderBy(F.desc_nulls_first("avg_close")))


def price_trend(fact: DataFrame, dim: DataFrame, as_of: Day = None, days: int = 30) -> DataFrame:
    """Daily rows of the window with the direction of the day. No return counts as flat."""
    r = F.col("daily_return")
    return (since(fact, days_back(as_of, days)).join(dim.select("ticker", "company_name"), "ticker")
            .select("date", "ticker", "company_name", "close", "moving_avg_7", "daily_return",
                    F.when(r > 0, "UP").when(r < 0, "DOWN").otherwise("FLAT").alias("day_direction"))
            .orderBy("ticker", "date"))


def check_limit(limit: int) -> int:
    """A top-k keeps its rows in every task, so it is for short reports; longer ones take ``limit=None``."""
    if not 0 <= limit <= MOST_ROWS:
        raise ValueError(f"limit must be between 0 and {MOST_ROWS}, or None for all rows")
    return limit


def run_history(log: DataFrame, limit: int | None = 50) -> DataFrame:
    """Newest runs with their duration in whole seconds, halves to even; none while running.

    ``limit=None`` gives all rows, sorted over the cluster.
    """
    seconds = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at")) / F.lit(1e6)
    rows = (log.select("run_id", "dag_run_id", "task_name", "ticker", "run_date", "started_at", "finished_at",
                       F.bround(seconds).cast("int").alias("duration_sec"), "status", "records_found",
                       "records_inserted", "records_skipped", "records_invalid", "error_message")
            .orderBy(F.desc("started_at"), F.desc("run_id")))
    return rows if limit is None else rows.limit(check_limit(limit))


def run_log_recent(log: DataFrame, limit: int = 10) -> DataFrame:
    return (log.orderBy(F.desc("started_at"), F.desc("run_id")).limit(check_limit(limit))
            .select("task_name", "ticker", "records_found", "records_inserted", "status"))


def unresolved_issues(issues: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Open issues with the run they came from. Severity sorts as text, from W to E.

    Issues that carry no ``dag_run_id`` take it from ``log``; those without a run go around that join, where
    they would all meet in one task.
    """
    found = issues.where(F.col("resolved") == F.lit(False))
    if "dag_run_id" not in issues.columns:
        with_run = found.where(F.col("run_id").isNotNull()).join(log.select("run_id", "dag_run_id"), "run_id", "left")
        found = with_run.unionByName(found.where(F.col("run_id").isNull()), allowMissingColumns=True)
    return (found
            .select("issue_id", "detected_at", "ticker", "issue_date", "check_name", "severity",
                    "description", "raw_value", "dag_run_id")
            .orderBy(F.desc("severity"), F.desc_nulls_first("detected_at"), "issue_id"))


def run_summary(log: DataFrame, dag_run_id: str) -> DataFrame:
    """Totals per task of one run."""
    return lookup(log.sparkSession, """
        SELECT task_name,
               sum(records_found) AS found, sum(records_inserted) AS inserted,
               sum(records_skipped) AS skipped, sum(records_invalid) AS invalid,
               count_if(status = 'FAILED') AS failed_tasks
        FROM {log} WHERE dag_run_id = :run GROUP BY task_name ORDER BY task_name
    """, {"run": dag_run_id}, log=log)


def run_summary_all(log: DataFrame) -> DataFrame:
    """The same totals for every run."""
    return log.groupBy("dag_run_id", "task_name").agg(
        F.sum("records_found").alias("found"), F.sum("records_inserted").alias("inserted"),
        F.sum("records_skipped").alias("skipped"), F.sum("records_invalid").alias("invalid"),
        F.count_if(F.col("status") == "FAILED").alias("failed_tasks"))


def error_count(issues: DataFrame, log: DataFrame, dag_run_id: str) -> DataFrame:
    """Number of unresolved ERROR issues of one run."""
    return lookup(log.sparkSession, """
        SELECT count(*) AS error_count FROM {issues} i LEFT SEMI JOIN {log} l
        ON i.run_id = l.run_id AND l.dag_run_id = :run
        WHERE i.severity = 'ERROR' AND NOT i.resolved
    """, {"run": dag_run_id}, issues=issues, log=log)


def run_gate(issues: DataFrame, log: DataFrame) -> DataFrame:
    """Every run with its unresolved ERROR issues and whether it passes; failed tasks do not count.

    Issues are counted per run id first, so the join sees one row per task run.
    """
    per_task = (issues.where((F.col("severity") == "ERROR") & (F.col("resolved") == F.lit(False)))
                .groupBy("run_id").agg(F.count(F.lit(1)).alias("n")))
    errors = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return (log.select("run_id", "dag_run_id").join(per_task, "run_id", "left")
            .groupBy("dag_run_id").agg(errors.alias("error_count"))
            .withColumn("passed", F.col("error_count") == 0))


def enforce_gate(issues: DataFrame, log: DataFrame, dag_run_id: str) -> int:
    """Raise if the run left unresolved ERROR issues. Reads one number back."""
    errors = error_count(issues, log, dag_run_id).first()["error_count"]
    if errors > 0:
        raise GateFailed(f"{errors} unresolved ERROR-level quality issues in run {dag_run_id}")
    return errors


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Temp views for analyst SQL, under the warehouse's table names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
