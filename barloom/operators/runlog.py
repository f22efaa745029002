"""Run log as append-only START and END events, and the issue log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import as_timestamp
from barloom.schemas import ISSUES, RUN_EVENTS, RUN_LOG

COUNTS = ["records_found", "records_inserted", "records_skipped", "records_invalid"]


def run_id(dag_run_id: str | Column, task: str | Column, ticker: str = "ticker",
           attempt: int | Column = 1) -> Column:
    """Surrogate id of a task run: a hash of its natural key, the same in START, END and issues.

    A retry passes the next ``attempt``. With 64 bits, a collision becomes likely (3 %) only at about a
    billion ids; ``pk_violations`` on the log finds one.
    """
    parts = [x if isinstance(x, Column) else F.lit(x) for x in (dag_run_id, task, attempt)]
    return F.xxhash64(parts[0], parts[1], F.col(ticker), parts[2])


def issue_id() -> Column:
    """Surrogate id of an issue: its run, check, date and text (which names the column)."""
    return F.xxhash64("run_id", "check_name", "issue_date", "description")


def start_events(tickers: DataFrame, dag_run_id: str, task: str, run_ts=None, attempt: int = 1) -> DataFrame:
    """A RUNNING event for every ticker of a step, in one frame."""
    now = as_timestamp(run_ts)
    return as_events(tickers.select(
        run_id(dag_run_id, task, attempt=attempt).alias("run_id"), F.lit(0).alias("event_seq"),
        F.lit(dag_run_id).alias("dag_run_id"), F.lit(task).alias("task_name"), "ticker",
        now.cast("date").alias("run_date"), now.alias("event_at"), F.lit("RUNNING").alias("status"),
        F.lit(attempt).alias("attempt")))


def end_events(outcomes: DataFrame, dag_run_id: str, task: str, run_ts=None, attempt: int = 1) -> DataFrame:
    """The closing event of every ticker: FAILED where ``error_message`` is set, else SUCCESS.

    ``outcomes`` has ticker and any of the count columns, error_message and details.
    """
    now = as_timestamp(run_ts)
    error = F.col("error_message") if "error_message" in outcomes.columns else F.lit(None).cast("string")
    extra = [c for c in [*COUNTS, "error_message", "details"] if c in outcomes.columns]
    return as_events(outcomes.select(
        run_id(dag_run_id, task, attempt=attempt).alias("run_id"), F.lit(1).alias("event_seq"),
        F.lit(dag_run_id).alias("dag_run_id"), F.lit(task).alias("task_name"), "ticker",
        now.cast("date").alias("run_date"), now.alias("event_at"),
        F.when(error.isNotNull(), "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit(attempt).alias("attempt"), *extra))


def as_events(df: DataFrame) -> DataFrame:
    """All event columns; counts default to zero, texts to NULL."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in RUN_EVENTS.fields if f.name not in df.columns}
    return df.withColumns(absent).fillna(0, COUNTS).select(*RUN_EVENTS.fieldNames())


def current_state(events: DataFrame) -> DataFrame:
    """One row per run id: the START time with everything else from the newest event.

    A run that never closed stays RUNNING with no finish time.
    """
    latest = F.max_by(F.struct("dag_run_id", "task_name", "ticker", "status", *COUNTS,
                               "error_message", "details"), F.col("event_seq"))
    is_end = F.col("event_seq") > 0
    state = events.groupBy("run_id").agg(
        F.min("run_date").alias("run_date"),
        F.coalesce(F.min(F.when(~is_end, F.col("event_at"))), F.min("event_at")).alias("started_at"),
        F.max(F.when(is_end, F.col("event_at"))).alias("finished_at"),
        latest.alias("latest"))
    return state.select("run_id", "run_date", "started_at", "finished_at", "latest.*").select(
        *RUN_LOG.fieldNames())


def issue_rows(issues: DataFrame, dag_run_id: str, task: str = "transform", run_ts=None,
               attempt: int = 1) -> DataFrame:
    """Issue-log rows for the issues of a step, with ids and defaults."""
    return (issues
            .withColumn("run_id", run_id(dag_run_id, task, attempt=attempt))
            .withColumn("issue_id", issue_id())
            .withColumn("detected_at", as_timestamp(run_ts))
            .withColumn("resolved", F.lit(False))
            .select(*ISSUES.fieldNames()))


def details_json(**fields: Column) -> Column:
    """Details as JSON text."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
