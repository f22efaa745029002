"""One run of the warehouse over all tickers at once: extract, check and enrich, load, gate.

Steps hand over through staged tables in the shared folder, so a lost executor or a failed step never
repeats an earlier one. Tickers are isolated by data, not by process: a ticker that cannot load is
marked FAILED and its rows go to quarantine while the others load. The driver reads back single
numbers and schemas only; numbers that decide what a step may leave out are counted while tables are written.

A run takes a frame of landing rows, of which it filters what is new by ticker, or a ``LandingFolder``, of
which it opens only files that no run has read, and older ones that still hold rows of a ticker it can load.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import as_date
from barloom.operators import enrich, ingest, load, quality, runlog
from barloom.operators.constraints import storage_cast
from barloom.operators.days import keys_in_days, watermarks_of_days
from barloom.plans import reports
from barloom.schemas import FIRST_LOAD_DATE, TASKS, WINDOW_ROWS
from barloom.session import new_scratch
from barloom.sources.landing import LandingFolder
from barloom.sources.tables import days_back, since, stage, stage_counted, task_count
from barloom.sources.warehouse import Warehouse


LOOK_BACK_DAYS = 366


class MissingDate(ValueError):
    """The landing data has no date column, so no range can be taken from it."""


class TickerFailed(RuntimeError):
    """A single-ticker run did not load its ticker."""


@dataclass(frozen=True)
class Run:
    """What identifies a run, and its options."""

    warehouse: Warehouse
    dag_run_id: str
    as_of: dt.date | str | None = None       # fetch up to the day before; default today
    run_ts: dt.datetime | str | None = None  # stamped on all rows of the run; default now
    first_load: dt.date | str = FIRST_LOAD_DATE
    scope: str = "history"
    attempt: int | None = None               # default the next one that the run's events leave free
    log_empty: bool = False                  # also log transform and load of tickers without rows
    by_year: bool = False                    # metrics in a task per ticker and year, for few tickers with long histories
    folder: str = ""                         # of its staged tables; default a new one in the shared folder

    def __post_init__(self) -> None:
        if not self.dag_run_id:
            raise ValueError("a run needs an id")
        # one clock for all steps, also past midnight
        now = self.warehouse.spark.range(1).select(F.current_date(), F.current_timestamp().cast("timestamp_ntz")).first()
        object.__setattr__(self, "as_of", now[0] if self.as_of is None else self.as_of)
        object.__setattr__(self, "run_ts", now[1] if self.run_ts is None else self.run_ts)
        last = self.warehouse.last_attempt(self.dag_run_id)
        if self.attempt is not None and self.attempt <= last:
            raise ValueError(f"attempt {self.attempt} of run {self.dag_run_id} is in the log already")
        object.__setattr__(self, "attempt", last + 1 if self.attempt is None else self.attempt)
        name = re.sub(r"[^\w.-]", "_", self.dag_run_id)
        object.__setattr__(self, "folder", self.folder or new_scratch(self.warehouse.spark, f"{name}/attempt-{self.attempt}"))

    def begin(self) -> None:
        """Put the folder of staged tables on record, and let the run's log take more events."""
        self.warehouse.record_staged(self.dag_run_id, self.attempt, self.folder)
        self.warehouse.unseal_log(self.dag_run_id)

    def stage(self, df: DataFrame, step: str) -> DataFrame:
        """Stage a table in the attempt's folder, which ``Warehouse.expire_staged`` deletes once it has ended."""
        return stage(df, f"{self.folder}/{step}")

    def stage_counted(self, df: DataFrame, step: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        return stage_counted(df, f"{self.folder}/{step}", **counts)

    def tasks(self, step: str) -> int:
        return task_count(self.warehouse.spark, f"{self.folder}/{step}")

    def started(self, task: str, tickers: DataFrame) -> DataFrame:
        return runlog.start_events(tickers, self.dag_run_id, task, self.run_ts, self.attempt)

    def finished(self, task: str, outcomes: DataFrame) -> DataFrame:
        return runlog.end_events(outcomes, self.dag_run_id, task, self.run_ts, self.attempt)

    def log(self, *events: DataFrame) -> None:
        """Append events, those of a step's end with those of the next one's start, in one write."""
        self.warehouse.append("run_events", reduce(DataFrame.unionByName, events))

    def report(self, issues: DataFrame) -> None:
        rows = runlog.issue_rows(issues, self.dag_run_id, "transform", self.run_ts, self.attempt)
        self.warehouse.append("audit_quality_issues", rows.withColumn("dag_run_id", F.lit(self.dag_run_id)))


@dataclass(frozen=True)
class Extract:
    batch: DataFrame    # staged raw bars in range
    tickers: DataFrame  # staged: ticker, start, rows_fetched, outcome
    undated: int        # rows of the batch without a date
    commit: int         # the warehouse's newest commit when the ranges were taken
    listed: bool        # all tickers are those of the dimension
    files: DataFrame | None = None   # files read for the first time
    census: DataFrame | None = None  # staged: what they and the older ones hold


def extract(run: Run, landing: DataFrame | LandingFolder, tickers: DataFrame | None = None) -> Extract:
    """Stage the landing rows past each ticker's high-water mark."""
    house = run.warehouse
    run.begin()
    universe = (house.dim() if tickers is None else tickers).select("ticker").distinct()
    commit, marks = house.last_commit(), watermarks_of_days(house.days())
    starts = run.stage(ingest.fetch_starts(universe, marks, run.first_load), "starts")
    run.log(run.started("extract", starts))
    files = None
    if isinstance(landing, LandingFolder):
        files, landing = _arrivals(run, landing, universe)
    if "date" not in landing.columns:
        run.log(run.finished("extract", starts.select("ticker", F.lit("column date is missing").alias("error_message"))))
        raise MissingDate("column date is missing")
    census = None
    if files is not None and tickers is None:
        census = run.stage(ingest.file_census(landing, run.as_of), "census")
    batch, undated = _new_rows(run, ingest.incremental_filter(landing, starts, run.as_of))
    if tickers is None:
        if census is not None:
            ignored = ingest.unlisted_rows(census, universe)
        else:
            counted = house.ignored_rows().agg(F.max("counted_to")).first()[0]
            ignored = ingest.ignored_rows(landing, starts, run.as_of, None if counted is None else F.lit(counted))
        house.append("ignored_rows", ignored.withColumns(
            {"counted_to": as_date(run.as_of), "dag_run_id": F.lit(run.dag_run_id)}))
    fetched = batch.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows_fetched"))
    empty = ingest.empty_extracts(starts, batch, run.as_of).select("ticker", "outcome", "reason")
    seen = run.stage(starts.join(fetched, "ticker", "left").join(empty, "ticker", "left")
                     .select("ticker", "start", F.coalesce("rows_fetched", F.lit(0)).alias("rows_fetched"),
                             "outcome", "reason"), "tickers")
    return Extract(batch, seen, undated, commit, tickers is None, files, census)


def _arrivals(run: Run, folder: LandingFolder, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that no run has read, and their rows with those that older files still hold for listed tickers."""
    house = run.warehouse
    there = run.stage(folder.files(), "files")
    key = ["path", "length", "modified"]
    new = run.stage(there.join(house.consumed_files().select(*key), key, "left_anti"), "new_files")
    rows = folder.read(new).withColumn("is_new", F.lit(True))
    left = run.stage(house.backlog().join(universe, "ticker", "left_semi")
                     .join(there.select("path", "location"), "path").join(new.select("path"), "path", "left_anti"), "backlog")
    if not left.isEmpty():
        pairs = left.select(F.col("path").alias("landing_file"), "ticker")
        old = folder.read(left.select("location").distinct()).join(pairs, ["landing_file", "ticker"], "left_semi")
        rows = rows.unionByName(old.withColumn("is_new", F.lit(False)), allowMissingColumns=True)
    return new, rows


def _new_rows(run: Run, rows: DataFrame) -> tuple[DataFrame, int]:
    """The staged batch, and its number of rows without a date.

    Such rows have no place in any range and are met again as long as they are in the landing data; those
    that the quarantine holds were reported by the run that put them there.
    """
    batch, counted = run.stage_counted(rows, "batch", undated=F.count_if(F.col("date").isNull()))
    if not counted["undated"]:
        return batch, 0
    undated = batch.where(F.col("date").isNull())
    fresh = undated.withColumn("row_hash", load.row_hash(undated)).join(
        run.warehouse.read("quarantine").select("row_hash").distinct(), "row_hash", "left_anti").drop("row_hash")
    kept, counted = run.stage_counted(fresh, "undated", undated=F.count(F.lit(1)))
    return batch.where(F.col("date").isNotNull()).unionByName(kept), counted["undated"]


@dataclass(frozen=True)
class Enriched:
    rows: DataFrame  # staged clean bars with their metrics
    unfit: int       # rows that cannot be stored


def transform(run: Run, extracted: Extract) -> Enriched | None:
    """Check, clean and enrich a batch; None if it lacks a required column.

    Issues are stored before the step closes, whatever happens to the rows afterwards. Rows without a date
    go to the quarantine as they came, after their issue is stored.
    """
    batch = extracted.batch
    fetched = extracted.tickers
    present = fetched.where(F.col("rows_fetched") > 0).select("ticker")
    run.log(run.finished("extract", fetched.select(
        "ticker", F.col("rows_fetched").alias("records_found"),
        runlog.details_json(start=F.col("start").cast("string"), rows_fetched=F.col("rows_fetched"),
                            reason=F.col("reason")).alias("details"))),
            run.started("transform", fetched if run.log_empty else present))
    absent = quality.missing_columns(batch)
    if absent:
        run.report(quality.missing_column_issues(present, absent))
        run.log(run.finished("transform", present.select(
            "ticker", F.lit(f"required columns missing: {', '.join(absent)}").alias("error_message"))))
        return None
    checked = run.stage(quality.check_bars(batch), "checked")
    metrics = enrich.enrich(quality.clean_bars(checked), scope=run.scope, stored=_look_back(run, present),
                            by_year=run.by_year, tasks=run.tasks("checked"))
    enriched, counted = run.stage_counted(metrics, "enriched", unfit=F.count_if(load.unfit(metrics)))
    run.report(quality.cascade_issues(checked).unionByName(quality.extreme_return_issues(enriched)))
    if extracted.undated:
        undated = batch.where(F.col("date").isNull())
        why = F.when(F.col("bad_date").isNotNull(), "date_format") if "bad_date" in batch.columns else F.lit(None).cast("string")
        run.warehouse.add_to_quarantine(undated.withColumn("error_message", F.coalesce(why, F.lit("null_values"))), run.dag_run_id)
    # the cascade's issues as they were stored, so they are not computed again
    own = F.col("run_id") == runlog.run_id(run.dag_run_id, "transform", attempt=run.attempt)
    found = run.warehouse.issues(run.dag_run_id).where(own & (F.col("check_name") != "extreme_return"))
    summary = quality.batch_summary(checked, found)
    outcomes = summary.select(
        "ticker", F.col("clean_rows").alias("records_found"), F.col("errors").alias("records_invalid"),
        runlog.details_json(ticker=F.col("ticker"), total_issues=F.col("total_issues"), errors=F.col("errors"),
                            warnings=F.col("warnings"), checks_passed=F.col("checks_passed")).alias("details"))
    run.log(run.finished("transform", _with_empty(run, extracted, outcomes)),
            run.started("load", fetched if run.log_empty else enriched.select("ticker").distinct()))
    return Enriched(enriched, counted["unfit"])


def _look_back(run: Run, tickers: DataFrame) -> DataFrame | None:
    """The newest stored rows of the batch's tickers: from the last year, or older where it has too few.

    Which tickers those are is known from the yearly summaries. None where nothing is stored yet.
    """
    if run.scope == "batch" or not run.warehouse.parts():
        return None
    house, recent_from = run.warehouse, days_back(run.as_of, LOOK_BACK_DAYS)
    # summaries know whole years, so the last year is rounded up to two
    year, fact = F.year(recent_from), house.fact()
    enough = (house.days().where(F.col("year") >= year).groupBy("ticker").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= WINDOW_ROWS))
    recent_day = F.make_date(year, F.lit(1), F.lit(1))
    recent = enrich.last_stored_rows(since(fact, recent_day).join(enough, "ticker", "left_semi"))
    return recent.unionByName(enrich.last_stored_rows(fact.join(
        tickers.join(enough, "ticker", "left_anti"), "ticker", "left_semi")))


def load_batch(run: Run, extracted: Extract, transformed: Enriched) -> DataFrame:
    """Insert the new keys of every ticker that can load; returns counts per ticker.

    Failed tickers and stored keys are staged before anything is appended; where all rows fit and all tickers
    come from the dimension, none has failed. Inserting therefore cannot
    change the counts, and a rerun after a crash finds the stored keys and skips them. Stored keys come
    from the day bits of the summaries; where no commit was made since the ranges were taken, the batch lies
    past all stored days and none is looked for. The batch itself is shuffled once, into the layout of the
    fact table.
    """
    house, enriched = run.warehouse, transformed.rows
    failed = run.warehouse.spark.createDataFrame([], "ticker string, error_message string")
    good = enriched.where(F.col("ticker").isNotNull())
    if transformed.unfit or not extracted.listed:
        failed = run.stage(load.failed_tickers(enriched, house.dim()), "failed")
        good = good.join(failed, "ticker", "left_anti")
    if house.last_commit() == extracted.commit:
        marked = load.mark_new(_typed(good))
        # all rows are new, and are cast after they are laid out: the sample that sets the ranges takes them as they are
        house.append_fact(_typed(house.in_layout(good)), run.run_ts, laid_out=True)
    else:
        marked = load.mark_existing(_typed(good), run.stage(keys_in_days(house.days(), good), "stored_keys"))
        house.append_fact(load.new_rows(marked), run.run_ts)
    if transformed.unfit or not extracted.listed:
        house.add_to_quarantine(enriched.join(failed, "ticker"), run.dag_run_id)
    if extracted.census is not None:
        _record_files(run, extracted, failed)
    counts = load.load_counts(marked)
    outcomes = counts.select(
        "ticker", F.col("attempted").alias("records_found"), F.col("inserted").alias("records_inserted"),
        F.col("skipped").alias("records_skipped"), F.lit(None).cast("string").alias("error_message"),
        runlog.details_json(ticker=F.col("ticker"), attempted=F.col("attempted")).alias("details"))
    run.log(run.finished("load", _with_empty(run, extracted, outcomes.unionByName(failed, allowMissingColumns=True))))
    return counts


def _typed(rows: DataFrame) -> DataFrame:
    return storage_cast(load.project(rows)).drop("overflow")


def _record_files(run: Run, extracted: Extract, failed: DataFrame) -> None:
    """Put the files that were read on record, after all else is stored: a run that fails reads them again."""
    house, name = run.warehouse, F.lit(run.dag_run_id)
    left = ingest.left_in_files(extracted.census, extracted.tickers, failed, house.backlog(), run.as_of)
    house.append("landing_backlog", left.withColumns({"seq": F.lit(house.next_backlog_seq()), "dag_run_id": name}))
    held = extracted.census.where("is_new").groupBy(F.col("landing_file").alias("path")).agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("n_rows").alias("n_rows"))
    house.append("landing_files", extracted.files.join(held, "path", "left").withColumns(
        {"n_rows": F.coalesce("n_rows", F.lit(0)), "dag_run_id": name}))


def _with_empty(run: Run, extracted: Extract, outcomes: DataFrame) -> DataFrame:
    """Add zero-count outcomes for tickers without rows, if the run logs them."""
    if not run.log_empty:
        return outcomes
    return outcomes.unionByName(
        extracted.tickers.select("ticker").join(outcomes, "ticker", "left_anti"), allowMissingColumns=True)


def run_daily(run: Run, landing: DataFrame | LandingFolder, tickers: DataFrame | None = None, gate: bool = True) -> DataFrame:
    """Run all steps and return the run summary.

    The gate comes last and always: it raises if the run left unresolved ERROR issues, after the clean
    rows are stored and the log is complete.
    """
    extracted = extract(run, landing, tickers)
    enriched = transform(run, extracted)
    if enriched is not None:
        load_batch(run, extracted, enriched)
    log = run.warehouse.log(run.dag_run_id)
    if gate:
        reports.enforce_gate(run.warehouse.issues(run.dag_run_id), log, run.dag_run_id)
    return reports.run_summary(log, run.dag_run_id)


def run_ticker(run: Run, landing: DataFrame | LandingFolder, ticker: str) -> dict[str, int]:
    """Run the steps for one ticker, without the gate; returns its inserted and skipped rows.

    Files of a folder stay off the record, as other tickers' rows in them are not loaded.
    """
    one = run.warehouse.spark.createDataFrame([(ticker,)], "ticker string")
    extracted = extract(run, landing, one)
    enriched = transform(run, extracted)
    row = load_batch(run, extracted, enriched).first() if enriched is not None else None
    this_attempt = reduce(or_, [F.col("run_id") == runlog.run_id(run.dag_run_id, task, attempt=run.attempt) for task in TASKS])
    failed = run.warehouse.log(run.dag_run_id).where(
        (F.col("ticker") == ticker) & (F.col("status") == "FAILED") & this_attempt).first()
    if failed:
        raise TickerFailed(f"{failed.task_name} of {ticker}: {failed.error_message}")
    return {"inserted": row.inserted, "skipped": row.skipped} if row else {"inserted": 0, "skipped": 0}
