"""The warehouse tables as Parquet folders.

Facts are laid out by year and, within a year, by ticker range, so date filters prune whole folders
and ticker filters prune row groups. Every load and every rewrite of a year writes folders of its own;
a commit names the folders that count, so readers see a load or a rewrite whole or not at all. Beside the
facts lies one summary row per ticker, year and folder. The run log is stored as events; events and issues
lie by run, so that a run's summary and gate read that run only. The dimension is written as whole versions.
Nothing is overwritten while it may be read. One writer at a time is assumed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import corrections as fix
from barloom.operators.days import by_ticker_and_year, day_summary
from barloom.operators.dimension import check_companies, upsert_dimension
from barloom.operators.load import fact_rows, row_hash
from barloom.operators.runlog import current_state
from barloom.plans import reports
from barloom.schemas import DAY_SUMMARY, DIM_COMPANY, FACT, ISSUES, RAW_BARS, RUN_EVENTS, RUN_LOG
from barloom.sources.files import delete_folder
from barloom.sources.tables import plain_numbers, stage

YEAR = T.StructField("year", T.IntegerType())
VERSION = T.StructField("version", T.IntegerType())
PART = T.StructField("part", T.LongType())
SEAL = T.StructField("seal", T.LongType())
RUN = T.StructField("dag_run_id", T.StringType())
WHY = [T.StructField("bad_date", T.StringType()), RUN, T.StructField("error_message", T.StringType()),
       T.StructField("row_hash", T.StringType())]
FACTS, SUMMARIES, COMMITS = "fact_stock_prices", "fact_days", "fact_commits"
COMMIT = "year int, part long"

# folder -> schema, partition columns
LAYOUT = {
    FACTS: (T.StructType([*FACT.fields, YEAR, PART]), ["year", "part"]),
    SUMMARIES: (T.StructType([*DAY_SUMMARY.fields, YEAR, PART]), ["year", "part"]),
    "dim_company": (T.StructType([*DIM_COMPANY.fields, VERSION]), ["version"]),
    "run_events": (RUN_EVENTS, ["dag_run_id"]),
    "run_log_closed": (T.StructType([*RUN_LOG.fields, SEAL]), ["seal"]),
    "run_log_seals": (T.StructType([T.StructField("dag_run_id", T.StringType()), T.StructField("is_sealed", T.BooleanType()),
                                    SEAL]), []),
    "staged_folders": (T.StructType([
        T.StructField("folder", T.StringType()), T.StructField("attempt", T.IntegerType()),
        T.StructField("is_there", T.BooleanType()), RUN]), []),
    "audit_quality_issues": (T.StructType([*ISSUES.fields, RUN]), ["dag_run_id"]),
    "ignored_rows": (T.StructType([RUN, T.StructField("ticker", T.StringType()), T.StructField("n_rows", T.LongType()),
                                   T.StructField("counted_to", T.DateType())]), ["dag_run_id"]),
    "quarantine": (T.StructType([*RAW_BARS.fields, *WHY]), ["dag_run_id"]),
    "landing_files": (T.StructType([
        T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()), T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()), T.StructField("n_rows", T.LongType()), RUN]), ["dag_run_id"]),
    "landing_backlog": (T.StructType([
        T.StructField("path", T.StringType()), T.StructField("ticker", T.StringType()),
        T.StructField("reason", T.StringType()), T.StructField("is_open", T.BooleanType()),
        T.StructField("seq", T.IntegerType()), RUN]), ["dag_run_id"]),
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits: dict[int, dict[int, list[int]]] = {0: {}}

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def bootstrap(self) -> "Warehouse":
        """Create the tables that do not exist yet; existing ones are left alone."""
        for folder, (schema, by) in LAYOUT.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(self.path(folder))
        self.spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(f"{self.path(COMMITS)}/commit=0")
        return self

    def read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(LAYOUT[folder][0]).parquet(self.path(folder))

    def append(self, folder: str, rows: DataFrame) -> int:
        """Append rows in the table's columns and types; returns their number, counted as they are written."""
        schema, by = LAYOUT[folder]
        seen = Observation()
        out = rows.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])
        out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").options(**plain_numbers(schema)).partitionBy(
            *by).parquet(self.path(folder))
        return seen.get["n"]

    # --- facts and their commits ------------------------------------------

    def last_commit(self) -> int:
        """Number of the newest commit, by the folder names in the file listing."""
        return max(self._commit_numbers())

    def _commit_numbers(self) -> set[int]:
        files = self.spark.read.format("binaryFile").load(f"{self.path(COMMITS)}/*").inputFiles()
        return {int(n[1]) for f in files if (n := re.search(r"/commit=(\d+)/", f))}

    def parts(self) -> dict[int, list[int]]:
        """The folders that count, by year, after the newest commit: one row a folder, read once."""
        number = self.last_commit()
        if number not in self._commits:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.path(COMMITS)}/commit={number}").collect()
            found: dict[int, list[int]] = {}
            for r in rows:
                found.setdefault(r["year"], []).append(r["part"])
            self._commits = {0: {}, number: found}
        return self._commits[number]

    def commit(self, parts: dict[int, list[int]]) -> None:
        """Make the given folders the ones that count. One file is written, so it takes effect at once."""
        rows = ", ".join(f"struct({y} AS year, {p}L AS part)" for y, ps in sorted(parts.items()) for p in ps)
        number = self.last_commit() + 1
        self.spark.range(1, numPartitions=1).selectExpr(f"inline(array({rows}))").write.mode("errorifexists").parquet(
            f"{self.path(COMMITS)}/commit={number}")

    def _counting(self, folder: str) -> DataFrame:
        """Rows of the folders that count; a filter on folder names, so no other one is opened."""
        parts = self.parts()
        if not parts:
            return self.read(folder).where(F.lit(False)).drop("part")
        cells = [c for y, ps in sorted(parts.items()) for c in (F.lit(y), F.array(*[F.lit(p).cast("long") for p in ps]))]
        counts = F.array_contains(F.create_map(*cells)[F.col("year")], F.col("part"))
        return self.read(folder).where(counts).drop("part")

    def fact(self) -> DataFrame:
        """Facts with their layout column ``year``, which date reports use to prune."""
        return self._counting(FACTS)

    def days(self) -> DataFrame:
        """One row per (ticker, year): its stored days as bits, and sums of its closes."""
        return by_ticker_and_year(self._counting(SUMMARIES))

    @staticmethod
    def in_layout(rows: DataFrame) -> DataFrame:
        """Rows dealt to tasks by year and ticker range.

        A (year, ticker) pair has at most 366 rows, so the ranges come out even, and a task writes
        into one or two years instead of all of them.
        """
        return rows.repartitionByRange(F.year("date"), "ticker")

    def append_fact(self, rows: DataFrame, run_ts=None, laid_out: bool = False) -> int:
        """Append rows clustered by year and ticker range; returns their number. ``laid_out`` rows are ``in_layout``."""
        rows = rows if laid_out else self.in_layout(rows)
        part, n = self._write_part(fact_rows(rows, run_ts).withColumn("year", F.year("date")))
        if n:
            added = self._summarise(part)
            parts = self.parts()
            self.commit(parts | {y: [*parts.get(y, []), part] for y in added})
        return n

    def _write_part(self, rows: DataFrame) -> tuple[int, int]:
        """Write fact rows ``in_layout`` into folders of their own, which do not count yet; their name and number of rows.

        The order begins with the folder columns, or the writer would sort once more.
        """
        part = uuid.uuid4().int >> 65
        n = self.append(FACTS, rows.withColumn("part", F.lit(part).cast("long")).sortWithinPartitions("year", "part", "ticker", "date"))
        return part, n

    def _summarise(self, part: int) -> list[int]:
        """Write the summaries of a part's folders, from its files alone; returns its years."""
        written = self.spark.read.schema(LAYOUT[FACTS][0]).option("basePath", self.path(FACTS)).parquet(
            f"{self.path(FACTS)}/year=*/part={part}")
        self.append(SUMMARIES, day_summary(written, "part"))
        return sorted({int(m[1]) for f in written.inputFiles() if (m := re.search(r"/year=(\d+)/", f))})

    def replace_years(self, rows: DataFrame) -> list[int]:
        """Put whole new contents in the place of the years that the rows belong to; returns these years.

        The rows are written beside the old ones, and a commit exchanges them; until then, and if it
        never comes, readers see the old ones. ``rows`` has the columns of ``fact()``.
        """
        part, n = self._write_part(self.in_layout(rows))
        if not n:
            return []
        years = self._summarise(part)
        self.commit(self.parts() | {y: [part] for y in years})
        return years

    def correct(self, corrections: DataFrame) -> list[int]:
        """Store corrected values of stored rows, with fresh metrics; returns the years that were rewritten.

        ``corrections`` has ticker, date and any of open, high, low, close and volume; a null keeps what is
        stored. See ``operators.corrections``; a key that is given twice, is not stored, or a value that breaks
        a rule of the table raises before anything is written.
        """
        given = stage(corrections)
        fresh = stage(fix.corrected_rows(self.fact(), given, sorted(self.parts()), stage))
        years = sorted(r["year"] for r in fresh.select("year").distinct().collect())  # bounded by the calendar
        if not years:
            return []
        return self.replace_years(fix.with_replaced(self.fact().where(F.col("year").isin(years)), fresh))

    def compact(self, most: int = 1) -> list[int]:
        """Merge the folders of years that have more than ``most``; returns these years."""
        years = sorted(y for y, parts in self.parts().items() if len(parts) > most)
        return self.replace_years(self.fact().where(F.col("year").isin(years))) if years else []

    def vacuum(self, keep: int = 1) -> int:
        """Delete fact folders that none of the newest ``keep`` commits counts; returns their number.

        Old folders serve readers that began before a rewrite; a writer must not be at work.
        """
        newest = [f"{self.path(COMMITS)}/commit={n}" for n in sorted(self._commit_numbers())[-keep:]]
        count = {(r["year"], r["part"]) for r in self.spark.read.schema(COMMIT).parquet(*newest).distinct().collect()}
        gone = 0
        for folder in (FACTS, SUMMARIES):
            there = {(int(m[1]), int(m[2])) for f in self.read(folder).inputFiles()
                     if (m := re.search(r"/year=(\d+)/part=(\d+)/", f))}
            for year, part in sorted(there - count):
                gone += delete_folder(self.spark, f"{self.path(folder)}/year={year}/part={part}")
        return gone

    # --- dimension ----------------------------------------------------------

    def dim(self) -> DataFrame:
        """The newest version of the dimension; no other one is read."""
        return self.read("dim_company").where(F.col("version") == self.dim_version()).drop("version")

    def dim_version(self) -> int:
        """Number of the newest version, by the folder names in the file listing; 0 before the first."""
        names = (re.search(r"/version=(\d+)/", f) for f in self.read("dim_company").inputFiles())
        return max((int(n[1]) for n in names if n), default=0)

    def upsert_dim(self, incoming: DataFrame, run_ts=None) -> None:
        check_companies(incoming)
        newest = self.dim_version()
        merged = upsert_dimension(self.dim(), incoming, run_ts)
        self.append("dim_company", merged.withColumn("version", F.lit(newest + 1)))

    # --- audit --------------------------------------------------------------

    def of_run(self, folder: str, dag_run_id: str | None) -> DataFrame:
        rows = self.read(folder)
        return rows if dag_run_id is None else rows.where(F.col("dag_run_id") == dag_run_id)

    def log(self, dag_run_id: str | None = None) -> DataFrame:
        """Run log, of one run or of all: what is sealed as it was stored, the rest folded from its events."""
        if dag_run_id is not None:
            return current_state(self.of_run("run_events", dag_run_id))
        sealed = self.seals()
        return self._closed_log(sealed).unionByName(current_state(self._open_events(sealed)))

    def seals(self) -> dict[str, int]:
        """The sealed runs with the number of their seal; one row a run, whatever its tickers."""
        newest = F.max_by(F.struct("is_sealed", "seal"), "seal").alias("newest")
        rows = self.read("run_log_seals").groupBy("dag_run_id").agg(newest).where("newest.is_sealed").collect()
        return {r["dag_run_id"]: r["newest"]["seal"] for r in rows}

    def _closed_log(self, sealed: dict[str, int]) -> DataFrame:
        """Stored rows of sealed runs, each from its newest seal; other seals' folders are not opened."""
        rows = self.read("run_log_closed")
        if not sealed:
            return rows.where(F.lit(False)).drop("seal")
        counts = self.spark.createDataFrame(sorted(sealed.items()), "dag_run_id string, seal long")
        return (rows.where(F.col("seal").isin(sorted(set(sealed.values()))))
                .join(counts, ["dag_run_id", "seal"], "left_semi").drop("seal").select(*RUN_LOG.fieldNames()))

    def _open_events(self, sealed: dict[str, int]) -> DataFrame:
        """Events of runs that are not sealed; a filter on folder names, so no other one is opened."""
        events = self.read("run_events")
        return events.where(~F.col("dag_run_id").isin(sorted(sealed))) if sealed else events

    def seal_log(self, before: Column | str | None = None) -> list[str]:
        """Store the log of closed runs as it stands, so that ``log()`` reads their events no more; returns their names.

        A run is closed when no task run of its last attempt is open and its newest event is older than
        ``before``, by default a day ago. Rows are stored first and count once their seal is, which is one file, so
        a crash leaves the log as it was. A run that starts another attempt is unsealed until it is sealed again.
        """
        sealed = self.seals()
        until = F.expr("current_timestamp() - INTERVAL 1 DAY") if before is None else before if isinstance(before, Column) else F.lit(before)
        events = self._open_events(sealed)
        ends = self.attempts(events).groupBy("dag_run_id").agg(
            F.max_by("n_open", "attempt").alias("n_open"), F.max("last_event").alias("last_event"))
        closed = stage(ends.where((F.col("n_open") == 0) & (F.col("last_event") < until.cast("timestamp_ntz"))).select("dag_run_id"))
        names = sorted(r["dag_run_id"] for r in closed.collect())  # a row a run
        if names:
            number = self._next_seal()
            self.append("run_log_closed", current_state(events.where(F.col("dag_run_id").isin(names))).withColumn("seal", F.lit(number)))
            self.append("run_log_seals", closed.select("dag_run_id", F.lit(True).alias("is_sealed"), F.lit(number).alias("seal")).coalesce(1))
        return names

    def unseal_log(self, dag_run_id: str) -> None:
        """Let a run's events tell its log again, before more of them come."""
        if dag_run_id in self.seals():
            self.append("run_log_seals", self.spark.range(1).select(
                F.lit(dag_run_id).alias("dag_run_id"), F.lit(False).alias("is_sealed"), F.lit(self._next_seal()).alias("seal")))

    def _next_seal(self) -> int:
        """Past every stored seal, also those of rows whose seal never came."""
        used = [self.read(t).agg(F.max("seal")).first()[0] or 0 for t in ("run_log_seals", "run_log_closed")]
        return max(used) + 1

    @staticmethod
    def attempts(events: DataFrame) -> DataFrame:
        """``(dag_run_id, attempt, n_open, last_event)`` of every attempt: its open task runs and its newest event."""
        task_runs = events.groupBy("dag_run_id", "attempt", "run_id").agg(
            F.max("event_seq").alias("last_seq"), F.max("event_at").alias("last_event"))
        return task_runs.groupBy("dag_run_id", "attempt").agg(
            F.count_if(F.col("last_seq") == 0).alias("n_open"), F.max("last_event").alias("last_event"))

    def issues(self, dag_run_id: str | None = None) -> DataFrame:
        """Issue log, of one run or of all."""
        return self.of_run("audit_quality_issues", dag_run_id).drop("dag_run_id")

    def last_attempt(self, dag_run_id: str) -> int:
        """Highest attempt that a run has logged, 0 if none."""
        return self.of_run("run_events", dag_run_id).agg(F.max("attempt")).first()[0] or 0

    def run_history(self, limit: int | None = 50) -> DataFrame:
        """``reports.run_history`` of the log, which aggregates the events of the newest task runs alone.

        Each map task keeps its newest START events; the few that are left prune the runs that are read.
        With ``limit=None`` the whole log is folded and sorted.
        """
        if limit is None:
            return reports.run_history(self.log(), None)
        sealed = self.seals()
        events = self._open_events(sealed)
        reports.check_limit(limit)
        newest = (events.where(F.col("event_seq") == 0).orderBy(F.desc("event_at"), F.desc("run_id")).limit(limit)
                  .select("dag_run_id", "run_id"))
        state = current_state(events.join(newest, ["dag_run_id", "run_id"], "left_semi"))
        return reports.run_history(self._closed_log(sealed).unionByName(state), limit)

    def run_log_recent(self, limit: int = 10) -> DataFrame:
        """``reports.run_log_recent`` of the log, from the same few events."""
        return self.run_history(limit).select("task_name", "ticker", "records_found", "records_inserted", "status")

    def unresolved_issues(self) -> DataFrame:
        """``reports.unresolved_issues`` without the log: issues lie under their run's name."""
        return reports.unresolved_issues(self.of_run("audit_quality_issues", None))

    def ignored_rows(self) -> DataFrame:
        """Landing rows of unlisted tickers that each run passed over, each counted by one run."""
        return self.read("ignored_rows")

    # --- rows that were not loaded ------------------------------------------

    def quarantine(self) -> DataFrame:
        """Rows that could not be loaded, each once, with the run that met them first and the reason."""
        return self.read("quarantine").drop("row_hash")

    def not_quarantined(self, rows: DataFrame) -> DataFrame:
        """Rows that the quarantine does not hold yet, equal ones once, with their ``row_hash``."""
        known = self.read("quarantine").select("row_hash").distinct()
        return rows.withColumn("row_hash", row_hash(rows)).dropDuplicates(["row_hash"]).join(known, "row_hash", "left_anti")

    def add_to_quarantine(self, rows: DataFrame, dag_run_id: str) -> int:
        """Store rows that are new to the quarantine; ``error_message`` says why. Returns their number."""
        new = self.not_quarantined(rows).withColumn("dag_run_id", F.lit(dag_run_id))
        absent = [f for f in LAYOUT["quarantine"][0].fields if f.name not in new.columns]
        return self.append("quarantine", new.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}))

    # --- staged tables of runs ----------------------------------------------

    def record_staged(self, dag_run_id: str, attempt: int, folder: str) -> None:
        """Put the folder of an attempt's staged tables on record, before any is written."""
        self.append("staged_folders", self.spark.range(1).select(
            F.lit(folder).alias("folder"), F.lit(attempt).alias("attempt"), F.lit(True).alias("is_there"),
            F.lit(dag_run_id).alias("dag_run_id")))

    def staged_folders(self) -> DataFrame:
        """``(folder, dag_run_id, attempt)`` of the folders on record that were not deleted."""
        return (self.read("staged_folders").groupBy("folder", "dag_run_id", "attempt")
                .agg(F.min("is_there").alias("is_there")).where("is_there").drop("is_there"))

    def expire_staged(self, before: Column | str) -> list[str]:
        """Delete staged tables of attempts that ended before a moment; returns the deleted folders.

        An attempt has ended when none of its task runs is open, or when a later attempt of its run has ended: a
        crashed one never closes. Attempts that run, or that have logged nothing yet, keep their tables.
        """
        until = before if isinstance(before, Column) else F.lit(before)
        ended = self.attempts(self.read("run_events")).where(
            (F.col("n_open") == 0) & (F.col("last_event") < until.cast("timestamp_ntz")))
        last = ended.groupBy("dag_run_id").agg(F.max("attempt").alias("last_ended"), F.collect_set("attempt").alias("ended"))
        gone = stage(self.staged_folders().join(last, "dag_run_id").where(
            (F.col("attempt") < F.col("last_ended")) | F.array_contains("ended", F.col("attempt")))
            .select("folder", "dag_run_id", "attempt"))
        folders = sorted(r["folder"] for r in gone.collect())  # a row an attempt
        for folder in folders:
            delete_folder(self.spark, folder)
        if folders:
            self.append("staged_folders", gone.withColumn("is_there", F.lit(False)))
        return folders

    # --- landing files that were read ---------------------------------------

    def consumed_files(self) -> DataFrame:
        """Landing files that runs have read to the end."""
        return self.read("landing_files")

    def backlog(self) -> DataFrame:
        """``(path, ticker, reason)`` of what consumed files still hold for a ticker: the newest entry tells."""
        newest = F.max_by(F.struct("reason", "is_open"), "seq").alias("newest")
        return (self.read("landing_backlog").groupBy("path", "ticker").agg(newest)
                .where("newest.is_open").select("path", "ticker", "newest.reason"))

    def next_backlog_seq(self) -> int:
        return (self.read("landing_backlog").agg(F.max("seq")).first()[0] or 0) + 1

    # --- reports ------------------------------------------------------------

    def close_stats(self) -> DataFrame:
        """``reports.close_stats`` from the yearly summaries; no fact row is read."""
        return reports.close_stats_of_years(self.days(), self.dim())

    def register(self) -> None:
        """Views for analyst SQL under the usual table names."""
        reports.register_views(self.spark, fact_stock_prices=self.fact(), dim_company=self.dim(),
                       audit_pipeline_log=self.log(), audit_quality_issues=self.issues())
