"""One query per operator, each over whole tables derived from the test data by Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.operators import constraints, dimension, enrich, ingest, load, quality, runlog
from barloom.operators.days import keys_in_days
from barloom.plans import reports
from barloom.plans.daily_run import Run, run_daily
from barloom.schemas import DIM_COMPANY, ENUMS, REQUIRED
from barloom.session import new_scratch
from barloom.sources.landing import LandingFolder, parse_bars, read_landing
from barloom.sources.tables import stage
from barloom.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
RUN = "run_1999-01-24"
BAR = ["date", "ticker", "open", "high", "low", "close", "volume"]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def _split(df: DataFrame, day: str = d.SPLIT_DAY) -> tuple[DataFrame, DataFrame]:
    """Rows before a day, and the rest."""
    cut = F.lit(day).cast("date")
    return df.where(F.col("date") < cut), df.where(F.col("date") >= cut)


def _two_runs(spark, sf, names: tuple[str, str] = ("first", "second")) -> Warehouse:
    """A warehouse after two runs over the damaged bars, up to the split day and up to the end."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    house.upsert_dim(d.dim(spark, sf), d.RUN_TS)
    landing = stage(d.dirty_bars(spark, sf))
    for name, until in zip(names, (d.SPLIT_DAY, d.INGEST_DAY), strict=True):
        run_daily(Run(house, name, until, d.RUN_TS, d.FIRST_DAY), landing, gate=False)
    return house


# --- sources, incremental scan, staging -------------------------------------

@query
def bars_source(spark, sf):
    """Bars through a CSV landing folder with upper-case headers."""
    path = new_scratch(spark, "landing")
    bars = d.bars(spark, sf)
    bars.toDF(*[c.upper() for c in bars.columns]).write.option("header", True).csv(path)
    return read_landing(spark, path, "csv").select(*BAR)


@query
def date_notations(spark, sf):
    """Bars through JSON files whose dates are written in three ways."""
    path, day = new_scratch(spark, "landing"), F.dayofmonth("date")
    text = (F.when(day % 3 == 0, F.date_format("date", "dd.MM.yyyy")).when(day % 3 == 1, F.date_format("date", "MM/dd/yyyy"))
            .otherwise(F.col("date").cast("string")))
    d.bars(spark, sf).withColumn("date", text).write.json(path)
    return read_landing(spark, path, "json", date_formats=("dd.MM.yyyy", "MM/dd/yyyy")).select(*BAR, "bad_date")


@query
def staged_bars(spark, sf):
    return stage(d.bars(spark, sf))


@query
def watermarks(spark, sf):
    return ingest.watermarks(_split(d.fact(spark, sf))[0])


@query
def incremental_filter(spark, sf):
    """Bars past each ticker's mark; the odd suppliers were last loaded a year earlier."""
    stored = _split(d.bars(spark, sf))[0].where(
        (F.substring("ticker", 2, 9).cast("bigint") % 2 == 0) | (F.col("date") < F.lit("1999-01-01").cast("date")))
    starts = stage(ingest.fetch_starts(d.dim(spark, sf), ingest.watermarks(stored), d.FIRST_DAY))
    return ingest.incremental_filter(d.bars(spark, sf), starts, d.INGEST_DAY)


@query
def empty_extracts(spark, sf):
    """Tickers without a bar between their mark and the fourth day of the year."""
    bars = d.bars(spark, sf)
    starts = stage(ingest.fetch_starts(d.dim(spark, sf), ingest.watermarks(_split(bars)[0]), d.FIRST_DAY))
    return ingest.empty_extracts(starts, ingest.incremental_filter(bars, starts, "2000-01-04"), "2000-01-04")


@query
def ignored_rows(spark, sf):
    """Bars of companies that the universe does not list, here those of one sector."""
    return ingest.ignored_rows(d.bars(spark, sf), d.dim(spark, sf).where(F.col("sector") != "NATION_3"), d.INGEST_DAY)


@query
def rerun_log(spark, sf):
    """A run and its rerun under one name: each task run has its own id, the second finds what is new to it."""
    house = _two_runs(spark, sf, ("same", "same"))
    return house.run_history(limit=None).groupBy("dag_run_id", "task_name", "status").agg(
        F.count("*").alias("entries"), F.countDistinct("run_id").alias("ids"),
        F.sum("records_found").alias("found"), F.sum("records_inserted").alias("inserted"))


@query
def sealed_rerun_log(spark, sf):
    """The same two runs, the log sealed after each: the second unseals what it adds to."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    house.upsert_dim(d.dim(spark, sf), d.RUN_TS)
    landing = stage(d.dirty_bars(spark, sf))
    for until in (d.SPLIT_DAY, d.INGEST_DAY):
        run_daily(Run(house, "same", until, d.RUN_TS, d.FIRST_DAY), landing, gate=False)
        house.seal_log()
    return house.log().groupBy("dag_run_id", "task_name", "status").agg(
        F.count("*").alias("entries"), F.countDistinct("run_id").alias("ids"),
        F.sum("records_found").alias("found"), F.sum("records_inserted").alias("inserted"))


def _landing_folder(spark, bars):
    """Landing files by month, in a format with types."""
    path = new_scratch(spark, "landing")
    bars.withColumn("month", F.date_format("date", "yyyyMM")).repartition("month").write.partitionBy("month").parquet(path)
    return LandingFolder(spark, path)


def _ledger_runs(spark, sf):
    """Three runs over one folder; the companies of a sector are listed after the first."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    house.upsert_dim(d.dim(spark, sf).where(F.col("sector") != "NATION_3"), d.RUN_TS)
    folder = _landing_folder(spark, d.dirty_bars(spark, sf))
    for name, until in (("first", d.SPLIT_DAY), ("second", d.INGEST_DAY), ("third", d.INGEST_DAY)):
        run_daily(Run(house, name, until, d.RUN_TS, d.FIRST_DAY), folder, gate=False)
        house.upsert_dim(d.dim(spark, sf), d.RUN_TS)
    return house


@query
def landing_folder_facts(spark, sf):
    """Facts after runs that open each landing file once, and again for companies listed later."""
    return _ledger_runs(spark, sf).fact().drop("year", "loaded_at")


@query
def landing_folder_ignored(spark, sf):
    """Rows of unlisted companies in those runs: counted by the run that opened their file, and by no other."""
    return _ledger_runs(spark, sf).ignored_rows().select("dag_run_id", "ticker", "n_rows")


@query
def landing_folder_log(spark, sf):
    """What those runs fetched and inserted, by ticker."""
    return _ledger_runs(spark, sf).log().groupBy("dag_run_id", "task_name", "status").agg(
        F.count("*").alias("entries"), F.sum("records_found").alias("found"), F.sum("records_inserted").alias("inserted"))


@query
def quarantined_rows(spark, sf):
    """What three runs could not load, each row once: unreadable dates as they came, bars of tickers that overflow."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    house.upsert_dim(d.dim(spark, sf), d.RUN_TS)
    number = F.substring("ticker", 2, 9).cast("bigint")
    huge = (number % 7 == 0) & F.col("date").endswith("-01")
    landing = stage(parse_bars(_text_dates(spark, sf).withColumn("high", F.when(huge, F.lit(1e8)).otherwise(F.col("high")))))
    for name, until in (("first", d.SPLIT_DAY), ("second", d.INGEST_DAY), ("third", d.INGEST_DAY)):
        run_daily(Run(house, name, until, d.RUN_TS, d.FIRST_DAY), landing, gate=False)
    return house.quarantine()


# --- enrichment -------------------------------------------------------------

@query
def enriched_bars(spark, sf):
    return enrich.add_metrics(d.bars(spark, sf))


@query
def enriched_by_year(spark, sf):
    """The same metrics with a window group per ticker and year."""
    return enrich.add_metrics_by_year(stage(d.bars(spark, sf)))


@query
def enrich_batch_scope(spark, sf):
    old, new = _split(d.bars(spark, sf))
    return enrich.enrich(old, scope="batch").unionByName(enrich.enrich(new, scope="batch"))


@query
def enrich_history_scope(spark, sf):
    """The later bars on top of the stored earlier ones."""
    old, new = _split(d.bars(spark, sf))
    return enrich.enrich(new, d.as_fact(enrich.add_metrics(old)), "history")


@query
def recompute_metrics(spark, sf):
    """Every ticker's first bar of 1998 or later is corrected by +100."""
    fact = d.fact(spark, sf)
    later = _split(d.bars(spark, sf), "1998-01-01")[1]
    corrections = (later.groupBy("ticker").agg(F.min("date").alias("date"), F.min_by("close", "date").alias("c"))
                   .select("ticker", "date", (F.col("c") + 100).alias("close")))
    return d.as_fact(enrich.recompute_metrics(fact, corrections)).drop("loaded_at")


# --- quality ----------------------------------------------------------------

def _checked(spark, sf):
    return quality.check_bars(d.dirty_bars(spark, sf))


def _issues_of(spark, sf, *checks):
    return quality.cascade_issues(_checked(spark, sf)).where(F.col("check_name").isin(*checks))


@query
def check_missing_columns(spark, sf):
    batch = d.dirty_bars(spark, sf).drop("close", "volume")
    return quality.missing_column_issues(batch.select("ticker").distinct(), quality.missing_columns(batch))


def _text_dates(spark, sf):
    """Dirty bars with text dates, those of every 13th day of a month being unreadable."""
    text = F.col("date").cast("string")
    return d.dirty_bars(spark, sf).withColumn(
        "date", F.when(F.dayofmonth("date") == 13, F.concat(F.lit("day "), text)).otherwise(text))


@query
def check_date_format(spark, sf):
    checked = quality.check_bars(parse_bars(_text_dates(spark, sf)))
    return quality.cascade_issues(checked).where(F.col("check_name") == "date_format")


@query
def verdicts_with_text_dates(spark, sf):
    return quality.verdict_counts(quality.check_bars(parse_bars(_text_dates(spark, sf))))


@query
def check_null_values(spark, sf):
    return _issues_of(spark, sf, "null_values")


@query
def check_duplicates(spark, sf):
    return _issues_of(spark, sf, "duplicate_rows")


@query
def check_negative_prices(spark, sf):
    return _issues_of(spark, sf, "negative_price")


@query
def check_high_low(spark, sf):
    return _issues_of(spark, sf, "high_lt_low")


@query
def check_volume(spark, sf):
    return _issues_of(spark, sf, "zero_volume", "negative_volume")


@query
def check_extreme_return(spark, sf):
    return quality.extreme_return_issues(enrich.add_metrics(quality.clean_bars(_checked(spark, sf))))


@query
def verdicts(spark, sf):
    return quality.verdict_counts(_checked(spark, sf))


@query
def clean_bars(spark, sf):
    return quality.clean_bars(_checked(spark, sf))


@query
def issues(spark, sf):
    """All issues of a batch, from one staged fold."""
    checked = stage(_checked(spark, sf))
    extreme = quality.extreme_return_issues(enrich.add_metrics(quality.clean_bars(checked)))
    return quality.cascade_issues(checked).unionByName(extreme)


@query
def quality_summary(spark, sf):
    checked = stage(_checked(spark, sf))
    return quality.batch_summary(checked, quality.cascade_issues(checked))


# --- load, constraints, dimension -------------------------------------------

@query
def typed_fact(spark, sf):
    return d.fact(spark, sf)


def _resent(spark, sf):
    """All bars again, with a copy of those of each 15th, where part of them is already stored."""
    bars = d.bars(spark, sf)
    stored = _split(bars)[0]
    copies = F.when(F.dayofmonth("date") == 15, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    batch = bars.select("*", F.explode(copies).alias("src_seq")).withColumn(
        "close", F.col("close") + 1 + F.col("src_seq"))
    return load.mark_existing(load.first_per_key(batch), load.stored_keys(stored, bars))


@query
def idempotent_load(spark, sf):
    """The fact keys after a second load that re-sends everything with other closes."""
    stored = _split(d.bars(spark, sf))[0].select(*BAR)
    return stored.unionByName(load.new_rows(_resent(spark, sf)).select(*BAR))


@query
def load_counts(spark, sf):
    return load.load_counts(_resent(spark, sf))


def _loaded(spark, sf):
    """A warehouse with the facts of all bars, stored by two loads."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    house.upsert_dim(d.dim(spark, sf), d.RUN_TS)
    for part in _split(stage(d.fact(spark, sf))):
        house.append_fact(part)
    return house


@query
def correction_applied(spark, sf):
    """The facts after every third ticker's first bar of 1998 or later was corrected by +100 and stored."""
    house = _loaded(spark, sf)
    later = _split(d.bars(spark, sf), "1998-01-01")[1].where(F.substring("ticker", 2, 9).cast("bigint") % 3 == 0)
    house.correct(later.groupBy("ticker").agg(F.min("date").alias("date"), (F.min_by("close", "date") + 100).alias("close")))
    return house.fact().drop("year", "loaded_at")


@query
def stored_keys(spark, sf):
    """Keys of all bars that a warehouse holds of the earlier half, by the bits of its summaries."""
    house = Warehouse(spark, new_scratch(spark, "warehouse")).bootstrap()
    facts = stage(d.fact(spark, sf))
    house.append_fact(_split(facts)[0])
    return keys_in_days(house.days(), facts)


@query
def close_stats_of_years(spark, sf):
    """``close_stats`` from yearly summaries of two loads, after the years were merged."""
    house = _loaded(spark, sf)
    house.compact()
    return house.close_stats()


@query
def ticker_isolation(spark, sf):
    """Outcome per ticker where prices of one in seven overflow once and one sector is unknown."""
    bars = d.bars(spark, sf)
    number = F.substring("ticker", 2, 9).cast("bigint")
    huge = (number % 7 == 0) & (F.dayofmonth("date") == 1)
    batch = enrich.add_metrics(bars.withColumn("high", F.when(huge, F.lit(1e8)).otherwise(F.col("high"))))
    known = d.dim(spark, sf).where(F.col("sector") != "NATION_3")
    failed = load.failed_tickers(batch, known).withColumnRenamed("error_message", "load_error")
    return bars.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows")).join(failed, "ticker", "left")


@query
def not_null_violations(spark, sf):
    return constraints.not_null_violations(d.dirty_bars(spark, sf), [*REQUIRED, "ticker"])


@query
def enum_violations(spark, sf):
    """Order states taken as run states and event types taken as severities."""
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").when(
        F.col("o_orderstatus") == "O", "SUCCESS").otherwise(F.col("o_orderstatus"))
    runs = d.table(spark, sf, "orders").select(status.alias("status"))
    events = d.table(spark, sf, "events").select(F.upper("event_type").alias("severity"))
    return constraints.enum_violations(runs, "status", ENUMS["audit_pipeline_log", "status"]).unionByName(
        constraints.enum_violations(events, "severity", ENUMS["audit_quality_issues", "severity"]))


@query
def length_violations(spark, sf):
    return constraints.length_violations(d.log(spark, sf), {"error_message": 8, "ticker": 10, "task_name": 7})


@query
def fk_orphans(spark, sf):
    """Bars of companies missing from the dimension, here those of one sector."""
    known = d.dim(spark, sf).where(F.col("sector") != "NATION_3")
    return constraints.fk_orphans(d.bars(spark, sf).select("date", "ticker"), "ticker", known, "ticker")


@query
def pk_violations(spark, sf):
    return constraints.pk_violations(d.dirty_bars(spark, sf), ["date", "ticker"])


@query
def dim_upsert(spark, sf):
    """Suppliers stored; those with an even key come again renamed, and every customer comes new."""
    stored = dimension.upsert_dimension(spark.createDataFrame([], DIM_COMPANY), d.dim(spark, sf), d.RUN_TS)
    changed = d.dim(spark, sf).where(F.substring("ticker", 2, 9).cast("bigint") % 2 == 0).withColumn(
        "company_name", F.concat("company_name", F.lit(" Ltd")))
    new = d.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("ticker"),
        F.col("c_name").alias("company_name"), F.lit(None).cast("string").alias("sector"))
    return dimension.upsert_dimension(stored, changed.unionByName(new), "2001-12-01 06:00:00")


@query
def surrogate_ids(spark, sf):
    """Ids hashed from the natural key: as many as there are task runs."""
    runs = d.log(spark, sf)
    ids = runs.select(runlog.run_id(F.col("dag_run_id"), F.col("task_name"), "ticker", F.col("run_id")).alias("id"))
    return ids.agg(F.count("id").alias("ids"), F.countDistinct("id").alias("distinct_ids"))


# --- run log, gate, whole runs ----------------------------------------------

@query
def run_log_state(spark, sf):
    """The run log rebuilt from START and END events."""
    runs = d.log(spark, sf)
    shared = ["run_id", "dag_run_id", "task_name", "ticker", "run_date"]
    start = runs.select(*shared, F.lit(0).alias("event_seq"), F.col("started_at").alias("event_at"),
                        F.lit("RUNNING").alias("status"))
    end = runs.where(F.col("status") != "RUNNING").select(
        *shared, F.lit(1).alias("event_seq"), F.col("finished_at").alias("event_at"), "status",
        *runlog.COUNTS, "error_message",
        runlog.details_json(ticker=F.col("ticker"), attempted=F.col("records_found")).alias("details"))
    state = runlog.current_state(runlog.as_events(start.unionByName(end, allowMissingColumns=True)))
    fields = F.from_json("details", "ticker string, attempted int")
    return state.withColumns({"details_ticker": fields["ticker"], "attempted": fields["attempted"]}).drop("details")


@query
def daily_run(spark, sf):
    """Two runs into an empty warehouse from damaged bars: counts per run, task and ticker."""
    house = _two_runs(spark, sf)
    return house.log().select("dag_run_id", "task_name", "ticker", "status", *runlog.COUNTS)


@query
def daily_run_facts(spark, sf):
    """The facts those two runs leave behind, metrics included."""
    house = _two_runs(spark, sf)
    return house.fact().drop("year", "loaded_at")


@query
def run_gate(spark, sf):
    return reports.run_gate(d.issues(spark, sf), d.log(spark, sf))


@query
def run_summary(spark, sf):
    return reports.run_summary(d.log(spark, sf), RUN)


@query
def run_summary_all(spark, sf):
    return reports.run_summary_all(d.log(spark, sf))


@query
def error_count(spark, sf):
    return reports.error_count(d.issues(spark, sf), d.log(spark, sf), RUN)


@query
def run_history(spark, sf):
    return reports.run_history(d.log(spark, sf))


@query
def run_log_recent(spark, sf):
    return reports.run_log_recent(d.log(spark, sf))


@query
def unresolved_issues(spark, sf):
    return reports.unresolved_issues(d.issues(spark, sf), d.log(spark, sf))


# --- analytical reports -----------------------------------------------------

@query
def best_performer(spark, sf):
    return reports.best_performer(d.fact(spark, sf), d.dim(spark, sf), d.AS_OF)


@query
def range_return(spark, sf):
    return reports.range_return(d.fact(spark, sf), d.dim(spark, sf), d.AS_OF)


@query
def most_volatile(spark, sf):
    return reports.most_volatile(d.fact(spark, sf), d.dim(spark, sf), d.AS_OF)


@query
def close_stats(spark, sf):
    return reports.close_stats(d.fact(spark, sf), d.dim(spark, sf))


@query
def price_trend(spark, sf):
    return reports.price_trend(d.fact(spark, sf), d.dim(spark, sf), d.AS_OF)
