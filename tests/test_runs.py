"""Run log, gate, warehouse tables and whole runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import RAW

from barloom import derived as d
from barloom.operators import enrich, quality, runlog
from barloom.operators.constraints import enum_violations, fk_orphans, pk_violations
from barloom.operators.dimension import company_seed
from barloom.plans import reports
from barloom.plans.daily_run import MissingDate, Run, TickerFailed, run_daily, run_ticker
from barloom.schemas import FACT, ISSUES, RUN_LOG, STATUSES
from barloom.session import new_scratch
from barloom.sources.warehouse import Warehouse

TS = "2020-03-01 06:00:00"


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    """Runs here have a handful of rows: compiling their plans would take most of the time."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
                "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


TICKERS = ["AAA", "BBB", "GOOD", "WARN", "ERRS", "HUGE", "GONE", "NONE"]


def new_house(spark):
    w = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    w.upsert_dim(spark.createDataFrame([(t, f"{t} Inc", "x") for t in TICKERS],
                                       "ticker string, company_name string, sector string"), TS)
    return w


@pytest.fixture
def house(spark):
    return new_house(spark)


def bars(spark, rows):
    """Raw bars from (ticker, day of January 2020, fields that differ from a good bar)."""
    out = []
    for seq, (ticker, day, change) in enumerate(rows):
        bar = {"date": dt.date(2020, 1, day), "ticker": ticker, "open": 10.0, "high": 30.0, "low": 9.0, "close": 11.0,
               "volume": 100, "src_seq": seq} | change
        out.append(tuple(bar.values()))
    return spark.createDataFrame(out, RAW)


SCENE = [
    *[("GOOD", i, {"close": 10.0 + i * i % 7}) for i in range(1, 13)],
    ("WARN", 1, {}), ("WARN", 2, {"volume": 0}), ("WARN", 3, {"close": 17.5}),
    ("ERRS", 1, {}), ("ERRS", 1, {"close": 1.0}), ("ERRS", 2, {"high": 1.0}), ("ERRS", 3, {"volume": -1}), ("ERRS", 5, {}),
    # damaged at the end of the first run, so fetched and rejected again by the second
    ("ERRS", 8, {"low": None}), ("ERRS", 9, {"open": -1.0}), ("ERRS", 10, {}),
    ("HUGE", 1, {}), ("HUGE", 2, {"high": 1e8}),
    ("GONE", 1, {"close": None}), ("GONE", 2, {"open": 0.0}),
]


@pytest.fixture(scope="module")
def scene(spark, small_plans):
    """Two runs over tickers that each show one case; the second starts on the tenth."""
    w = new_house(spark)
    landing = bars(spark, SCENE)
    return w, landing, go(w, landing, "r1", "2020-01-10", gate=False), go(w, landing, "r2", "2020-02-01", gate=False)


def go(house, landing, name="r1", as_of="2020-02-01", gate=True, **kw):
    return {r.task_name: r for r in run_daily(Run(house, name, as_of, TS, **kw), landing, gate=gate).collect()}


# --- run log ----------------------------------------------------------------

def test_state_of_open_and_closed_runs(spark):
    tickers = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "ticker string")
    done = spark.createDataFrame([("AAA", 5, None, '{"n":5}'), ("BBB", 0, "boom", None)],
                                 "ticker string, records_found int, error_message string, details string")
    events = runlog.start_events(tickers, "r", "load", "2020-01-01 00:00:00").unionByName(
        runlog.end_events(done, "r", "load", "2020-01-01 00:00:09"))
    rows = {r.ticker: r for r in runlog.current_state(events).collect()}
    assert {t: (r.status, r.records_found, r.error_message) for t, r in rows.items()} == {
        "AAA": ("SUCCESS", 5, None), "BBB": ("FAILED", 0, "boom"), "CCC": ("RUNNING", 0, None)}
    assert rows["AAA"].finished_at - rows["AAA"].started_at == dt.timedelta(seconds=9)
    assert rows["CCC"].finished_at is None and rows["CCC"].run_date == dt.date(2020, 1, 1)
    assert runlog.current_state(events).columns == [f.name for f in RUN_LOG.fields]


def test_retry_has_its_own_id(spark):
    tickers = spark.createDataFrame([("AAA",)], "ticker string")
    ids = [runlog.start_events(tickers, "r", "load", TS, a).first().run_id for a in (1, 2, 1)]
    assert ids[0] == ids[2] != ids[1]


def test_duration_rounds_half_to_even(spark):
    at = dt.datetime(2020, 1, 1)
    log = spark.createDataFrame([(i, at, at + dt.timedelta(microseconds=us)) for i, us in
                                 enumerate([2_500_000, 3_500_000, 2_500_001, 0])],
                                "run_id bigint, started_at timestamp_ntz, finished_at timestamp_ntz")
    for f in RUN_LOG.fields:
        if f.name not in log.columns:
            log = log.withColumn(f.name, F.lit(None).cast(f.dataType))
    assert {r.run_id: r.duration_sec for r in reports.run_history(log).collect()} == {0: 2, 1: 4, 2: 3, 3: 0}


# --- warehouse --------------------------------------------------------------

def test_tables_and_versions(spark, house):
    assert house.bootstrap().dim().count() == len(TICKERS)
    assert house.fact().count() == house.log().count() == house.issues().count() == 0
    house.upsert_dim(company_seed(spark), "2020-04-01 00:00:00")
    rows = {r.ticker: r for r in house.dim().collect()}
    assert len(rows) == len(TICKERS) + 10 and rows["AAA"].created_at == dt.datetime(2020, 3, 1, 6)
    assert rows["V"].sector == "Financial Services"


# --- whole runs: the scene --------------------------------------------------

def test_summaries(scene):
    first, second = [{t: (r.found, r.inserted, r.skipped, r.invalid, r.failed_tasks) for t, r in got.items()}
                     for got in scene[2:]]
    # clean rows: GOOD 9, WARN 3, ERRS 2, HUGE 2; errors: ERRS 5, GONE 2
    assert first == {"extract": (23, 0, 0, 0, 0), "transform": (16, 0, 0, 7, 0), "load": (14, 14, 0, 0, 1)}
    # again: ERRS 8, 9 and the new 10, HUGE 2, GONE 2, and GOOD 10 to 12
    assert second == {"extract": (10, 0, 0, 0, 0), "transform": (6, 0, 0, 4, 0), "load": (4, 4, 0, 0, 1)}


def test_facts_equal_one_clean_load(spark, scene):
    house, landing = scene[:2]
    wanted = d.as_fact(enrich.add_metrics(quality.clean_bars(quality.check_bars(
        landing.where("ticker NOT IN ('HUGE', 'GONE')"))))).drop("loaded_at")
    got = house.fact().select(wanted.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    assert {r.loaded_at for r in house.fact().collect()} == {dt.datetime(2020, 3, 1, 6)}
    assert set(FACT.fieldNames()) < set(house.fact().columns)


def test_issues(scene):
    house = scene[0]
    got = sorted((r.ticker, r.check_name, r.n) for r in house.issues("r1").groupBy(
        "ticker", "check_name").agg(F.count("*").alias("n")).collect())
    assert got == [("ERRS", "duplicate_rows", 1), ("ERRS", "high_lt_low", 1), ("ERRS", "negative_price", 1),
                   ("ERRS", "negative_volume", 1), ("ERRS", "null_values", 1), ("GONE", "negative_price", 1),
                   ("GONE", "null_values", 1), ("WARN", "extreme_return", 1), ("WARN", "zero_volume", 1)]
    assert house.issues().columns == ISSUES.fieldNames()


def test_details_and_log(scene):
    log = {(r.task_name, r.ticker): r for r in scene[0].log("r1").collect()}
    details = {k: json.loads(r.details) for k, r in log.items() if r.details}
    assert details["extract", "WARN"] == {"start": "2020-01-01", "rows_fetched": 3}
    assert details["extract", "NONE"] == {"start": "2020-01-01", "rows_fetched": 0, "reason": "empty_response"}
    # the summary is taken before returns are checked
    assert details["transform", "WARN"] == {"ticker": "WARN", "total_issues": 1, "errors": 0, "warnings": 1, "checks_passed": False}
    assert details["transform", "GOOD"]["checks_passed"] is True
    assert details["load", "GOOD"] == {"ticker": "GOOD", "attempted": 9}
    # a ticker without rows, or without clean rows, has no entry for the steps it skipped
    assert {t for t, n in log if n == "NONE"} == {"extract"} and {t for t, n in log if n == "GONE"} == {"extract", "transform"}
    assert (log["transform", "GONE"].records_found, log["transform", "GONE"].records_invalid) == (0, 2)
    start = {r.ticker: json.loads(r.details)["start"] for r in scene[0].log("r2").where("task_name = 'extract'").collect()}
    assert start["ERRS"] == "2020-01-06" and start["HUGE"] == "2020-01-01"


def test_failed_ticker_goes_to_quarantine_alone(scene):
    house = scene[0]
    kept = house.quarantine().where("dag_run_id = 'r1'").collect()
    assert sorted((r.ticker, r.high) for r in kept) == [("HUGE", 30.0), ("HUGE", 1e8)]
    assert {r.error_message for r in kept} == {"numeric field overflow in column high"}
    failed = house.log("r1").where("status = 'FAILED'").collect()
    assert [(r.task_name, r.ticker, r.records_found) for r in failed] == [("load", "HUGE", 0)]


def test_a_run_reads_its_own_part_of_the_audit_tables(scene):
    for df in (scene[0].issues("r1"), scene[0].log("r1")):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dag_run_id" in text and "= r1)]" in text


def test_a_run_needs_an_id(house):
    with pytest.raises(ValueError):
        Run(house, "")


def test_constraints_hold(scene):
    house = scene[0]
    log, issues, fact = house.log(), house.issues(), house.fact()
    assert pk_violations(fact, ["date", "ticker"]).count() == 0
    assert pk_violations(issues, ["issue_id"]).count() == pk_violations(log, ["run_id"]).count() == 0
    assert fk_orphans(issues, "run_id", log, "run_id").count() == 0
    assert fk_orphans(fact, "ticker", house.dim(), "ticker").count() == 0
    assert enum_violations(log, "status", STATUSES).count() == 0
    assert issues.where("resolved").count() == 0


def test_analyst_sql_over_the_views(spark, scene):
    scene[0].register()
    rows = spark.sql("""
        SELECT f.ticker, c.company_name, round(avg(f.close), 2) AS m, count(*) FILTER (WHERE f.daily_return > 0) AS ups
        FROM fact_stock_prices f JOIN dim_company c USING (ticker)
        WHERE f.date >= DATE '2020-01-02' - INTERVAL '90 days' GROUP BY f.ticker, c.company_name ORDER BY 1""").collect()
    assert [(r.ticker, str(r.m), r.ups) for r in rows if r.ticker == "WARN"] == [("WARN", "13.17", 1)]
    assert spark.sql("SELECT count(*) AS n FROM audit_pipeline_log WHERE status = 'FAILED'").first().n == 2


# --- whole runs: one case each ----------------------------------------------

def test_gate(spark, house):
    landing = bars(spark, [("AAA", 1, {}), ("AAA", 2, {"open": -1.0}), ("AAA", 3, {}), ("AAA", 4, {"volume": 0})])
    with pytest.raises(reports.GateFailed, match="1 unresolved"):
        go(house, landing, "r1", "2020-01-04")
    assert house.fact().count() == 2  # clean rows are stored all the same
    # a warning passes, and another run's error is no concern of this one
    assert go(house, landing, "r2")["load"].inserted == 1
    # tickers without rows can be logged, and an empty run passes
    again = go(house, landing, "r3", log_empty=True)
    assert {t: r.found for t, r in again.items()} == {"extract": 0, "transform": 0, "load": 0}
    assert house.log("r3").count() == 3 * len(TICKERS) and house.log("r3").where("status <> 'SUCCESS'").count() == 0


def test_missing_column_fails_the_batch(spark, house):
    with pytest.raises(reports.GateFailed):
        go(house, bars(spark, [("AAA", 1, {}), ("BBB", 1, {})]).drop("close"))
    assert house.fact().count() == 0
    assert {(r.ticker, r.status) for r in house.log().where("task_name = 'transform'").collect()} == {
        ("AAA", "FAILED"), ("BBB", "FAILED")}
    assert [r.check_name for r in house.issues().collect()] == ["missing_columns"] * 2
    with pytest.raises(MissingDate):
        go(house, bars(spark, [("AAA", 1, {})]).drop("date"), "r2")
    assert {r.status for r in house.log("r2").collect()} == {"FAILED"}


def test_crash_before_the_load_is_repaired_by_a_rerun(spark, house, monkeypatch):
    landing = bars(spark, [("AAA", 1, {}), ("BBB", 1, {})])
    monkeypatch.setattr(Warehouse, "append_fact", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        go(house, landing)
    monkeypatch.undo()
    assert {r.status for r in house.log().where("task_name = 'load'").collect()} == {"RUNNING"}
    assert go(house, landing, attempt=2)["load"].inserted == 2
    assert house.fact().count() == 2


def test_one_ticker_at_a_time(spark, house):
    landing = bars(spark, [(t, i, {}) for t in ("AAA", "BBB") for i in (1, 2)])
    assert run_ticker(Run(house, "r1", "2020-02-01", TS, scope="batch"), landing, "BBB") == {"inserted": 2, "skipped": 0}
    with pytest.raises(TickerFailed, match="load of AAA: numeric field overflow"):
        run_ticker(Run(house, "r2", "2020-02-01", TS), landing.withColumn("high", F.lit(1e8)), "AAA")
    assert {r.ticker for r in house.fact().collect()} == {"BBB"}


def test_look_back_reaches_past_a_year_of_silence(spark, house):
    """Six rows long ago and two lately: the increment still sees all eight."""
    old = bars(spark, [("AAA", i, {"close": 10.0 + i}) for i in range(1, 7)])
    late = bars(spark, [("AAA", i, {"close": 20.0 + i * i / 4}) for i in range(1, 5)]).withColumn("date", F.add_months("date", 36))
    landing = old.unionByName(late)
    go(house, landing, "r1", "2023-01-03")
    go(house, landing, "r2", "2023-02-01")
    wanted = d.as_fact(enrich.add_metrics(landing.drop("src_seq"))).drop("loaded_at")
    assert sorted(map(tuple, house.fact().select(wanted.columns).collect()), key=str) == sorted(
        map(tuple, wanted.collect()), key=str)


def test_a_rerun_is_the_next_attempt(spark, house):
    landing = bars(spark, [("AAA", 1, {}), ("AAA", 2, {})])
    with pytest.raises(TickerFailed):
        run_ticker(Run(house, "r1", "2020-02-01", TS), landing.withColumn("high", F.lit(1e8)), "AAA")
    # repaired, the second attempt succeeds though the first left a FAILED entry
    second = Run(house, "r1", "2020-02-01", TS)
    assert second.attempt == 2 and run_ticker(second, landing, "AAA") == {"inserted": 2, "skipped": 0}
    with pytest.raises(ValueError, match="in the log already"):
        Run(house, "r1", attempt=2)
    log = house.log("r1")
    assert pk_violations(log, ["run_id"]).count() == 0
    assert sorted(r.status for r in log.where("task_name = 'load'").collect()) == ["FAILED", "SUCCESS"]


def test_rows_of_unlisted_tickers_are_counted(spark, house):
    landing = bars(spark, [("AAA", 1, {}), ("WHO", 1, {}), ("WHO", 2, {}), (None, 1, {}), ("WHO", 30, {})])
    go(house, landing, as_of="2020-01-20")
    assert {(r.dag_run_id, r.ticker, r.n_rows) for r in house.ignored_rows().collect()} == {("r1", "WHO", 2), ("r1", None, 1)}


def test_audit_reports_of_the_warehouse(spark, scene):
    house = scene[0]
    for limit in (3, 50):
        assert house.run_history(limit).collect() == reports.run_history(house.log(), limit).collect()
    got, wanted = house.unresolved_issues(), reports.unresolved_issues(house.issues(), house.log())
    assert got.columns == wanted.columns and got.collect() == wanted.collect() != []
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_only_the_newest_dimension_is_read(spark, house):
    house.upsert_dim(company_seed(spark), "2020-04-01 00:00:00")
    assert house.dim_version() == 2
    text = house.dim()._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "(version" in text and "= 2)" in text
