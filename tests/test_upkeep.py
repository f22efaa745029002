"""Metrics by year, date notations, the sealed log, and the expiry of staged tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import enrich
from barloom.plans import reports
from barloom.plans.daily_run import Run, run_daily
from barloom.session import new_scratch
from barloom.sources.landing import parse_bars, read_landing
from barloom.sources.tables import stage
from barloom.sources.warehouse import Warehouse

BAR = "date date, ticker string, open double, high double, low double, close double, volume bigint"
ALL = "2100-01-01 00:00:00"


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
                "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def some_bars(spark, plan, seed=0):
    """Random closes from (ticker, first year, last year, days between rows)."""
    rng, out = random.Random(seed), []
    for ticker, first, last, step in plan:
        day = dt.date(first, 1, 1)
        while day.year <= last:
            price = rng.randint(1000, 9000) / 100
            out.append((day, ticker, price, price + 5, price - 5, price + rng.randint(-4, 4), rng.randint(1, 99)))
            day += dt.timedelta(days=step)
    rng.shuffle(out)
    return spark.createDataFrame(out, BAR)


def rows(df):
    names = sorted(df.columns)
    return sorted(map(tuple, df.select(names).collect()), key=str)


# daily, quarterly, yearly and rarer rows: a year's seven earlier rows lie in one to more than seven years before
PLAN = [("DAILY", 1998, 2001, 1), ("QUARTER", 1990, 2001, 90), ("YEAR", 1980, 2001, 366), ("RARE", 1950, 2001, 1100),
        ("ONE", 2000, 2000, 400), ("GAP", 1990, 1991, 30), ("GAP", 2000, 2001, 30)]


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_by_year_are_those_of_whole_histories(spark, seed):
    bars = stage(some_bars(spark, PLAN, seed))
    assert rows(enrich.add_metrics_by_year(bars)) == rows(enrich.add_metrics(bars))
    assert rows(enrich.add_metrics_by_year(bars.limit(0))) == []


def test_by_year_after_stored_rows(spark):
    bars = stage(some_bars(spark, PLAN))
    cut = F.lit("2000-06-01").cast("date")
    old, new = bars.where(F.col("date") < cut), bars.where(F.col("date") >= cut)
    fact = enrich.add_metrics(old).select("ticker", "date", "close")
    assert rows(enrich.enrich(new, fact, by_year=True)) == rows(enrich.enrich(new, fact))
    assert rows(enrich.enrich(new, by_year=True, scope="batch")) == rows(enrich.enrich(new, scope="batch"))


def test_ten_tickers_use_more_than_ten_tasks(spark):
    """Every group of the metric windows is a ticker's year, so a century of ten tickers spreads."""
    bars = stage(some_bars(spark, [(f"T{i}", 1900, 1999, 30) for i in range(10)]))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # the filter keeps the windows from being pruned
        used = [enrich_(bars).where("moving_avg_7 > 0").select(F.spark_partition_id().alias("p")).distinct().count()
                for enrich_ in (enrich.add_metrics, enrich.add_metrics_by_year)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert used[0] <= 10 and used[1] == 40


def test_date_notations(spark, tmp_path):
    texts = ["2020-01-05", "05.01.2020", "01/05/2020", "1/5/2020", "31/12/2020", "2020-01-05 10:11:12", " 05.01.2020 ", "", None, "soon"]
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, date string")
    found = {r.n: (r.date, r.bad_date) for r in parse_bars(raw, ("dd.MM.yyyy", "M/d/yyyy")).collect()}
    fifth = dt.date(2020, 1, 5)
    assert [found[i] for i in range(10)] == [
        (fifth, None), (fifth, None), (fifth, None), (fifth, None), (None, "31/12/2020"), (fifth, None), (fifth, None),
        (None, None), (None, None), (None, "soon")]
    # the first notation that fits decides, and without any only ISO is read
    both = spark.createDataFrame([("02/03/2020",)], "date string")
    assert parse_bars(both, ("dd/MM/yyyy", "MM/dd/yyyy")).first().date == dt.date(2020, 3, 2)
    assert parse_bars(both, ("MM/dd/yyyy", "dd/MM/yyyy")).first().date == dt.date(2020, 2, 3)
    assert parse_bars(both).first().date is None
    path = str(tmp_path / "in")
    raw.where("date IS NOT NULL").select("date").write.option("header", True).csv(path)
    assert read_landing(spark, path, "csv", date_formats=["dd.MM.yyyy"]).where(F.col("date") == F.lit(fifth)).count() == 4


def landing_rows(spark):
    return stage(some_bars(spark, PLAN[:2]).withColumn("src_seq", F.monotonically_increasing_id()))


@pytest.fixture
def house(spark):
    w = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    w.upsert_dim(spark.createDataFrame([("DAILY", "Daily Inc", "x"), ("QUARTER", "Quarter Inc", "x")],
                                       "ticker string, company_name string, sector string"), "2020-01-01 00:00:00")
    return w


def go(house, landing, name, day, **options):
    run = Run(house, name, day, f"{day} 06:00:00", "1990-01-01", **options)
    run_daily(run, landing, gate=False)
    return run


def logged(house, landing, name, day):
    """What a run leaves in the log and the shared folder, without its work."""
    run = Run(house, name, day, f"{day} 06:00:00", "1990-01-01")
    tickers = house.dim().select("ticker")
    run.begin()
    run.stage(landing.limit(5), "batch")
    run.log(run.started("extract", tickers))
    run.log(run.finished("extract", tickers), run.started("load", tickers))
    run.log(run.finished("load", tickers.withColumn("records_found", F.lit(5))))
    return run


def test_sealed_log(spark, house):
    landing = landing_rows(spark)
    logged(house, landing, "a:1/x", "2000-01-01")
    logged(house, landing, "b", "2000-06-01")
    whole = rows(house.log())
    recent = house.run_log_recent(3).collect()
    assert house.seal_log("1999-01-01 00:00:00") == [] and not house.seals()
    assert house.seal_log("2000-02-01 00:00:00") == ["a:1/x"]
    assert rows(house.log()) == whole and rows(house.log("b")) + rows(house.log("a:1/x")) == rows(house.log("b")) + [
        r for r in whole if "a:1/x" in r]
    assert house.run_log_recent(3).collect() == recent == reports.run_log_recent(house.log(), 3).collect()
    assert rows(house.run_history(limit=None)) == rows(house.run_history(limit=100))

    # a new attempt unseals the run; crashed, it keeps it open
    run = Run(house, "a:1/x", "2000-07-01", "2000-07-01 06:00:00", "1990-01-01")
    run.begin()
    assert not house.seals()
    run.log(run.started("extract", house.dim()))
    assert rows(house.log()) != whole and house.seal_log(ALL) == ["b"]
    logged(house, landing, "a:1/x", "2001-06-01")
    whole = rows(house.log())
    assert house.seal_log(ALL) == ["a:1/x"] and rows(house.log()) == whole
    assert house.seal_log(ALL) == [] and len(house.seals()) == 2
    assert house.log().where("status = 'RUNNING'").count() == 2


def test_sealed_events_are_not_opened(spark, house):
    landing = landing_rows(spark)
    logged(house, landing, "old", "2000-01-01")
    house.seal_log(ALL)
    logged(house, landing, "new", "2000-06-01")
    whole = rows(house.log())
    for name in os.listdir(house.path("run_events")):  # an unreadable file shows who opens it
        if name == "dag_run_id=old":
            for file in os.listdir(f"{house.path('run_events')}/{name}"):
                if file.endswith(".parquet"):
                    with open(f"{house.path('run_events')}/{name}/{file}", "wb") as f:
                        f.write(b"broken")
    assert rows(house.log()) == whole and house.run_log_recent(5).count() == 5
    assert house.run_history(50).count() == len(whole)


def test_rows_without_their_seal_do_not_count(spark, house):
    logged(house, landing_rows(spark), "a", "2000-01-01")
    whole = rows(house.log())
    # as a crash between the two writes leaves it
    house.append("run_log_closed", house.log().withColumn("seal", F.lit(1)))
    assert rows(house.log()) == whole
    assert house.seal_log(ALL) == ["a"] and house.seals() == {"a": 2} and rows(house.log()) == whole


def test_staged_tables_expire(spark, house):
    landing = landing_rows(spark)
    first = go(house, landing, "a", "2000-01-01", by_year=True)
    second = logged(house, landing, "b", "2000-06-01")
    crashed = Run(house, "c", "2000-07-01", "2000-07-01 06:00:00", "1990-01-01")
    crashed.begin()
    crashed.log(crashed.started("extract", house.dim()))
    crashed.stage(landing, "batch")
    silent = Run(house, "d", "2000-07-01", "2000-07-01 06:00:00", "1990-01-01")
    silent.begin()
    silent.stage(landing, "batch")
    assert house.fact().count() > 0
    assert house.staged_folders().count() == 4
    assert house.expire_staged("2000-01-01 00:00:00") == []
    assert house.expire_staged("2000-02-01 00:00:00") == [first.folder]
    assert not os.path.exists(first.folder) and os.path.exists(second.folder)
    assert house.expire_staged(ALL) == [second.folder]
    assert os.path.exists(f"{crashed.folder}/batch") and os.path.exists(f"{silent.folder}/batch")
    # a later attempt that ends lets the crashed one go too
    again = logged(house, landing, "c", "2000-08-01")
    assert sorted(house.expire_staged(ALL)) == sorted([crashed.folder, again.folder])
    assert house.expire_staged(ALL) == [] and [r.folder for r in house.staged_folders().collect()] == [silent.folder]
