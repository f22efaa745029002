"""Incremental range, constraints, storage types, load outcomes and the dimension."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.operators import constraints, dimension, ingest, load
from barloom.operators.enrich import add_metrics
from barloom.schemas import COMPANIES, DIM_COMPANY, FACT, PRIMARY_KEYS, TABLES, required_columns

DAY = dt.date(2020, 1, 1)
METRIC_BAR = ("date date, ticker string, open double, high double, low double, close double, volume bigint, "
              "daily_return double, moving_avg_7 double, volatility_7 double")


def bar(day, ticker="AAA", **change):
    row = {"date": dt.date(2020, 1, day) if day else None, "ticker": ticker, "open": 1.0, "high": 2.0, "low": 1.0,
           "close": 1.5, "volume": 10, "daily_return": None, "moving_avg_7": 1.5, "volatility_7": None}
    return tuple((row | change).values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), METRIC_BAR)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("AAA", "A Inc", "x"), ("BBB", "B Inc", None), ("CCC", "C Inc", "y")],
                                 "ticker string, company_name string, sector string")


# --- incremental range ------------------------------------------------------

def test_start_follows_the_mark_or_the_default(spark, dim):
    marks = ingest.watermarks(frame(spark, bar(3), bar(9), bar(5, "BBB")))
    got = {r.ticker: r.start for r in ingest.fetch_starts(dim, marks).collect()}
    assert got == {"AAA": dt.date(2020, 1, 10), "BBB": dt.date(2020, 1, 6), "CCC": dt.date(2020, 1, 1)}


def test_range_is_half_open_and_per_ticker(spark, dim):
    starts = spark.createDataFrame([("AAA", dt.date(2020, 1, 5)), ("BBB", dt.date(2020, 1, 2))], "ticker string, start date")
    bars = frame(spark, *[bar(i, t) for i in range(1, 9) for t in ("AAA", "BBB", "ZZZ")])
    got = sorted((r.ticker, r.date.day) for r in ingest.incremental_filter(bars, starts, "2020-01-07").collect())
    assert got == [("AAA", 5), ("AAA", 6)] + [("BBB", i) for i in range(2, 7)]


def test_rows_without_a_date_are_passed_on(spark):
    starts = spark.createDataFrame([("AAA", DAY)], "ticker string, start date")
    assert ingest.incremental_filter(frame(spark, bar(None), bar(1)), starts, "2020-01-07").count() == 2


@pytest.mark.parametrize("start,outcome", [("2020-01-04", "expected"), ("2020-01-05", "expected"), ("2020-01-06", "WARN"),
                                           ("2020-01-03", "WARN"), ("2020-01-08", "expected")])
def test_empty_extract(spark, start, outcome):
    """Saturday and Sunday are expected, a weekday before as_of is not; as_of itself is."""
    starts = spark.createDataFrame([("AAA", dt.date.fromisoformat(start))], "ticker string, start date")
    row = ingest.empty_extracts(starts, frame(spark, bar(1, "BBB")), "2020-01-08").first()
    assert (row.outcome, row.rows_fetched, row.reason) == (outcome, 0, "empty_response")


# --- constraints ------------------------------------------------------------

def test_constraints(spark):
    df = frame(spark, bar(1), bar(1), bar(2, "TOOLONGTICKER", open=None), bar(None, None))
    assert {r["column"]: r.violations for r in constraints.not_null_violations(df, ["date", "ticker", "open", "low"]).collect()} == {
        "date": 1, "ticker": 1, "open": 1}
    assert [tuple(r) for r in constraints.pk_violations(df, PRIMARY_KEYS["fact_stock_prices"]).collect()] == [(DAY, "AAA", 2)]
    assert [tuple(r) for r in constraints.length_violations(df, {"ticker": 10}).collect()] == [("ticker", 1)]
    assert [tuple(r) for r in constraints.enum_violations(df, "ticker", ["AAA"]).collect()] == [("TOOLONGTICKER", 1)]
    parent = spark.createDataFrame([("AAA",)], "t string")
    assert [r.ticker for r in constraints.fk_orphans(df, "ticker", parent, "t").collect()] == ["TOOLONGTICKER"]


def test_schemas_name_their_required_columns():
    assert required_columns("fact_stock_prices") == ["date", "ticker", "open", "high", "low", "close", "volume"]
    assert required_columns("audit_quality_issues") == ["issue_id", "check_name", "severity"]
    assert set(PRIMARY_KEYS) == set(TABLES)


def test_storage_cast_rounds_and_flags(spark):
    rows = constraints.storage_cast(frame(
        spark, bar(1, close=1.00005, high=2.00004), bar(2, high=1e8), bar(3, daily_return=10000.0),
        bar(4, close=float("nan")), bar(5, open=float("inf")))).orderBy("date").collect()
    assert [r.overflow for r in rows] == [None, "high", "daily_return", None, "open"]
    assert str(rows[0].close) == "1.0001" and str(rows[0].price_range) == "1.0000" and rows[3].close is None


# --- load -------------------------------------------------------------------

def outcomes(df, dim):
    return {r.ticker: r.error_message for r in load.failed_tickers(df, dim).collect()}


def mark(batch, fact):
    return load.mark_existing(batch, load.stored_keys(fact, batch))


def test_one_bad_row_fails_its_ticker_only(spark, dim):
    df = frame(spark, bar(1), bar(2, high=1e8), bar(1, "BBB"), bar(1, "CCC"), bar(2, "CCC", volume=None),
               bar(1, "DDD"))
    got = outcomes(df, dim)
    assert got == {"AAA": "numeric field overflow in column high", "CCC": "null value in column volume",
                   "DDD": "ticker DDD is not in dim_company"}


def test_long_ticker_fails(spark, dim):
    known = dim.unionByName(spark.createDataFrame([("ABCDEFGHIJK", "x", "y")], dim.schema))
    assert outcomes(frame(spark, bar(1, "ABCDEFGHIJK")), known) == {"ABCDEFGHIJK": "value too long for column ticker"}


def test_first_write_wins_and_counts_add_up(spark):
    fact = frame(spark, bar(1, close=7.0), bar(2))
    batch = spark.createDataFrame(
        [bar(1, close=8.0) + (0,), bar(3, close=3.0) + (2,), bar(3, close=4.0) + (1,), bar(1, "BBB") + (3,)],
        METRIC_BAR + ", src_seq bigint")
    marked = mark(load.first_per_key(batch), fact)
    assert sorted((r.ticker, r.date.day, r.close) for r in load.new_rows(marked).collect()) == [("AAA", 3, 4.0), ("BBB", 1, 1.5)]
    assert {r.ticker: (r.attempted, r.inserted, r.skipped) for r in load.load_counts(marked).collect()} == {
        "AAA": (3, 1, 2), "BBB": (1, 1, 0)}


def test_loading_twice_inserts_nothing_the_second_time(spark):
    batch = frame(spark, *[bar(i) for i in range(1, 6)])
    first = load.new_rows(mark(batch, frame(spark)))
    again = load.load_counts(mark(batch, first)).first()
    assert first.count() == 5 and (again.attempted, again.inserted, again.skipped) == (5, 0, 5)


def test_projection_keeps_what_exists(spark):
    df = frame(spark, bar(1)).drop("volatility_7").withColumn("extra", F.lit(1))
    assert load.project(df).columns == ["date", "ticker", "open", "high", "low", "close", "volume", "daily_return",
                                        "moving_avg_7"]
    row = load.fact_rows(constraints.storage_cast(load.project(df)), "2020-02-01 00:00:00")
    assert row.columns == [f.name for f in FACT.fields] and row.first().volatility_7 is None
    assert row.first().loaded_at == dt.datetime(2020, 2, 1)


# --- dimension --------------------------------------------------------------

def test_upsert_keeps_created_at(spark):
    empty = spark.createDataFrame([], DIM_COMPANY)
    first = dimension.upsert_dimension(empty, dimension.company_seed(spark), "2020-01-01 00:00:00")
    assert first.count() == len(COMPANIES) == 10
    change = spark.createDataFrame([("V", "Visa", None), ("NEW", "New Co", "z")], "ticker string, company_name string, sector string")
    rows = {r.ticker: r for r in dimension.upsert_dimension(first, change, "2020-02-01 00:00:00").collect()}
    jan, feb = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)
    assert len(rows) == 11
    assert (rows["V"].company_name, rows["V"].sector, rows["V"].created_at, rows["V"].updated_at) == ("Visa", None, jan, feb)
    assert (rows["NEW"].created_at, rows["NEW"].updated_at) == (feb, feb)
    assert (rows["JNJ"].company_name, rows["JNJ"].created_at, rows["JNJ"].updated_at) == ("Johnson & Johnson", jan, jan)


def test_golden_fact_counts(spark):
    fact = d.as_fact(add_metrics(d.bars(spark, "/root/testdata/sf0.01", tickers=10)))
    assert constraints.pk_violations(fact, ["date", "ticker"]).count() == 0
    assert constraints.not_null_violations(fact, required_columns("fact_stock_prices")).count() == 0
    assert constraints.fk_orphans(fact, "ticker", d.dim(spark, "/root/testdata/sf0.01", 10), "ticker").count() == 0
