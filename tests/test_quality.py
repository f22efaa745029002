"""The cascade on hand-written rows, and against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.operators import quality
from barloom.operators.enrich import add_metrics
from barloom.sources.landing import parse_bars


def issues(raw):
    return quality.cascade_issues(quality.check_bars(raw)).collect()


def found(raw):
    return sorted((r.check_name, r.severity) for r in issues(raw))


def verdicts(raw):
    return {r.verdict: r.n_rows for r in quality.verdict_counts(quality.check_bars(raw)).collect()}


def test_good_rows_have_no_issue(raw):
    bars = raw((1, {}), (2, {}))
    assert found(bars) == [] and verdicts(bars) == {"ok": 2}
    row = quality.batch_summary(quality.check_bars(bars), quality.cascade_issues(quality.check_bars(bars))).first()
    assert (row.raw_rows, row.clean_rows, row.total_issues, row.checks_passed) == (2, 2, 0, True)


def test_row_with_two_nulls_gives_two_issues_and_one_loss(raw):
    bars = raw((1, {"open": None, "close": None}), (2, {}))
    assert found(bars) == [("null_values", "ERROR")] * 2
    assert {r.description for r in issues(bars)} == {
        "Column 'open' has 1 null value(s)", "Column 'close' has 1 null value(s)"}
    assert verdicts(bars) == {"null_values": 1, "ok": 1}


def test_null_date_counts_as_null(raw):
    bars = raw((None, {}), (2, {}), (None, {}))
    assert [r.description for r in issues(bars)] == ["Column 'date' has 2 null value(s)"]
    assert verdicts(bars) == {"null_values": 2, "ok": 1}


def test_incomplete_row_does_not_shadow_a_complete_one(raw):
    bars = raw((1, {"close": None}), (1, {"close": 10.5}))
    assert found(bars) == [("null_values", "ERROR")]
    assert quality.clean_bars(quality.check_bars(bars)).first().close == 10.5


def test_first_copy_in_input_order_survives_whole(raw):
    bars = raw((1, {"close": 10.5, "open": 10.1}), (1, {"close": 11.5, "open": 9.9}), (1, {"close": 9.5}))
    row = quality.clean_bars(quality.check_bars(bars.orderBy(F.desc("src_seq")))).first()
    assert (row.open, row.close) == (10.1, 10.5)
    assert [r.description for r in issues(bars)] == ["2 duplicate (date, ticker) row(s) found"]


def test_damaged_first_copy_takes_the_key_down(raw):
    """The duplicate check comes before the price check, so a good later copy is gone already."""
    bars = raw((1, {"open": -1.0}), (1, {}))
    assert verdicts(bars) == {"duplicate_rows": 1, "negative_price": 1}


def test_price_check_comes_before_range_check(raw):
    bars = raw((1, {"open": 0.0, "high": 8.0}))
    assert found(bars) == [("negative_price", "ERROR")]


def test_negative_price_lists_first_five_dates(raw):
    bars = raw(*[(day, {"low": 0.0}) for day in (7, 6, 5, 4, 3, 2)], (1, {"close": -2.0}))
    rows = {r.description: r.raw_value for r in issues(bars)}
    assert rows == {
        "Column 'low' has 6 non-positive value(s)": "[2020-01-02, 2020-01-03, 2020-01-04, 2020-01-05, 2020-01-06]",
        "Column 'close' has 1 non-positive value(s)": "[2020-01-01]"}


def test_high_below_low_is_reported_per_row(raw):
    bars = raw((1, {"high": 8.5}), (2, {"high": 8.0}), (3, {}))
    rows = sorted((r.issue_date, r.description, r.raw_value) for r in issues(bars))
    assert rows == [(dt.date(2020, 1, 1), "High (8.5) < Low (9.0)", "high=8.5 low=9.0"),
                    (dt.date(2020, 1, 2), "High (8.0) < Low (9.0)", "high=8.0 low=9.0")]


def test_zero_volume_warns_and_stays_negative_goes(raw):
    bars = raw((1, {"volume": 0}), (2, {"volume": -5}), (3, {}))
    assert found(bars) == [("negative_volume", "ERROR"), ("zero_volume", "WARNING")]
    assert verdicts(bars) == {"ok": 2, "negative_volume": 1}


def test_nan_is_null(raw):
    bars = parse_bars(raw((1, {"close": float("nan")}), (2, {})))
    assert [r.description for r in issues(bars)] == ["Column 'close' has 1 null value(s)"]


def test_unreadable_date_is_not_a_null(spark):
    text = spark.createDataFrame(
        [("2020-01-01", 1.0), ("soon", 1.0), (None, 1.0), ("2020-13-45", 1.0), ("2020-01-02T00:00:00", None)],
        "date string, close double")
    bars = parse_bars(text.select("date", F.lit("AAA").alias("ticker"), F.lit(1.0).alias("open"),
                                  F.lit(1.0).alias("high"), F.lit(1.0).alias("low"), "close",
                                  F.lit(1).cast("bigint").alias("volume"))
                      .withColumn("src_seq", F.monotonically_increasing_id()))
    assert verdicts(bars) == {"date_format": 2, "null_values": 2, "ok": 1}
    assert {r.description for r in issues(bars)} == {
        "Cannot parse dates: 2 row(s)", "Column 'date' has 1 null value(s)", "Column 'close' has 1 null value(s)"}


def test_missing_columns(raw):
    bars = raw((1, {})).drop("volume", "open")
    assert quality.missing_columns(bars) == ["open", "volume"]
    row = quality.missing_column_issues(bars.select("ticker"), ["open", "volume"]).first()
    assert row.severity == "ERROR" and row.description == "Required columns missing: ['open', 'volume']"


def test_extreme_return_is_strict(raw):
    bars = raw((1, {"close": 10.0}), (2, {"close": 15.0}), (3, {"close": 22.6}), (4, {"close": 11.0}))
    rows = quality.extreme_return_issues(add_metrics(bars)).orderBy("issue_date").collect()
    assert [(r.issue_date.day, r.description, r.raw_value) for r in rows] == [
        (3, "Daily return 50.67% exceeds ±50%", "0.506667"), (4, "Daily return -51.33% exceeds ±50%", "-0.513274")]


def test_summary_counts_issues_not_rows(raw):
    checked = quality.check_bars(raw((1, {"open": None}), (2, {"open": None}), (3, {"volume": 0}), (4, {"high": 1.0})))
    row = quality.batch_summary(checked, quality.cascade_issues(checked)).first()
    assert (row.raw_rows, row.clean_rows, row.total_issues, row.errors, row.warnings, row.checks_passed) == (
        4, 1, 3, 2, 1, False)


def test_ticker_column_may_be_absent(raw):
    bars = raw((1, {}), (1, {})).drop("ticker")
    assert verdicts(bars) == {"duplicate_rows": 1, "ok": 1}


def brute_force(rows):
    """The cascade one row at a time, in input order."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r["src_seq"]):
        values = [r[c] for c in ("date", "open", "high", "low", "close", "volume")]
        key = (r["ticker"], r["date"])
        if any(v is None for v in values):
            v = "null_values"
        elif key in seen:
            v = "duplicate_rows"
        else:
            seen.add(key)
            prices = [r[c] for c in ("open", "high", "low", "close")]
            v = ("negative_price" if min(prices) <= 0 else "high_lt_low" if r["high"] < r["low"]
                 else "negative_volume" if r["volume"] < 0 else "ok")
        out[r["ticker"], v] = out.get((r["ticker"], v), 0) + 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    from conftest import RAW
    rng = random.Random(seed)
    rows = [{"date": rng.choice([None] + [dt.date(2020, 1, i) for i in range(1, 29)]),
             "ticker": rng.choice("AAAB"), "open": rng.choice([None, -1.0, 0.0, 5.0, 6.0, 7.0]),
             "high": rng.choice([8.0, 9.0, 4.0, None]), "low": rng.choice([3.0, 5.0]), "close": rng.choice([4.0, 5.0, 0.0]),
             "volume": rng.choice([0, 1, 2, -1, None]), "src_seq": i} for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], RAW).repartition(7)
    got = {(r.ticker, r.verdict): r.n_rows for r in quality.verdict_counts(quality.check_bars(df)).collect()}
    assert got == brute_force(rows)
    assert sum(got.values()) == len(rows)


def test_golden_counts(spark):
    checked = quality.check_bars(d.dirty_bars(spark, "/root/testdata/sf0.01", tickers=10)).cache()
    got = {r.verdict: r.n for r in quality.verdict_counts(checked).groupBy("verdict").agg(F.sum("n_rows").alias("n")).collect()}
    assert got == {"null_values": 230, "duplicate_rows": 320, "negative_price": 259, "high_lt_low": 270,
                   "negative_volume": 290, "ok": 21738}
    clean = quality.clean_bars(checked)
    assert clean.where("volume = 0").count() == 279
    assert quality.extreme_return_issues(add_metrics(clean)).count() == 12495
    assert checked.agg(F.sum("n_rows")).first()[0] == 23107
