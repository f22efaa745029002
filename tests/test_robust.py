"""One bad value, ticker or company must not spoil the rest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions.columns import percent_text
from barloom.operators import dimension, enrich, load, quality
from barloom.sources.landing import parse_bars


def closes(spark, days):
    return spark.createDataFrame([(dt.date(2020, 1, d), "AAA", float(9 + d)) for d in days], "date date, ticker string, close double")


def test_a_gap_filled_later_gets_the_values_of_one_load(spark):
    whole = {r.date: r for r in enrich.add_metrics(closes(spark, range(1, 21))).collect()}
    late = enrich.enrich(closes(spark, (5, 6)), closes(spark, [*range(1, 5), *range(7, 21)])).collect()
    assert [(r.daily_return, r.moving_avg_7, r.volatility_7) for r in sorted(late, key=lambda r: r.date)] == [
        (whole[r].daily_return, whole[r].moving_avg_7, whole[r].volatility_7) for r in (dt.date(2020, 1, 5), dt.date(2020, 1, 6))]


def test_stored_keys_are_those_of_the_batch(spark):
    fact = closes(spark, range(1, 21)).withColumn("ticker", F.lit("BBB")).unionByName(closes(spark, (3, 4)))
    assert load.stored_keys(fact, closes(spark, (4, 20))).select("ticker", "date").collect() == [("AAA", dt.date(2020, 1, 4))]


def test_nan_is_missing(spark, raw):
    checked = quality.check_bars(raw((2, {"close": float("nan")}), (3, {}))).collect()
    assert {r.date.day: (r.n_incomplete, r.null_close) for r in checked} == {2: (1, 1), 3: (0, 0)}


def test_huge_returns_have_a_text(spark):
    texts = [r[0] for r in spark.createDataFrame([(1e16,), (0.125,)], "x double").select(percent_text(F.col("x"))).collect()]
    assert texts == ["1.0E18%", "12.50%"]


@pytest.mark.parametrize("kind", ["double", "string"])
def test_volumes_keep_their_sign_and_are_rounded(spark, kind):
    rows = spark.createDataFrame([("2020-01-02", "A", 1.0, 1.0, 1.0, 1.0, v) for v in (-0.5, 0.5, 1200.7, 3.0)],
                                 "date string, ticker string, open double, high double, low double, close double, volume double")
    rows = rows.withColumn("volume", F.col("volume").cast(kind))
    assert [r.volume for r in parse_bars(rows).select("volume").collect()] == [-1, 1, 1201, 3]


@pytest.mark.parametrize("days", [(3, 3), (3, 9)])
def test_corrections_must_be_of_stored_rows_and_once(spark, days):
    with pytest.raises(ValueError, match="correction of AAA"):
        enrich.recompute_metrics(closes(spark, (1, 2, 3)), closes(spark, days))


@pytest.mark.parametrize("rows", [[("A", "x", "s"), ("A", "y", "s")], [("A", None, "s")], [(None, "x", "s")], [("A" * 17, "x", "s")]])
def test_companies_are_checked(spark, rows):
    with pytest.raises(ValueError, match="do not fit"):
        dimension.check_companies(spark.createDataFrame(rows, "ticker string, company_name string, sector string"))
    dimension.check_companies(spark.createDataFrame([("A", "x", None), ("B", "x", "s")], "ticker string, company_name string, sector string"))
