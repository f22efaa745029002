"""Metrics against pandas on random walks, and the two window scopes."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.operators import enrich

BAR = "date date, ticker string, open double, high double, low double, close double, volume bigint"


def walk(spark, n, tickers=("AAA", "BBB"), seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for t in tickers:
        close = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.05, n))), 2)
        rows += [(dt.date(2020, 1, 1) + dt.timedelta(days=int(3 * i)), t, float(c), float(c) + 1, float(c) - 1,
                  float(c), 10) for i, c in enumerate(close)]
    rng.shuffle(rows)
    rows = [(r[0], str(r[1]), *map(float, r[2:6]), int(r[6])) for r in rows]
    return spark.createDataFrame(rows, BAR)


def by_pandas(pdf):
    out = []
    for _, g in pdf.sort_values("date").groupby("ticker"):
        g = g.copy()
        g["daily_return"] = g["close"].pct_change().round(6)
        g["moving_avg_7"] = g["close"].rolling(7, min_periods=1).mean().round(4)
        g["volatility_7"] = g["daily_return"].rolling(7, min_periods=2).std().round(6)
        out.append(g)
    return pd.concat(out).sort_values(["ticker", "date"]).reset_index(drop=True)


@pytest.mark.parametrize("n,seed", [(60, 1), (200, 2), (7, 3)])
def test_same_as_pandas(spark, n, seed):
    bars = walk(spark, n, seed=seed)
    ours = enrich.add_metrics(bars).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    theirs = by_pandas(bars.toPandas())
    for c in ("daily_return", "moving_avg_7", "volatility_7"):
        assert (ours[c].isna() == theirs[c].isna()).all()
        # equal up to the last stored digit: rolling sums differ in the last bits before rounding
        np.testing.assert_allclose(ours[c].astype(float), theirs[c], rtol=0, atol=1.1e-4 if c == "moving_avg_7" else 1.1e-6)
        assert (ours[c].astype(float).fillna(0) == theirs[c].fillna(0)).mean() > 0.99


def test_null_positions(spark):
    rows = enrich.add_metrics(walk(spark, 3, ("AAA",))).orderBy("date").collect()
    assert rows[0].daily_return is None and rows[0].volatility_7 is None and rows[0].moving_avg_7 == rows[0].close
    assert rows[1].daily_return is not None and rows[1].volatility_7 is None
    assert rows[2].volatility_7 is not None


def test_zero_close_does_not_abort(spark):
    rows = enrich.add_metrics(walk(spark, 2, ("AAA",)).withColumn("close", F.lit(0.0))).collect()
    assert [r.daily_return for r in rows] == [None, None]


@pytest.mark.parametrize("cut", [1, 3, 6, 7, 8, 20])
def test_split_load_equals_whole_load(spark, cut):
    """Any split gives the metrics of one load, with the history read from stored decimals."""
    bars = walk(spark, 30, seed=cut)
    day = F.lit(dt.date(2020, 1, 1) + dt.timedelta(days=3 * cut))
    old, new = bars.where(F.col("date") < day), bars.where(F.col("date") >= day)
    stored = d.as_fact(enrich.add_metrics(old))
    split = d.as_fact(enrich.enrich(new, stored)).unionByName(stored)
    whole = d.as_fact(enrich.add_metrics(bars))
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))


def test_batch_scope_restarts(spark):
    bars = walk(spark, 10, ("AAA",))
    day = F.lit(dt.date(2020, 1, 16))
    rows = enrich.enrich(bars.where(F.col("date") >= day), d.as_fact(enrich.add_metrics(bars.where(F.col("date") < day))),
                         "batch").orderBy("date").collect()
    assert rows[0].daily_return is None and rows[0].moving_avg_7 == rows[0].close
    with pytest.raises(ValueError):
        enrich.enrich(bars, None, "year")


def test_lookback_of_six_is_not_enough(spark):
    bars = walk(spark, 30, ("AAA",), seed=5)
    day = F.lit(dt.date(2020, 2, 15))
    stored = d.as_fact(enrich.add_metrics(bars.where(F.col("date") < day)))
    assert enrich.last_stored_rows(stored).count() == 7
    assert enrich.last_stored_rows(stored, 6).count() == 6


def test_stored_rows_inside_the_batch_are_not_used_twice(spark):
    bars = walk(spark, 20, ("AAA",))
    stored = d.as_fact(enrich.add_metrics(bars))
    day = F.lit(dt.date(2020, 2, 1))
    again = enrich.enrich(bars.where(F.col("date") >= day), stored)
    assert again.count() == bars.where(F.col("date") >= day).count()


def test_recompute_touches_corrected_tickers_only(spark):
    bars = walk(spark, 20)
    fact = d.as_fact(enrich.add_metrics(bars))
    fix = spark.createDataFrame([("AAA", dt.date(2020, 1, 10), 77.0)], "ticker string, date date, close double")
    got = enrich.recompute_metrics(fact, fix)
    wanted = enrich.add_metrics(bars.where("ticker = 'AAA'").withColumn(
        "close", F.when(F.col("date") == F.lit(dt.date(2020, 1, 10)), 77.0).otherwise(F.col("close"))))
    keep = ["date", "close", "daily_return", "moving_avg_7", "volatility_7"]
    assert sorted(map(tuple, got.select(keep).collect()), key=str) == sorted(map(tuple, wanted.select(keep).collect()), key=str)


def test_incremental_goldens(spark):
    bars = d.bars(spark, "/root/testdata/sf0.01", tickers=10).cache()
    cut = F.lit(d.SPLIT_DAY).cast("date")
    old, new = bars.where(F.col("date") < cut), bars.where(F.col("date") >= cut)
    assert (bars.count(), old.count(), new.count()) == (22784, 16653, 6131)
    both = enrich.enrich(old, scope="batch").unionByName(enrich.enrich(new, scope="batch"))
    assert both.where("daily_return IS NULL").count() == 20
    whole = enrich.add_metrics(bars)
    assert whole.where("daily_return IS NULL").count() == 10
    history = enrich.enrich(new, d.as_fact(enrich.add_metrics(old)))
    assert history.exceptAll(whole.select(history.columns)).count() == 0
    assert history.count() == 6131
