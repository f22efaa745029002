"""Facts by commits: corrections, compaction, day bits, yearly sums, clean-up."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.operators import load
from barloom.operators.corrections import BadCorrection
from barloom.operators.days import day_summary, keys_in_days, watermarks_of_days
from barloom.operators.enrich import add_metrics
from barloom.operators.ingest import watermarks
from barloom.plans import reports
from barloom.session import new_scratch
from barloom.sources.tables import stage
from barloom.sources.warehouse import Warehouse

BAR = "date date, ticker string, open double, high double, low double, close double, volume bigint"


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


def some_bars(spark):
    """A dense ticker over four years, one with a row a quarter, one that ends, one that begins late."""
    rng, out = random.Random(1), []
    for ticker, first, last, step in (("DENSE", 1998, 2001, 1), ("THIN", 1990, 2001, 90), ("ENDS", 1998, 1999, 2), ("LATE", 2000, 2001, 3)):
        day = dt.date(first, 1, 1)
        while day.year <= last:
            price = rng.randint(1000, 9000) / 100
            out.append((day, ticker, price, price + 5, price - 5, price + rng.randint(-4, 4), rng.randint(1, 99)))
            day += dt.timedelta(days=step)
    return spark.createDataFrame(out, BAR)


@pytest.fixture(scope="module")
def bars(spark, small_plans):
    return stage(some_bars(spark))


@pytest.fixture
def house(spark, bars):
    w = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    w.append_fact(d.as_fact(add_metrics(bars)), d.RUN_TS)
    return w


def rows_of(df):
    return sorted(map(tuple, df.select([c for c in d.as_fact(df).columns if c != "loaded_at"]).collect()), key=str)


def corrected(bars, fixes):
    """All facts as one load of the corrected bars would make them."""
    new = fixes.select("ticker", "date", *[F.col(c).alias(f"new_{c}") for c in fixes.columns if c not in ("ticker", "date")])
    names = [c.removeprefix("new_") for c in new.columns if c.startswith("new_")]
    out = bars.join(new, ["ticker", "date"], "left").withColumns({c: F.coalesce(f"new_{c}", c) for c in names})
    return d.as_fact(add_metrics(out.select(bars.columns)))


def fixes_of(spark, *rows, schema="ticker string, date date, close double"):
    return spark.createDataFrame([(t, dt.date.fromisoformat(day), *rest) for t, day, *rest in rows], schema)


CASES = {
    "first and last row": [("DENSE", "1998-01-01", 50.0), ("DENSE", "2001-12-31", 51.0)],
    "turn of the year": [("DENSE", "1998-12-30", 60.0), ("DENSE", "1999-01-02", 61.0)],
    "both years of a turn": [("DENSE", "1999-12-31", 70.0), ("DENSE", "2000-01-01", 71.0), ("LATE", "2000-01-01", 9.0)],
    "thin rows": [("THIN", "1995-01-05", 40.0)],
    "ends and begins": [("ENDS", "1999-12-30", 33.0), ("LATE", "2000-01-04", 34.0)],
    "many": [("DENSE", f"2000-0{m}-1{m}", 20.0 + m) for m in range(1, 10)] + [("THIN", "1998-02-18", 3.0), ("THIN", "1998-05-19", 4.0)],
}


@pytest.mark.parametrize("case", CASES)
def test_a_correction_equals_a_fresh_load(spark, bars, house, case):
    stored = {(r.ticker, str(r.date)) for r in bars.select("ticker", "date").collect()}
    rows = [r for r in CASES[case] if (r[0], r[1]) in stored]
    if case != "thin rows" and case != "many":
        assert len(rows) == len(CASES[case])
    if not rows:
        day = sorted(day for t, day in stored if t == "THIN" and day.startswith("1995"))[0]
        rows = [("THIN", day, 40.0)]
    fixes = fixes_of(spark, *rows)
    house.correct(fixes)
    assert rows_of(house.fact()) == rows_of(corrected(bars, fixes))
    assert sorted(map(tuple, house.days().collect()), key=str) == sorted(map(tuple, day_summary(house.fact()).select(
        house.days().columns).collect()), key=str)


def test_other_values_can_be_corrected(spark, bars, house):
    fixes = fixes_of(spark, ("DENSE", "1999-05-05", 90.0, None, 7), ("ENDS", "1998-01-05", None, 20.0, None),
                     schema="ticker string, date date, high double, close double, volume bigint")
    assert house.correct(fixes) == [1998, 1999]
    assert rows_of(house.fact()) == rows_of(corrected(bars, fixes))
    row = house.fact().where("ticker = 'DENSE' AND date = DATE'1999-05-05'").first()
    assert (float(row.high), float(row.price_range), row.volume) == (90.0, float(row.high - row.low), 7)
    assert str(row.loaded_at).startswith("2001-11-05")


def test_untouched_years_are_neither_read_nor_written(spark, bars, house):
    before = house.parts()
    for year in (1990, 1995, 1998, 2001):
        for file in glob.glob(f"{house.root.removeprefix('file:')}/fact_*/year={year}/*/*.parquet"):
            with open(file, "r+b") as f:
                f.write(b"#" * 64)
                f.truncate(64)
    assert house.correct(fixes_of(spark, ("DENSE", "1999-06-01", 5.0), ("DENSE", "1999-12-28", 6.0))) == [1999, 2000]
    after = house.parts()
    assert {y for y in before if before[y] != after[y]} == {1999, 2000}
    got = house.fact().where("year IN (1999, 2000) AND ticker = 'DENSE'")
    wanted = corrected(bars, fixes_of(spark, ("DENSE", "1999-06-01", 5.0), ("DENSE", "1999-12-28", 6.0)))
    assert rows_of(got) == rows_of(wanted.where("year(date) IN (1999, 2000) AND ticker = 'DENSE'"))


def test_a_crash_half_way_leaves_the_old_version(spark, bars, house, monkeypatch):
    old = rows_of(house.fact())
    fixes = fixes_of(spark, ("DENSE", "1999-06-01", 5.0))
    for step in ("_summarise", "commit"):
        monkeypatch.setattr(Warehouse, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            house.correct(fixes)
        monkeypatch.undo()
        assert rows_of(Warehouse(spark, house.root).fact()) == old
    house.correct(fixes)
    assert rows_of(Warehouse(spark, house.root).fact()) == rows_of(corrected(bars, fixes))
    # what the crashes left behind goes with the replaced folders
    assert house.vacuum() > 2 and rows_of(house.fact()) == rows_of(corrected(bars, fixes))


def test_bad_corrections_raise_before_anything_is_written(spark, house):
    for rows, why in (([("DENSE", "1999-06-01", 5.0), ("DENSE", "1999-06-01", 6.0)], "given twice"),
                      ([("DENSE", "1980-06-01", 5.0)], "no stored row"), ([("WHO", "1999-06-01", 5.0)], "no stored row"),
                      ([("DENSE", "1999-06-01", -5.0)], "above zero"), ([("DENSE", "1999-06-01", 1e9)], "overflow")):
        with pytest.raises(Exception, match=why):
            house.correct(fixes_of(spark, *rows))
    with pytest.raises(BadCorrection):
        house.correct(fixes_of(spark, ("DENSE", "1999-06-01", "x"), schema="ticker string, date date, note string"))
    assert house.last_commit() == 1 and house.correct(fixes_of(spark)) == []


def test_increments_and_compaction(spark, bars):
    house = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    metrics = stage(d.as_fact(add_metrics(bars)).withColumn("turn", F.pmod(F.dayofyear("date"), F.lit(10))))
    for i in range(10):
        assert house.append_fact(metrics.where(F.col("turn") == i).drop("turn"), d.RUN_TS) > 0
    wanted = rows_of(metrics)
    assert rows_of(house.fact()) == wanted and house.append_fact(metrics.where("turn > 10").drop("turn")) == 0
    old = house.fact()  # a reader that began before
    several = sorted(y for y, parts in house.parts().items() if len(parts) > 1)
    assert len(several) == 4 and house.compact() == several  # the thin ticker's days of the other years fell into one load
    assert all(len(p) == 1 for p in house.parts().values())
    files = house.fact().select("year", "ticker", F.input_file_name().alias("file"))
    assert files.groupBy("year", "ticker").agg(F.countDistinct("file").alias("n")).agg(F.max("n")).first()[0] == 1
    assert rows_of(house.fact()) == rows_of(old) == wanted
    assert house.compact() == [] and house.vacuum() > 0 and rows_of(house.fact()) == wanted
    assert house.append_fact(metrics.where("turn > 10").drop("turn")) == 0


def test_stored_keys_come_from_the_summaries(spark, bars, house):
    days, batch = house.days(), bars.select("date", "ticker").unionByName(
        bars.select(F.date_add("date", 1).alias("date"), "ticker")).distinct()
    got = keys_in_days(days, batch)
    wanted = load.stored_keys(house.fact(), batch)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.select("date", "ticker").collect()))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "fact_stock_prices" not in text and "fact_days" in text
    assert sorted(map(tuple, watermarks_of_days(days).collect())) == sorted(map(tuple, watermarks(house.fact()).collect()))


def test_leap_days_have_a_bit(spark):
    days = [dt.date(y, m, n) for y in (1999, 2000) for m, n in ((1, 1), (2, 28), (3, 1), (3, 4), (3, 5), (12, 30), (12, 31))]
    days.append(dt.date(2000, 2, 29))
    fact = spark.createDataFrame([(x, "A", 1.0) for x in days], "date date, ticker string, close double")
    summary = day_summary(fact)
    every = spark.range(731).select(F.date_add(F.lit(dt.date(1999, 1, 1)), F.col("id").cast("int")).alias("date"), F.lit("A").alias("ticker"))
    assert sorted(r.date for r in keys_in_days(summary, every).collect()) == sorted(days)


def test_close_stats_read_no_fact(spark, bars, house):
    dim = spark.createDataFrame([(t, t, "x") for t in ("DENSE", "THIN", "ENDS", "LATE")], "ticker string, company_name string, sector string")
    house.upsert_dim(dim, d.RUN_TS)
    house.correct(fixes_of(spark, ("DENSE", "1999-06-01", 5.0)))
    got = house.close_stats()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, reports.close_stats(house.fact(), house.dim()).collect()))
    assert "fact_stock_prices" not in got._jdf.queryExecution().executedPlan().toString()
