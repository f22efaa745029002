"""Plans that hold at scale, and results that do not change under skew or without broadcasts."""

import datetime as dt

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barloom import derived as d
from barloom.checks.queries import REGISTRY
from barloom.operators import enrich, ingest, load, quality
from barloom.plans import daily_run, reports
from barloom.session import new_scratch
from barloom.sources import tables
from barloom.sources.tables import since, stage
from barloom.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
EAGER = {"daily_run", "daily_run_facts"}


def plan(df) -> str:
    """The physical plan before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_cross_join_and_no_python_in_any_plan(spark, no_broadcast, name):
    text = plan(REGISTRY[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "Python", "BroadcastHashJoin"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["best_performer", "incremental_filter", "load_counts", "ticker_isolation", "dim_upsert",
                                  "quality_summary", "unresolved_issues", "run_gate", "recompute_metrics"])
def test_results_do_not_depend_on_broadcasts(spark, name):
    usual = sorted(map(str, REGISTRY[name](spark, SF).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, REGISTRY[name](spark, SF).collect())) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_fold_is_hashed_and_partial_before_its_only_shuffle(spark):
    text = plan(quality.check_bars(stage(d.dirty_bars(spark, SF))))
    assert text.count("Exchange hashpartitioning(ticker") == 1
    assert "partial_min_by" in text and text.index("Exchange") < text.index("partial_min_by")
    assert "SortAggregate" not in text and "Window" not in text


def test_first_per_key_is_hashed_and_partial(spark):
    text = plan(load.first_per_key(stage(d.dirty_bars(spark, SF))))
    assert "partial_min_by" in text and "SortAggregate" not in text and "Window" not in text


def test_metrics_share_one_shuffle_and_sort(spark):
    bars = stage(d.bars(spark, SF))
    text = plan(enrich.add_metrics(bars))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    stored = stage(d.as_fact(enrich.add_metrics(bars)))
    text = plan(enrich.enrich(bars, stored))
    assert text.count("+- Sort [ticker") == 3  # union of both, and the look-back's own partial and final limit
    assert text.count("Exchange hashpartitioning(ticker") == 2


def test_look_back_is_cut_before_the_shuffle(spark):
    text = plan(enrich.last_stored_rows(stage(d.fact(spark, SF))))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert "ReadSchema: struct<date:date,ticker:string,close:decimal(12,4)>" in text


@pytest.fixture(scope="module")
def house(spark):
    w = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    w.append_fact(d.fact(spark, SF), d.RUN_TS)
    return w


def test_reports_prune_years_and_columns(spark, house):
    dim = d.dim(spark, SF)
    text = plan(reports.price_trend(house.fact(), dim, d.AS_OF))
    assert "PartitionFilters: [isnotnull(year" in text and "GreaterThanOrEqual(date,2001-10-05)" in text
    assert "struct<date:date,ticker:string,close:decimal(12,4),daily_return:decimal(10,6),moving_avg_7" in text
    text = plan(reports.close_stats(house.fact(), dim))
    assert "ReadSchema: struct<ticker:string,close:decimal(12,4)>" in text
    # the companies are joined to one row per ticker, not to the facts
    assert text.index("HashJoin") < text.index("partial_sum")


def test_watermark_reads_two_columns(house):
    assert "ReadSchema: struct<date:date,ticker:string>" in plan(ingest.watermarks(house.fact()))


def test_older_years_are_read_only_for_tickers_that_need_them(spark, house):
    """With a recent mark and seven recent rows for all tickers, the scan of older years is dropped."""
    tickers, day = stage(d.dim(spark, SF).select("ticker")), F.lit(dt.date(2000, 1, 1))
    recent_marks = stage(ingest.watermarks(since(house.fact(), day)))
    recent_rows = stage(enrich.last_stored_rows(since(house.fact(), day)))
    for df in (ingest.older_watermarks(house.fact(), recent_marks, tickers, day),
               enrich.older_rows(house.fact(), recent_rows, tickers, day)):
        assert df.count() == 0
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert "EmptyRelation" in final and "FileScan" not in final
    # one silent ticker is found in the older years, and only that one
    late = day_of(house, "S000000003")
    marks = stage(ingest.watermarks(house.fact().where("ticker <> 'S000000003'")))
    got = ingest.older_watermarks(house.fact(), marks, tickers, F.lit(dt.date(2002, 1, 1))).collect()
    assert [tuple(r) for r in got] == [("S000000003", late)]


def day_of(house, ticker):
    return house.fact().where(F.col("ticker") == ticker).agg(F.max("date")).first()[0]


def test_fact_files_are_clustered_by_year_and_ticker(spark, house):
    files = house.fact().select("year", "ticker", F.input_file_name().alias("file"))
    per_file = files.groupBy("file").agg(F.countDistinct("year").alias("years"))
    assert per_file.agg(F.max("years")).first()[0] == 1
    # ranges: within a year no ticker is spread over files
    assert files.groupBy("year", "ticker").agg(F.countDistinct("file").alias("n")).agg(F.max("n")).first()[0] == 1


def skewed(spark, n=120_000):
    """A third of the rows is one key, another third is one ticker, the rest is spread."""
    part = F.col("id") % 3
    day = F.when(part == 0, 5).otherwise((F.col("id") / 3).cast("int") % 900)
    ticker = F.when(part == 2, F.concat(F.lit("T"), (F.col("id") % 997).cast("string"))).otherwise("HOT")
    return spark.range(n, numPartitions=12).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), day.cast("int")).alias("date"), ticker.alias("ticker"),
        F.lit(5.0).alias("open"), F.lit(1e6).alias("high"), F.lit(1.0).alias("low"),
        F.when(F.col("id") % 1000 == 0, None).otherwise((F.hash("id") % 1000).cast("double") + 1500).alias("close"),
        (F.col("id") % 50 - 1).alias("volume"), (F.lit(n) - F.col("id")).alias("src_seq"))


def test_hot_key_and_hot_ticker_give_whole_results(spark):
    raw = skewed(spark)
    checked = quality.check_bars(raw).cache()
    assert checked.agg(F.sum("n_rows")).first()[0] == 120_000
    pdf = raw.toPandas().sort_values("src_seq")
    whole = pdf.dropna(subset=["close"]).drop_duplicates(["ticker", "date"])
    clean = whole[whole.volume >= 0]
    got = quality.clean_bars(checked).toPandas()
    both = clean.merge(got, on=["date", "ticker", "close", "volume"])
    assert len(both) == len(clean) == len(got)
    counts = {r.verdict: r.n for r in quality.verdict_counts(checked).groupBy("verdict").agg(F.sum("n_rows").alias("n")).collect()}
    assert counts == {"null_values": int(pdf.close.isna().sum()), "ok": len(clean), "negative_volume": int((whole.volume < 0).sum()),
                      "duplicate_rows": len(pdf) - int(pdf.close.isna().sum()) - len(whole)}
    # what a window by ticker sees is bounded by the calendar, not by the copies
    assert got.groupby("ticker").size().max() <= 900
    metrics = enrich.add_metrics(quality.clean_bars(checked)).toPandas()
    hot = clean[clean.ticker == "HOT"].sort_values("date")
    wanted = hot["close"].pct_change().round(6).tolist()
    ours = metrics[metrics.ticker == "HOT"].sort_values("date")["daily_return"].tolist()
    assert all((pd.isna(a) and pd.isna(b)) or abs(a - b) < 1.1e-6 for a, b in zip(ours, wanted, strict=True))


def test_hot_ticker_is_split_in_the_incremental_join(spark, no_broadcast):
    """With broadcasts off the join shuffles by ticker; adaptive execution splits the hot partition."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        raw = skewed(spark)
        starts = stage(raw.select("ticker").distinct().withColumn("start", F.lit(dt.date(2020, 1, 3))))
        got = ingest.incremental_filter(raw, starts, "2030-01-01")
        rows = got.collect()
        assert "SortMergeJoin(skew=true)" in plan(got)
        assert len(rows) == raw.where(F.col("date") >= F.lit(dt.date(2020, 1, 3))).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bars_are_dealt_by_stored_size(spark, tmp_path, monkeypatch):
    """A task's share does not grow with the table, and line items are sorted once."""
    text = plan(d.bars(spark, SF))
    assert "REPARTITION_BY_NUM" in text and text.count("Exchange") == 1 and text.count("Sort [") == 1
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    few = tables.task_count(spark, path)
    monkeypatch.setattr(tables, "TASK_BYTES", (1 << 10, 8 << 10))
    assert few == 1 and tables.task_count(spark, path) * (8 << 10) >= tables.stored_bytes(spark, path) > 100_000


def test_prices_are_stored_without_a_dictionary(spark, tmp_path):
    path = tmp_path / "t"
    rows = stage(spark.sql("SELECT 'A' AS ticker, double(id % 3) AS close, decimal(id % 3) AS ratio FROM range(1000)"), str(path))
    assert rows.groupBy("close").count().count() == 3
    meta = pq.ParquetFile(next(path.glob("*.parquet"))).metadata.row_group(0)
    coded = {meta.column(i).path_in_schema: any("DICT" in e for e in meta.column(i).encodings) for i in range(3)}
    assert coded == {"ticker": True, "close": False, "ratio": False}


def test_a_run_needs_no_window_over_whole_tickers(spark):
    bars = stage(d.bars(spark, SF))
    stored = enrich.last_stored_rows(bars.where("date < '1996-01-01'"))
    text = plan(enrich.enrich(bars.where("date >= '1996-01-01'"), stored=stored, tasks=5))
    assert "unboundedfollowing" not in text and "REPARTITION_BY_NUM" in text


def test_facts_are_cast_after_they_are_laid_out(spark):
    """The sample that sets the ranges takes rows as they are, and the first run joins no failed tickers."""
    house = Warehouse(spark, new_scratch(spark, "wh")).bootstrap()
    rows = stage(enrich.add_metrics(d.bars(spark, SF)))
    text = plan(daily_run._typed(house.in_layout(rows)))
    assert text.index("decimal(12,4)") < text.index("rangepartitioning(year")
    assert house.append_fact(daily_run._typed(house.in_layout(rows)), d.RUN_TS, laid_out=True) == rows.count()
    assert house.fact().count() == house.fact().select("date", "ticker").distinct().count() == rows.count()
