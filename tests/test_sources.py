"""Landing formats, column names, input order, staging and the shared folder."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barloom import session
from barloom.operators import ingest, quality
from barloom.sources.landing import flat_name, normalise_columns, read_landing
from barloom.sources.tables import lookup, stage

ROWS = [(dt.date(2020, 1, i), "AAA", 10.0 + i, 12.0 + i, 9.0, 11.25 + i, 100 * i) for i in range(1, 8)]
SCHEMA = "Date date, Ticker string, Open double, High double, Low double, Close double, Volume bigint"
BAR = ["date", "ticker", "open", "high", "low", "close", "volume"]


@pytest.mark.parametrize("name,flat", [("Close", "close"), ("('Close', 'AAPL')", "close"), (" VOLUME ", "volume"),
                                       ("src_seq", "src_seq")])
def test_flat_name(name, flat):
    assert flat_name(name) == flat


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_every_format_gives_the_same_bars(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS, SCHEMA)
    writer = df.repartition(3).write
    path = str(tmp_path / fmt)
    if fmt == "json":
        df = df.toDF(*[c.lower() for c in df.columns])
        df.repartition(3).write.json(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    got = read_landing(spark, path, fmt)
    assert sorted(map(tuple, got.select(BAR).collect())) == ROWS
    assert dict(got.select(BAR).dtypes) == {"date": "date", "ticker": "string", "open": "double", "high": "double",
                                            "low": "double", "close": "double", "volume": "bigint"}
    assert got.select("src_seq").distinct().count() == len(ROWS)


def test_one_ticker_file_with_two_level_header(spark, tmp_path):
    path = str(tmp_path / "two")
    spark.createDataFrame([r[:1] + r[2:] for r in ROWS], "`Date` date, `('Open', 'AAA')` double, `('High', 'AAA')` double, "
                          "`('Low', 'AAA')` double, `('Close', 'AAA')` double, `('Volume', 'AAA')` bigint").write.parquet(path)
    got = read_landing(spark, path, ticker="AAA")
    assert sorted(map(tuple, got.select(BAR).collect())) == ROWS


def test_nested_json_level_is_unwrapped(spark, tmp_path):
    file = tmp_path / "in.json"
    file.write_text("\n".join(json.dumps({"Date": str(r[0]), "Close": {"AAA": r[5]}}) for r in ROWS))
    got = read_landing(spark, str(file), "json", ticker="AAA",
                       columns={"Date": "string", "Close": "struct<AAA:double>"})
    assert sorted(r.close for r in got.collect()) == [r[5] for r in ROWS]


def test_malformed_values_become_null_and_do_not_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "DATE,TICKER,OPEN,HIGH,LOW,CLOSE,VOLUME\n2020-01-01,AAA,1,2,1,n/a,10\n2020-01-02,AAA,1,2,1,NaN,10\n"
        "soon,AAA,1,2,1,1,10\n2020-01-03,AAA,1,2,1,1.5,1200.0\n2020-01-04,AAA,1,2,1,1.5,\n")
    got = read_landing(spark, str(tmp_path), "csv")
    rows = {r.verdict: r.n_rows for r in quality.verdict_counts(quality.check_bars(got)).collect()}
    assert rows == {"null_values": 3, "date_format": 1, "ok": 1}
    assert quality.clean_bars(quality.check_bars(got)).first().volume == 1200


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,ticker,open\n2020-01-01,AAA,1\n2020-01-02,AAA,1\n")
    (tmp_path / "b.csv").write_text("ticker,date,open\nAAA,2020-01-01,1\n")
    with pytest.raises(Exception, match="header"):
        read_landing(spark, str(tmp_path), "csv").collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_first_row_of_a_file_survives(spark, tmp_path, fmt):
    """Thousands of copies of one key over two files: the first row of the first file wins."""
    for name, base in (("part-a", 0), ("part-b", 100000)):
        df = spark.range(3000).coalesce(1).select(
            F.lit("2020-01-01").alias("date"), F.lit("AAA").alias("ticker"), F.lit(1.0).alias("open"),
            F.lit(1e9).alias("high"), F.lit(1.0).alias("low"), (F.col("id") + base + 5.0).alias("close"),
            F.lit(1).cast("bigint").alias("volume"))
        writer = df.write.option("header", True) if fmt == "csv" else df.write
        writer.format(fmt).save(str(tmp_path / name))
    got = read_landing(spark, str(tmp_path / "*"), fmt)
    assert quality.clean_bars(quality.check_bars(got)).first().close == 5.0


def test_given_order_column_is_used(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([r + (9 - i,) for i, r in enumerate(ROWS)], SCHEMA + ", Src_Seq int").write.parquet(path)
    assert dict(read_landing(spark, path).dtypes)["src_seq"] == "bigint"


def test_missing_column_stays_missing(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(ROWS, SCHEMA).drop("Close").write.parquet(path)
    assert quality.missing_columns(read_landing(spark, path)) == ["close"]


def test_names_are_normalised_with_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`Adj.Close` int, `A b` int")
    assert normalise_columns(df).columns == ["adj.close", "a b"]


def test_stage_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(tuple, stage(df).collect())) == ROWS


def test_lookup_takes_values_as_parameters(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert lookup(spark, "SELECT count(*) AS n FROM {bars} WHERE Ticker = :t", {"t": "x' OR 'a'='a"}, bars=df).first().n == 0
    assert lookup(spark, "SELECT count(*) AS n FROM {bars} WHERE Ticker = :t", {"t": "AAA"}, bars=df).first().n == 7


class FakeSession:
    def __init__(self, named, master):
        self.conf = type("C", (), {"get": staticmethod(lambda key, default: named)})()
        self.sparkContext = type("S", (), {"master": master})()


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(FakeSession("hdfs://x/ckpt/", "yarn")) == "hdfs://x/ckpt"
    assert session.new_scratch(FakeSession("hdfs://x/ckpt", "yarn"), "a").startswith("hdfs://x/ckpt/a-")
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(None, "yarn"))
    assert session.shared_folder(FakeSession(None, "local[4]"))


def test_date_filters_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.parquet(str(tmp_path / "parquet"))
    starts = stage(df.select("ticker", F.lit(dt.date(2020, 1, 3)).alias("start")).distinct())
    got = ingest.incremental_filter(read_landing(spark, str(tmp_path / "parquet")), starts, "2020-01-06")
    assert sorted(r.date.day for r in got.collect()) == [3, 4, 5]
    assert "GreaterThanOrEqual(Date,ScalarSubquery" in got._jdf.queryExecution().executedPlan().toString()
    # a folder per day, in a format whose rows are numbered by Spark
    df.write.partitionBy("Date").option("header", True).csv(str(tmp_path / "csv"))
    got = read_landing(spark, str(tmp_path / "csv"), "csv", where="date >= DATE'2020-01-06'")
    assert sorted(r.date.day for r in got.collect()) == [6, 7]
    assert "PartitionFilters: [isnotnull(Date" in got._jdf.queryExecution().executedPlan().toString()
