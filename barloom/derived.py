"""Bars, dimension, run log and issues derived from the test tables.

The test tables hold no price bars. One ticker per supplier makes bars whose number grows with the
data; ``tickers=10`` folds the suppliers into ten tickers, the size of the production list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.constraints import storage_cast
from barloom.operators.enrich import add_metrics
from barloom.operators.load import fact_rows
from barloom.sources.tables import task_count

AS_OF = "2001-11-04"
INGEST_DAY = "2001-11-05"
FIRST_DAY = "1995-01-01"
SPLIT_DAY = "2000-01-01"
RUN_TS = "2001-11-05 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticker_name(number: Column, tickers: int | None) -> Column:
    if tickers is None:
        return F.concat(F.lit("S"), F.lpad(number.cast("string"), 9, "0"))
    return F.concat(F.lit("S"), F.lpad((number % tickers).cast("string"), 2, "0"))


def bars(spark: SparkSession, sf_dir: str, tickers: int | None = None) -> DataFrame:
    """Daily bars: line items by ship date and supplier, in order-key order within the day.

    Nearly every line item is a bar of its own, so folding before the shuffle would sort all rows once more
    and shrink nothing. Rows are dealt by key to as many tasks as the stored size asks for, so that a task's
    memory does not grow with the table.
    """
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    price = F.col("l_extendedprice")
    return (table(spark, sf_dir, "lineitem")
            .withColumns({"date": F.col("l_shipdate").cast("date"), "ticker": ticker_name(F.col("l_suppkey"), tickers)})
            .repartition(task_count(spark, f"{sf_dir}/lineitem.parquet"), "date", "ticker").groupBy("date", "ticker")
            .agg(F.min(order).getField("l_extendedprice").alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max(order).getField("l_extendedprice").alias("close"),
                 F.sum("l_quantity").cast("bigint").alias("volume")))


def dirty_bars(spark: SparkSession, sf_dir: str, tickers: int | None = None) -> DataFrame:
    """Bars with damage placed by rule, and a second copy of some, in input order ``src_seq``."""
    seq = F.col("seq")
    day = F.datediff("date", F.lit(FIRST_DAY).cast("date"))
    clean = bars(spark, sf_dir, tickers).withColumn(
        "seq", day * 10 + F.substring("ticker", 2, 9).cast("bigint"))
    copies = F.explode(F.when(seq % 71 == 0, F.array(F.lit(0), F.lit(1)))
                       .otherwise(F.array(F.lit(0))).cast("array<bigint>"))
    first = F.col("src_seq") == 0
    return clean.select("*", copies.alias("src_seq")).select(
        "date", "ticker",
        F.when(first & (seq % 89 == 0), -F.col("open")).otherwise(F.col("open")).alias("open"),
        F.when(first & (seq % 83 == 0), F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        "low",
        F.when(~first, F.col("close") + 1).when(seq % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("close")).alias("close"),
        F.when(first & (seq % 79 == 0), F.lit(0).cast("bigint"))
        .when(first & (seq % 73 == 0), -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        "src_seq")


def dim(spark: SparkSession, sf_dir: str, tickers: int | None = None) -> DataFrame:
    """Companies: one per supplier, or the first ``tickers`` of them; the nation is the sector."""
    supplier = table(spark, sf_dir, "supplier")
    if tickers is not None:
        supplier = supplier.where(F.col("s_suppkey") < tickers)
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        ticker_name(F.col("s_suppkey"), tickers).alias("ticker"),
        F.col("s_name").alias("company_name"), F.col("n_name").alias("sector"))


def as_fact(metrics: DataFrame) -> DataFrame:
    return fact_rows(storage_cast(metrics).drop("overflow"), RUN_TS)


def fact(spark: SparkSession, sf_dir: str, tickers: int | None = None) -> DataFrame:
    return as_fact(add_metrics(bars(spark, sf_dir, tickers)))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: one task run per order."""
    status = (F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "SUCCESS")
              .when(F.col("o_orderstatus") == "P", "RUNNING"))
    task = (F.when(F.col("o_orderkey") % 3 == 0, "extract").when(F.col("o_orderkey") % 3 == 1, "transform")
            .otherwise("load"))
    started = F.col("o_orderdate").cast("timestamp_ntz")
    day = F.col("o_orderdate").cast("date")
    finished = F.timestamp_add("SECOND", (F.col("o_custkey") % 600).cast("int"), started)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("run_"), day.cast("string")).alias("dag_run_id"),
        task.alias("task_name"), ticker_name(F.col("o_custkey"), 10).alias("ticker"),
        day.alias("run_date"), started.alias("started_at"),
        F.when(status != "RUNNING", finished).alias("finished_at"), status.alias("status"),
        F.floor("o_totalprice").cast("int").alias("records_found"),
        (F.col("o_orderkey") % 100).cast("int").alias("records_inserted"),
        (F.col("o_orderkey") % 7).cast("int").alias("records_skipped"),
        (F.col("o_orderkey") % 3).cast("int").alias("records_invalid"),
        F.when(status == "FAILED", F.col("o_orderpriority")).alias("error_message"))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue log: one issue per event."""
    event = F.col("event_id")
    kind = F.col("event_type")
    severity = F.when(kind == "error", "ERROR").when(kind == "signup", "INFO").otherwise("WARNING")
    return table(spark, sf_dir, "events").select(
        event.alias("issue_id"), F.when(event % 50 != 0, event).alias("run_id"),
        F.col("ts").cast("timestamp_ntz").alias("detected_at"), F.col("ts").cast("date").alias("issue_date"),
        ticker_name(F.col("user_id"), 10).alias("ticker"),
        F.concat(F.lit("check_"), (event % 9).cast("string")).alias("check_name"),
        severity.alias("severity"), kind.alias("description"), F.col("props").alias("raw_value"),
        (event % 3 == 0).alias("resolved"))
