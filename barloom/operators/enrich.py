"""Daily return, seven-row average and seven-row volatility.

All three share one window specification, so a run needs a single exchange and sort by ticker. The
input has at most one row per ticker and day (the quality fold or the fact key sees to that), so a
window group is bounded by the calendar, about 36,500 rows per century, however large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.schemas import MIN_RETURNS_FOR_VOLATILITY, WINDOW_ROWS
from barloom.sources.tables import before, stage


def add_metrics(bars: DataFrame, *extra_keys: str) -> DataFrame:
    """Add the metrics over each ticker's rows in date order.

    The return is rounded first and the volatility uses the rounded value; the average uses the
    close as it is. Rounding is half-even.
    """
    by_date = Window.partitionBy("ticker", *extra_keys).orderBy("date")
    last_rows = by_date.rowsBetween(-(WINDOW_ROWS - 1), 0)
    close = F.col("close").cast("double")
    # a zero close can only come from unchecked input; it must not abort the other tickers
    change = F.try_divide(close, F.lag(close).over(by_date)) - 1
    with_return = bars.withColumn("daily_return", F.bround(change, 6))
    returns = F.col("daily_return")
    return (with_return
            .withColumn("moving_avg_7", F.bround(F.avg(close).over(last_rows), 4))
            .withColumn("volatility_7", F.when(
                F.count(returns).over(last_rows) >= MIN_RETURNS_FOR_VOLATILITY,
                F.bround(F.stddev_samp(returns).over(last_rows), 6))))


def add_metrics_by_year(bars: DataFrame) -> DataFrame:
    """``add_metrics`` with a window group per ticker and year, for long histories of few tickers.

    A window of seven rows looks back no further than seven earlier ones, so a year needs only these besides its
    own rows. They come from the newest seven rows of each of the seven years before it in which the ticker has
    any. Groups have at most 366 + 7 rows, and there are as many as tickers times years. ``bars`` is read
    twice, so it should be stored; a row without a date belongs to no year and is not allowed here.
    """
    chunked = bars.withColumn("chunk", F.year("date"))
    newest = Window.partitionBy("ticker", "chunk").orderBy(F.col("date").desc())
    tails = (chunked.select("ticker", "chunk", "date", F.col("close").cast("double").alias("close"))
             .withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= WINDOW_ROWS)
             .groupBy("ticker", "chunk").agg(F.sort_array(F.collect_list(F.struct("date", "close"))).alias("tail")))
    # one row a year: the years before this one, oldest first, hold at least as many rows as are needed
    years_before = Window.partitionBy("ticker").orderBy("chunk").rowsBetween(-WINDOW_ROWS, -1)
    halo = (tails.withColumn("rows", F.flatten(F.collect_list("tail").over(years_before)))
            .select("ticker", "chunk", F.inline(F.expr(f"slice(rows, greatest(size(rows) - {WINDOW_ROWS - 1}, 1), {WINDOW_ROWS})"))))
    both = chunked.withColumn("is_own", F.lit(True)).unionByName(
        halo.withColumn("is_own", F.lit(False)), allowMissingColumns=True)
    return add_metrics(both, "chunk").where("is_own").drop("is_own", "chunk")


def last_stored_rows(fact: DataFrame, rows: int = WINDOW_ROWS) -> DataFrame:
    """The newest stored rows of every ticker.

    Spark limits each map task to ``rows`` per ticker before the exchange. Seven are needed: six
    earlier returns take seven earlier closes.
    """
    newest = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    return (fact.select("ticker", "date", F.col("close").cast("double").alias("close"))
            .withColumn("rank", F.row_number().over(newest))
            .where(F.col("rank") <= rows).drop("rank"))


def older_rows(fact: DataFrame, recent: DataFrame, tickers: DataFrame, recent_from: Column,
               rows: int = WINDOW_ROWS) -> DataFrame:
    """What ``recent`` lacks: the newest rows before ``recent_from`` of tickers that have too few in it.

    Most tickers have enough, so the long history is only probed for the few that do not, and not
    sorted; when there are none, adaptive execution drops the scan.
    """
    enough = recent.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rows)
    short = tickers.select("ticker").join(enough, "ticker", "left_anti")
    return last_stored_rows(before(fact, recent_from).join(short, "ticker", "left_semi"), rows)


def enrich(batch: DataFrame, fact: DataFrame | None = None, scope: str = "history",
           stored: DataFrame | None = None, by_year: bool = False, tasks: int | None = None) -> DataFrame:
    """Metrics for the rows of a batch.

    ``scope="batch"`` looks at the batch alone, so its first rows have no return or volatility.
    ``scope="history"`` puts the last stored rows of each ticker before the batch, which gives the
    same values as one load of everything; ``stored`` holds those rows where they are at hand, else
    they are taken from ``fact``, the newest before the ticker's first row in the batch, so a gap filled
    later gets the same values too. Stored rows not older than the ticker's batch are left out.

    ``by_year`` spreads a ticker's rows over a task per year (``add_metrics_by_year``), with the same values; it
    is for a long history of few tickers, whose batch should be stored, as it is read twice. Otherwise tickers
    are dealt to ``tasks`` tasks, where that is given.
    """
    if scope not in ("batch", "history"):
        raise ValueError(f"unknown scope {scope!r}")
    def with_metrics(bars: DataFrame) -> DataFrame:
        if by_year:
            return add_metrics_by_year(bars)
        return add_metrics(bars.repartition(tasks, "ticker") if tasks else bars)

    if scope == "batch" or (stored is None and fact is None):
        return with_metrics(batch)
    first = batch.groupBy("ticker").agg(F.min("date").alias("first_date"))
    if stored is None:
        # one row per ticker; stored, its size lets Spark broadcast it instead of shuffling the facts twice
        older = last_stored_rows(fact.join(stage(first), "ticker").where(F.col("date") < F.col("first_date")))
    else:
        # no window over whole tickers: one row per ticker, joined to the few stored rows alone
        older = stored.join(first, "ticker").where(F.col("date") < F.col("first_date")).drop("first_date")
    both = batch.withColumn("is_new", F.lit(True)).unionByName(
        older.withColumn("is_new", F.lit(False)), allowMissingColumns=True)
    return with_metrics(both).where("is_new").drop("is_new")


def recompute_metrics(fact: DataFrame, corrections: DataFrame) -> DataFrame:
    """Bars of the corrected tickers with corrected closes and fresh metrics.

    ``corrections`` has ticker, date and close. Tickers without a correction are not read past the
    semi join, their stored metrics being right. A key that is corrected twice, or is not stored, raises.
    """
    keys = corrections.select("ticker", "date")
    repeated = keys.groupBy("ticker", "date").count().where("count > 1").first()
    absent = keys.join(fact.select("ticker", "date"), ["ticker", "date"], "left_anti").first()
    if repeated or absent:
        wrong, why = (repeated, "is given twice") if repeated else (absent, "has no stored row")
        raise ValueError(f"the correction of {wrong.ticker} on {wrong.date} {why}")
    touched = corrections.select("ticker")
    fixes = corrections.select("ticker", "date", F.col("close").alias("new_close"))
    bars = (fact.join(touched, "ticker", "left_semi").join(fixes, ["ticker", "date"], "left")
            .withColumn("close", F.coalesce("new_close", F.col("close").cast("double")))
            .select("date", "ticker", "open", "high", "low", "close", "volume"))
    return add_metrics(bars)
