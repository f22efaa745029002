"""Table schemas, key metadata and the fixed values of the data model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# These decide results, so they are stated once, here, and nowhere else.

REQUIRED = ["date", "open", "high", "low", "close", "volume"]
PRICES = ["open", "high", "low", "close"]
VALUES = ["open", "high", "low", "close", "volume"]
FACT_INPUT = ["date", "ticker", "open", "high", "low", "close", "volume",
              "daily_return", "moving_avg_7", "volatility_7"]

FIRST_LOAD_DATE = dt.date(2020, 1, 1)
WINDOW_ROWS = 7
MIN_RETURNS_FOR_VOLATILITY = 2
EXTREME_RETURN = 0.50

STATUSES = ["RUNNING", "SUCCESS", "FAILED"]
SEVERITIES = ["ERROR", "WARNING", "INFO"]
TASKS = ["extract", "transform", "load"]

# check name -> severity
CHECKS = {
    "missing_columns": "ERROR",
    "date_format": "ERROR",
    "null_values": "ERROR",
    "duplicate_rows": "ERROR",
    "negative_price": "ERROR",
    "high_lt_low": "ERROR",
    "zero_volume": "WARNING",
    "negative_volume": "ERROR",
    "extreme_return": "WARNING",
}

# ticker, company name, sector of the production list
COMPANIES = [
    ("AAPL", "Apple Inc.", "Technology"),
    ("MSFT", "Microsoft Corporation", "Technology"),
    ("AMZN", "Amazon.com Inc.", "Consumer Cyclical"),
    ("GOOGL", "Alphabet Inc.", "Technology"),
    ("META", "Meta Platforms Inc.", "Technology"),
    ("TSLA", "Tesla Inc.", "Consumer Cyclical"),
    ("NVDA", "NVIDIA Corporation", "Technology"),
    ("JPM", "JPMorgan Chase & Co.", "Financial Services"),
    ("JNJ", "Johnson & Johnson", "Healthcare"),
    ("V", "Visa Inc.", "Financial Services"),
]

# storage types
PRICE = T.DecimalType(12, 4)
RATIO = T.DecimalType(10, 6)

# longest text per column
TEXT_LIMITS = {
    "fact_stock_prices": {"ticker": 10},
    "dim_company": {"ticker": 10, "company_name": 100, "sector": 100},
    "audit_pipeline_log": {"dag_run_id": 200, "task_name": 100, "ticker": 10, "status": 20},
    "audit_quality_issues": {"ticker": 10, "check_name": 100, "severity": 10},
}
# --- end of fixed values ----------------------------------------------------

RAW_BARS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

FACT = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("open", PRICE, False),
    T.StructField("high", PRICE, False),
    T.StructField("low", PRICE, False),
    T.StructField("close", PRICE, False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("daily_return", RATIO),
    T.StructField("price_range", PRICE),
    T.StructField("moving_avg_7", PRICE),
    T.StructField("volatility_7", RATIO),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# stored days of a ticker and year as bits, and what its closes add up to
DAY_WORDS = [f"days_{i}" for i in range(6)]
DAY_SUMMARY = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    *[T.StructField(w, T.LongType(), False) for w in DAY_WORDS],
    T.StructField("n", T.LongType(), False),
    T.StructField("sum_close", T.DecimalType(22, 4)),
    T.StructField("min_close", PRICE),
    T.StructField("max_close", PRICE),
    T.StructField("last_date", T.DateType()),
])

DIM_COMPANY = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("company_name", T.StringType(), False),
    T.StructField("sector", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("dag_run_id", T.StringType()),
    T.StructField("task_name", T.StringType(), False),
    T.StructField("ticker", T.StringType()),
    T.StructField("run_date", T.DateType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("records_found", T.IntegerType()),
    T.StructField("records_inserted", T.IntegerType()),
    T.StructField("records_skipped", T.IntegerType()),
    T.StructField("records_invalid", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("details", T.StringType()),
])

# The run log is kept as START / END events; RUN_LOG is their latest state.
RUN_EVENTS = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("event_seq", T.IntegerType(), False),
    T.StructField("dag_run_id", T.StringType()),
    T.StructField("task_name", T.StringType(), False),
    T.StructField("ticker", T.StringType()),
    T.StructField("run_date", T.DateType(), False),
    T.StructField("event_at", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("records_found", T.IntegerType()),
    T.StructField("records_inserted", T.IntegerType()),
    T.StructField("records_skipped", T.IntegerType()),
    T.StructField("records_invalid", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
])

ISSUES = T.StructType([
    T.StructField("issue_id", T.LongType(), False),
    T.StructField("run_id", T.LongType()),
    T.StructField("detected_at", T.TimestampNTZType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("issue_date", T.DateType()),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("resolved", T.BooleanType()),
])

TABLES = {
    "fact_stock_prices": FACT,
    "dim_company": DIM_COMPANY,
    "audit_pipeline_log": RUN_LOG,
    "audit_quality_issues": ISSUES,
}

PRIMARY_KEYS = {
    "fact_stock_prices": ["date", "ticker"],
    "dim_company": ["ticker"],
    "audit_pipeline_log": ["run_id"],
    "audit_quality_issues": ["issue_id"],
}

# child table, child column -> parent table, parent column
FOREIGN_KEYS = {
    ("fact_stock_prices", "ticker"): ("dim_company", "ticker"),
    ("audit_quality_issues", "run_id"): ("audit_pipeline_log", "run_id"),
}

ENUMS = {
    ("audit_pipeline_log", "status"): STATUSES,
    ("audit_quality_issues", "severity"): SEVERITIES,
}


def required_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]
