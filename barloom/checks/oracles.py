"""The registered queries in plain SQL, for an independent engine on the same test tables.

Every text is built from the table expressions below; rounding that decides a result is done on
integers where the other engine would go through doubles.
"""

from __future__ import annotations

TABLES: dict[str, str] = {}

TABLES["bars"] = """
SELECT CAST(l_shipdate AS DATE) AS date, 'S' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS ticker,
       first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS open,
       max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       first(l_extendedprice ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS close,
       CAST(sum(l_quantity) AS BIGINT) AS volume
FROM lineitem GROUP BY 1, 2"""

TABLES["numbered"] = """
SELECT *, date_diff('day', DATE '1995-01-01', date) * 10 + CAST(substr(ticker, 2) AS BIGINT) AS seq FROM bars"""

TABLES["dirty"] = """
SELECT date, ticker, CASE WHEN seq % 89 = 0 THEN -open ELSE open END AS open,
       CASE WHEN seq % 83 = 0 THEN low - 1 ELSE high END AS high, low,
       CASE WHEN seq % 97 = 0 THEN NULL ELSE close END AS close,
       CASE WHEN seq % 79 = 0 THEN 0 WHEN seq % 73 = 0 THEN -volume ELSE volume END AS volume,
       CAST(0 AS BIGINT) AS src_seq FROM numbered
UNION ALL
SELECT date, ticker, open, high, low, close + 1, volume, CAST(1 AS BIGINT) FROM numbered WHERE seq % 71 = 0"""

# the cascade row by row: null, then copy number among complete rows, then price, range, volume
TABLES["judged"] = """
SELECT *, CASE WHEN incomplete THEN 'null_values' WHEN copy > 1 THEN 'duplicate_rows'
               WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'negative_price'
               WHEN high < low THEN 'high_lt_low' WHEN volume < 0 THEN 'negative_volume' ELSE 'ok' END AS verdict
FROM (SELECT *, row_number() OVER (PARTITION BY date, ticker, incomplete ORDER BY src_seq) AS copy
      FROM (SELECT *, (open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL) AS incomplete
            FROM dirty))"""

TABLES["clean"] = "SELECT date, ticker, open, high, low, close, volume FROM judged WHERE verdict = 'ok'"

TABLES["dim"] = """
SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ticker, s_name AS company_name, n_name AS sector
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

TABLES["log"] = """
SELECT o_orderkey AS run_id, 'run_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dag_run_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'transform' ELSE 'load' END AS task_name,
       'S' || lpad(CAST(o_custkey % 10 AS VARCHAR), 2, '0') AS ticker,
       CAST(o_orderdate AS DATE) AS run_date, o_orderdate AS started_at,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(o_custkey % 600) END AS finished_at,
       CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' WHEN 'P' THEN 'RUNNING' END AS status,
       CAST(floor(o_totalprice) AS INTEGER) AS records_found, CAST(o_orderkey % 100 AS INTEGER) AS records_inserted,
       CAST(o_orderkey % 7 AS INTEGER) AS records_skipped, CAST(o_orderkey % 3 AS INTEGER) AS records_invalid,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error_message
FROM orders"""

TABLES["issue"] = """
SELECT event_id AS issue_id, CASE WHEN event_id % 50 <> 0 THEN event_id END AS run_id,
       ts AS detected_at, CAST(ts AS DATE) AS issue_date,
       'S' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS ticker,
       'check_' || CAST(event_id % 9 AS VARCHAR) AS check_name,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'INFO' ELSE 'WARNING' END AS severity,
       event_type AS description, props AS raw_value, event_id % 3 = 0 AS resolved
FROM events"""


def metrics(source: str, keys: str = "ticker") -> str:
    """Return, average and volatility over ``source``."""
    return f"""
SELECT * EXCLUDE (r), r AS daily_return, round_even(avg(close) OVER w7, 4) AS moving_avg_7,
       CASE WHEN count(r) OVER w7 >= 2 THEN round_even(stddev_samp(r) OVER w7, 6) END AS volatility_7
FROM (SELECT *, round_even(close / lag(close) OVER (PARTITION BY {keys} ORDER BY date) - 1, 6) AS r FROM {source})
WINDOW w7 AS (PARTITION BY {keys} ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


STORED = """CAST(open AS DECIMAL(12,4)) AS open, CAST(high AS DECIMAL(12,4)) AS high,
       CAST(low AS DECIMAL(12,4)) AS low, CAST(close AS DECIMAL(12,4)) AS close, volume,
       CAST(daily_return AS DECIMAL(10,6)) AS daily_return,
       CAST(CAST(high AS DECIMAL(12,4)) - CAST(low AS DECIMAL(12,4)) AS DECIMAL(12,4)) AS price_range,
       CAST(moving_avg_7 AS DECIMAL(12,4)) AS moving_avg_7, CAST(volatility_7 AS DECIMAL(10,6)) AS volatility_7"""

TABLES["enriched"] = metrics("bars")
TABLES["clean_enriched"] = metrics("clean")
TABLES["fact"] = f"SELECT date, ticker, {STORED}, TIMESTAMP '2001-11-05 06:00:00' AS loaded_at FROM enriched"
TABLES["recent"] = "SELECT * FROM fact WHERE date >= DATE '2001-11-04' - INTERVAL 90 DAY"

# one row per issue of the cascade
TABLES["cascade_issues"] = """
SELECT ticker, CAST(NULL AS DATE) AS issue_date, 'null_values' AS check_name, 'ERROR' AS severity,
       'Column ''close'' has ' || CAST(count(*) AS VARCHAR) || ' null value(s)' AS description,
       CAST(NULL AS VARCHAR) AS raw_value
FROM dirty WHERE close IS NULL GROUP BY ticker
UNION ALL
SELECT ticker, NULL, 'duplicate_rows', 'ERROR',
       CAST(count(*) AS VARCHAR) || ' duplicate (date, ticker) row(s) found', NULL
FROM judged WHERE verdict = 'duplicate_rows' GROUP BY ticker
UNION ALL
SELECT ticker, NULL, 'negative_price', 'ERROR',
       'Column ''' || name || ''' has ' || CAST(count(*) AS VARCHAR) || ' non-positive value(s)',
       '[' || array_to_string(list_slice(list(CAST(date AS VARCHAR) ORDER BY date), 1, 5), ', ') || ']'
FROM (SELECT ticker, date, unnest(['open', 'high', 'low', 'close']) AS name, unnest([open, high, low, close]) AS price
      FROM judged WHERE verdict = 'negative_price') WHERE price <= 0 GROUP BY ticker, name
UNION ALL
SELECT ticker, date, 'high_lt_low', 'ERROR',
       'High (' || CAST(high AS VARCHAR) || ') < Low (' || CAST(low AS VARCHAR) || ')',
       'high=' || CAST(high AS VARCHAR) || ' low=' || CAST(low AS VARCHAR)
FROM judged WHERE verdict = 'high_lt_low'
UNION ALL
SELECT ticker, NULL, 'zero_volume', 'WARNING', CAST(count(*) AS VARCHAR) || ' row(s) with zero volume', NULL
FROM judged WHERE verdict = 'ok' AND volume = 0 GROUP BY ticker
UNION ALL
SELECT ticker, NULL, 'negative_volume', 'ERROR', CAST(count(*) AS VARCHAR) || ' row(s) with negative volume', NULL
FROM judged WHERE verdict = 'negative_volume' GROUP BY ticker"""

TABLES["extreme_issues"] = """
SELECT ticker, date AS issue_date, 'extreme_return' AS check_name, 'WARNING' AS severity,
       'Daily return ' || CAST(CAST(CAST(daily_return AS DECIMAL(10,6)) * 100 AS DECIMAL(24,2)) AS VARCHAR)
       || '% exceeds ±50%' AS description, CAST(daily_return AS VARCHAR) AS raw_value
FROM clean_enriched WHERE abs(daily_return) > 0.5"""

USES = {
    "numbered": ["bars"], "dirty": ["numbered"], "judged": ["dirty"], "clean": ["judged"],
    "enriched": ["bars"], "clean_enriched": ["clean"], "fact": ["enriched"], "recent": ["fact"],
    "cascade_issues": ["judged"], "extreme_issues": ["clean_enriched"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        for x in [*_closure(USES.get(n, [])), n]:
            if x not in out:
                out.append(x)
    return out


def sql(uses: str, body: str) -> str:
    """``body`` behind the table expressions it uses."""
    parts = [f"{n} AS ({TABLES[n]}\n)" for n in _closure(uses.split())]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


BAR = "date, ticker, open, high, low, close, volume"
ISSUE = "ticker, issue_date, check_name, severity, description, raw_value"
ODD_NOT = "CAST(substr(ticker, 2) AS BIGINT) % 2 = 0"


def _mean(c: str, unit: int, places: int) -> str:
    """Mean of a decimal column of scale ``unit``, rounded half away from zero on integers."""
    total = f"CAST(sum({c}) * {10 ** unit} AS HUGEINT)"
    step = 10 ** (unit - places)
    return f"CAST(CAST((2 * {total} + {step} * count({c})) // (2 * {step} * count({c})) AS DOUBLE) / {10 ** places} AS DECIMAL(18,{places}))"


ORACLES: dict[str, str] = {
    "bars_source": sql("bars", f"SELECT {BAR} FROM bars"),
    "staged_bars": sql("bars", f"SELECT {BAR} FROM bars"),
    "watermarks": sql("bars", "SELECT ticker, max(date) AS last_date FROM bars WHERE date < DATE '2000-01-01' GROUP BY ticker"),
    "incremental_filter": sql("bars dim", f"""
SELECT b.date, b.ticker, b.open, b.high, b.low, b.close, b.volume
FROM bars b JOIN dim USING (ticker) LEFT JOIN (
    SELECT ticker, max(date) AS last_date FROM bars
    WHERE date < DATE '2000-01-01' AND ({ODD_NOT} OR date < DATE '1999-01-01') GROUP BY ticker) m USING (ticker)
WHERE b.date > coalesce(last_date, DATE '1994-12-31') AND b.date < DATE '2001-11-05'"""),
    "empty_extracts": sql("bars dim", """
SELECT ticker, start, CASE WHEN isodow(start) < 6 AND start < DATE '2000-01-04' THEN 'WARN' ELSE 'expected' END AS outcome,
       CAST(0 AS INTEGER) AS rows_fetched, 'empty_response' AS reason
FROM (SELECT dim.ticker, CAST(coalesce(max(date) + 1, DATE '1995-01-01') AS DATE) AS start
      FROM dim LEFT JOIN (SELECT * FROM bars WHERE date < DATE '2000-01-01') b ON b.ticker = dim.ticker
      GROUP BY dim.ticker) s
WHERE NOT EXISTS (SELECT 1 FROM bars n WHERE n.ticker = s.ticker AND n.date >= s.start AND n.date < DATE '2000-01-04')"""),

    "enriched_bars": sql("enriched", f"SELECT {BAR}, daily_return, moving_avg_7, volatility_7 FROM enriched"),
    "enrich_batch_scope": sql("bars", f"SELECT {BAR}, daily_return, moving_avg_7, volatility_7 FROM ("
                              + metrics("(SELECT *, date >= DATE '2000-01-01' AS later FROM bars)", "ticker, later") + ")"),
    "enrich_history_scope": sql("enriched", f"""
SELECT {BAR}, daily_return, moving_avg_7, volatility_7 FROM enriched WHERE date >= DATE '2000-01-01'"""),
    "recompute_metrics": sql("bars", f"SELECT date, ticker, {STORED} FROM (" + metrics("""(
    SELECT * REPLACE (CASE WHEN date = min(CASE WHEN date >= DATE '1998-01-01' THEN date END) OVER (PARTITION BY ticker)
                           THEN close + 100 ELSE close END AS close) FROM bars
    WHERE ticker IN (SELECT ticker FROM bars WHERE date >= DATE '1998-01-01'))""") + ")"),

    "check_missing_columns": sql("bars", """
SELECT DISTINCT ticker, CAST(NULL AS DATE) AS issue_date, 'missing_columns' AS check_name, 'ERROR' AS severity,
       'Required columns missing: [''close'', ''volume'']' AS description, CAST(NULL AS VARCHAR) AS raw_value FROM bars"""),
    "check_date_format": sql("dirty", """
SELECT ticker, CAST(NULL AS DATE) AS issue_date, 'date_format' AS check_name, 'ERROR' AS severity,
       'Cannot parse dates: ' || CAST(count(*) AS VARCHAR) || ' row(s)' AS description, CAST(NULL AS VARCHAR) AS raw_value
FROM (SELECT ticker, CASE WHEN day(date) = 13 THEN 'day ' ELSE '' END || CAST(date AS VARCHAR) AS raw FROM dirty)
WHERE TRY_CAST(raw AS DATE) IS NULL GROUP BY ticker"""),
    "verdicts_with_text_dates": sql("judged", """
SELECT ticker, CASE WHEN day(date) = 13 THEN 'date_format' ELSE verdict END AS verdict, count(*) AS n_rows
FROM judged GROUP BY 1, 2"""),
    "verdicts": sql("judged", "SELECT ticker, verdict, count(*) AS n_rows FROM judged GROUP BY 1, 2"),
    "clean_bars": sql("clean", f"SELECT {BAR} FROM clean"),
    "issues": sql("cascade_issues extreme_issues", f"SELECT {ISSUE} FROM cascade_issues UNION ALL SELECT {ISSUE} FROM extreme_issues"),
    "quality_summary": sql("judged cascade_issues", """
SELECT r.ticker, raw_rows, clean_rows, coalesce(total_issues, 0) AS total_issues, coalesce(errors, 0) AS errors,
       coalesce(warnings, 0) AS warnings, total_issues IS NULL AS checks_passed
FROM (SELECT ticker, count(*) AS raw_rows, count(*) FILTER (WHERE verdict = 'ok') AS clean_rows FROM judged GROUP BY ticker) r
LEFT JOIN (SELECT ticker, count(*) AS total_issues, count(*) FILTER (WHERE severity = 'ERROR') AS errors,
                  count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM cascade_issues GROUP BY ticker) i
ON r.ticker = i.ticker"""),

    "typed_fact": sql("fact", "SELECT * FROM fact"),
    "idempotent_load": sql("bars", f"""
SELECT {BAR} FROM bars WHERE date < DATE '2000-01-01'
UNION ALL
SELECT date, ticker, open, high, low, close + 1, volume FROM bars b WHERE NOT EXISTS (
    SELECT 1 FROM bars s WHERE s.date < DATE '2000-01-01' AND s.date = b.date AND s.ticker = b.ticker)"""),
    "load_counts": sql("bars", """
SELECT ticker, CAST(attempted AS BIGINT) AS attempted, CAST(inserted AS BIGINT) AS inserted,
       CAST(attempted - inserted AS BIGINT) AS skipped
FROM (SELECT ticker, sum(CASE WHEN day(date) = 15 THEN 2 ELSE 1 END) AS attempted,
             count(*) FILTER (WHERE date >= DATE '2000-01-01') AS inserted FROM bars GROUP BY ticker)"""),
    "ticker_isolation": sql("bars dim", """
SELECT b.ticker, CASE WHEN bool_or(CAST(substr(b.ticker, 2) AS BIGINT) % 7 = 0 AND day(date) = 1)
                      THEN 'numeric field overflow in column high'
                      WHEN k.ticker IS NULL THEN 'ticker ' || b.ticker || ' is not in dim_company' END AS load_error,
       count(*) AS n_rows
FROM bars b LEFT JOIN (SELECT ticker FROM dim WHERE sector <> 'NATION_3') k ON k.ticker = b.ticker
GROUP BY b.ticker, k.ticker"""),
    "not_null_violations": sql("dirty", """
SELECT 'close' AS "column", count(*) AS violations FROM dirty WHERE close IS NULL HAVING count(*) > 0"""),
    "enum_violations": """
SELECT o_orderstatus AS value, count(*) AS violations FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1
UNION ALL
SELECT upper(event_type), count(*) FROM events
WHERE upper(event_type) NOT IN ('ERROR', 'WARNING', 'INFO') GROUP BY 1""",
    "length_violations": sql("log", """
SELECT 'error_message' AS "column", count(*) AS violations FROM log WHERE length(error_message) > 8 HAVING count(*) > 0
UNION ALL
SELECT 'task_name', count(*) FROM log WHERE length(task_name) > 7 HAVING count(*) > 0"""),
    "fk_orphans": sql("bars dim", """
SELECT ticker, date FROM bars WHERE ticker NOT IN (SELECT ticker FROM dim WHERE sector <> 'NATION_3')"""),
    "pk_violations": sql("dirty", """
SELECT date, ticker, count(*) AS copies FROM dirty GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dim_upsert": sql("dim", f"""
SELECT coalesce(n.ticker, o.ticker) AS ticker,
       CASE WHEN n.ticker IS NULL THEN o.company_name ELSE n.company_name END AS company_name,
       CASE WHEN n.ticker IS NULL THEN o.sector ELSE n.sector END AS sector,
       CASE WHEN o.ticker IS NULL THEN TIMESTAMP '2001-12-01 06:00:00' ELSE TIMESTAMP '2001-11-05 06:00:00' END AS created_at,
       CASE WHEN n.ticker IS NULL THEN TIMESTAMP '2001-11-05 06:00:00' ELSE TIMESTAMP '2001-12-01 06:00:00' END AS updated_at
FROM dim o FULL JOIN (
    SELECT ticker, company_name || ' Ltd' AS company_name, sector FROM dim WHERE {ODD_NOT}
    UNION ALL
    SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), c_name, NULL FROM customer) n ON n.ticker = o.ticker"""),
    "surrogate_ids": "SELECT count(*) AS ids, count(DISTINCT o_orderkey) AS distinct_ids FROM orders",

    "run_log_state": sql("log", """
SELECT run_id, dag_run_id, task_name, ticker, run_date, started_at, finished_at, status,
       CASE WHEN status = 'RUNNING' THEN 0 ELSE records_found END AS records_found,
       CASE WHEN status = 'RUNNING' THEN 0 ELSE records_inserted END AS records_inserted,
       CASE WHEN status = 'RUNNING' THEN 0 ELSE records_skipped END AS records_skipped,
       CASE WHEN status = 'RUNNING' THEN 0 ELSE records_invalid END AS records_invalid, error_message,
       CASE WHEN status <> 'RUNNING' THEN ticker END AS details_ticker,
       CASE WHEN status <> 'RUNNING' THEN records_found END AS attempted
FROM log"""),
    "daily_run": sql("judged clean dim", """
, runs AS (SELECT 'first' AS run, DATE '1900-01-01' AS after, DATE '2000-01-01' AS until, ticker FROM dim
         UNION ALL
         SELECT 'second', coalesce(max(date), DATE '1900-01-01'), DATE '2001-11-05', dim.ticker
         FROM dim LEFT JOIN (SELECT * FROM clean WHERE date < DATE '2000-01-01') c ON c.ticker = dim.ticker
         GROUP BY dim.ticker),
seen AS (SELECT r.run, j.* FROM runs r JOIN judged j ON j.ticker = r.ticker AND j.date > r.after AND j.date < r.until),
per AS (SELECT run, ticker, count(*) AS n, count(*) FILTER (WHERE verdict = 'ok') AS ok,
               CAST(any_value(1) FILTER (WHERE verdict = 'null_values') AS BIGINT) AS nulls,
               CAST(any_value(1) FILTER (WHERE verdict = 'duplicate_rows') AS BIGINT) AS dupes,
               CAST(any_value(1) FILTER (WHERE verdict = 'negative_price') AS BIGINT) AS prices,
               count(*) FILTER (WHERE verdict = 'high_lt_low') AS ranges,
               CAST(any_value(1) FILTER (WHERE verdict = 'negative_volume') AS BIGINT) AS volumes
        FROM seen GROUP BY run, ticker)
SELECT run AS dag_run_id, task_name, ticker, 'SUCCESS' AS status, CAST(found AS INTEGER) AS records_found,
       CAST(inserted AS INTEGER) AS records_inserted, CAST(0 AS INTEGER) AS records_skipped,
       CAST(invalid AS INTEGER) AS records_invalid
FROM (SELECT r.run, 'extract' AS task_name, r.ticker, coalesce(n, 0) AS found, 0 AS inserted, 0 AS invalid
      FROM runs r LEFT JOIN per ON per.run = r.run AND per.ticker = r.ticker
      UNION ALL
      SELECT run, 'transform', ticker, ok, 0, coalesce(nulls, 0) + coalesce(dupes, 0) + coalesce(prices, 0) + ranges
             + coalesce(volumes, 0) FROM per
      UNION ALL
      SELECT run, 'load', ticker, ok, ok, 0 FROM per WHERE ok > 0)"""),
    "daily_run_facts": sql("clean_enriched", f"SELECT date, ticker, {STORED} FROM clean_enriched"),
    "run_gate": sql("log issue", """
SELECT dag_run_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS error_count, coalesce(sum(n), 0) = 0 AS passed
FROM log LEFT JOIN (SELECT run_id, count(*) AS n FROM issue WHERE severity = 'ERROR' AND NOT resolved GROUP BY run_id) e
ON e.run_id = log.run_id GROUP BY dag_run_id"""),
    "run_history": sql("log", """
SELECT run_id, dag_run_id, task_name, ticker, run_date, started_at, finished_at,
       CAST(round_even(date_diff('microsecond', started_at, finished_at) / 1000000.0, 0) AS INTEGER) AS duration_sec,
       status, records_found, records_inserted, records_skipped, records_invalid, error_message
FROM log ORDER BY started_at DESC, run_id DESC LIMIT 50"""),
    "run_log_recent": sql("log", """
SELECT task_name, ticker, records_found, records_inserted, status FROM log ORDER BY started_at DESC, run_id DESC LIMIT 10"""),
    "unresolved_issues": sql("log issue", """
SELECT issue_id, detected_at, issue.ticker, issue_date, check_name, severity, description, raw_value, dag_run_id
FROM issue LEFT JOIN log ON issue.run_id = log.run_id WHERE resolved = FALSE ORDER BY severity DESC, detected_at DESC"""),
    "error_count": sql("log issue", """
SELECT count(*) AS error_count FROM issue JOIN log ON issue.run_id = log.run_id
WHERE dag_run_id = 'run_1999-01-24' AND severity = 'ERROR' AND resolved = FALSE"""),

    "best_performer": sql("recent dim", """
SELECT ticker, company_name, CAST(round((last_close - first_close) / nullif(first_close, 0) * 100, 2) AS DECIMAL(18,2)) AS total_return_pct
FROM (SELECT f.ticker, company_name, max(close) FILTER (WHERE date = first_date) AS first_close,
             max(close) FILTER (WHERE date = last_date) AS last_close
      FROM fact f JOIN dim USING (ticker), (SELECT min(date) AS first_date, max(date) AS last_date FROM recent) s
      WHERE date BETWEEN first_date AND last_date GROUP BY f.ticker, company_name)"""),
    "range_return": sql("recent dim", """
SELECT ticker, company_name, CAST(round((max(close) - min(close)) / min(close) * 100, 2) AS DECIMAL(18,2)) AS return_pct
FROM recent JOIN dim USING (ticker) GROUP BY ticker, company_name"""),
    "most_volatile": sql("recent dim", f"""
SELECT ticker, company_name, {_mean("volatility_7", 6, 6)} AS avg_volatility,
       CAST(round(stddev_samp(CAST(daily_return AS DOUBLE)), 6) AS DECIMAL(18,6)) AS stddev_return
FROM recent JOIN dim USING (ticker) WHERE volatility_7 IS NOT NULL GROUP BY ticker, company_name"""),
    "close_stats": sql("fact dim", f"""
SELECT ticker, company_name, {_mean("close", 4, 2)} AS avg_close,
       CAST(round(min(close), 2) AS DECIMAL(18,2)) AS min_close, CAST(round(max(close), 2) AS DECIMAL(18,2)) AS max_close,
       count(*) AS trading_days
FROM fact JOIN dim USING (ticker) GROUP BY ticker, company_name"""),
    "price_trend": sql("fact dim", """
SELECT date, ticker, company_name, close, moving_avg_7, daily_return,
       CASE WHEN daily_return > 0 THEN 'UP' WHEN daily_return < 0 THEN 'DOWN' ELSE 'FLAT' END AS day_direction
FROM fact JOIN dim USING (ticker) WHERE date >= DATE '2001-11-04' - INTERVAL 30 DAY"""),
}

for _key, _checks in {
    "check_null_values": ["null_values"], "check_duplicates": ["duplicate_rows"],
    "check_negative_prices": ["negative_price"], "check_high_low": ["high_lt_low"],
    "check_volume": ["zero_volume", "negative_volume"],
}.items():
    _list = ", ".join(f"'{c}'" for c in _checks)
    ORACLES[_key] = sql("cascade_issues", f"SELECT {ISSUE} FROM cascade_issues WHERE check_name IN ({_list})")
ORACLES["check_extreme_return"] = sql("extreme_issues", f"SELECT {ISSUE} FROM extreme_issues")

_TOTALS = """CAST(sum(records_found) AS BIGINT) AS found, CAST(sum(records_inserted) AS BIGINT) AS inserted,
       CAST(sum(records_skipped) AS BIGINT) AS skipped, CAST(sum(records_invalid) AS BIGINT) AS invalid,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_tasks FROM log"""
ORACLES["run_summary"] = sql("log", f"SELECT task_name, {_TOTALS} WHERE dag_run_id = 'run_1999-01-24' GROUP BY task_name")
ORACLES["run_summary_all"] = sql("log", f"SELECT dag_run_id, task_name, {_TOTALS} GROUP BY 1, 2")
ORACLES["ignored_rows"] = sql("bars dim", """
SELECT ticker, count(*) AS n_rows FROM bars
WHERE ticker NOT IN (SELECT ticker FROM dim WHERE sector <> 'NATION_3') AND date < DATE '2001-11-05' GROUP BY ticker""")
# the entries of both runs under one name; every task run has an id of its own
_RUNS = ORACLES["daily_run"].replace("'first' AS run", "1 AS run").replace("'second'", "2")
ORACLES["rerun_log"] = f"""
SELECT 'same' AS dag_run_id, task_name, status, count(*) AS entries, count(*) AS ids,
       CAST(sum(records_found) AS BIGINT) AS found, CAST(sum(records_inserted) AS BIGINT) AS inserted
FROM ({_RUNS}) GROUP BY task_name, status"""

# a folder whose files are opened once: the sector that is listed after the first run loads whole in the second
ORACLES["landing_folder_facts"] = ORACLES["daily_run_facts"]
ORACLES["landing_folder_ignored"] = sql("dirty dim", """
SELECT 'first' AS dag_run_id, ticker, count(*) AS n_rows FROM dirty JOIN dim USING (ticker)
WHERE sector = 'NATION_3' AND date < DATE '2000-01-01' GROUP BY ticker""")
ORACLES["landing_folder_log"] = sql("judged clean dim", """
, marks AS (SELECT dim.ticker, sector, coalesce(max(date) FILTER (WHERE sector <> 'NATION_3'), DATE '1900-01-01') AS mark
            FROM dim LEFT JOIN (SELECT * FROM clean WHERE date < DATE '2000-01-01') c ON c.ticker = dim.ticker GROUP BY ALL),
firsts AS (SELECT ticker, any_value(sector) AS sector, count(date) AS n, count(date) FILTER (WHERE verdict = 'ok') AS ok
           FROM dim LEFT JOIN (SELECT * FROM judged WHERE date < DATE '2000-01-01') j USING (ticker)
           WHERE sector <> 'NATION_3' GROUP BY ticker),
-- files are by month and the split is at a month's turn: what was due before it is not fetched again, except for the new sector
seconds AS (SELECT m.ticker, any_value(sector) AS sector, count(date) AS n, count(date) FILTER (WHERE verdict = 'ok') AS ok
            FROM marks m LEFT JOIN judged j ON j.ticker = m.ticker AND j.date > m.mark AND j.date < DATE '2001-11-05'
             AND (sector = 'NATION_3' OR j.date >= DATE '2000-01-01') GROUP BY m.ticker),
last AS (SELECT ticker, 'third' AS run, 0 AS n, 0 AS ok FROM dim),
per AS (SELECT ticker, 'first' AS run, n, ok FROM firsts UNION ALL SELECT ticker, 'second', n, ok FROM seconds UNION ALL FROM last)
SELECT run AS dag_run_id, task_name, 'SUCCESS' AS status, count(*) AS entries, CAST(sum(found) AS BIGINT) AS found,
       CAST(sum(inserted) AS BIGINT) AS inserted
FROM (SELECT run, 'extract' AS task_name, n AS found, 0 AS inserted FROM per
      UNION ALL SELECT run, 'transform', ok, 0 FROM per WHERE n > 0
      UNION ALL SELECT run, 'load', ok, ok FROM per WHERE ok > 0) GROUP BY ALL""")

_HUGE = "SELECT * REPLACE (CASE WHEN CAST(substr(ticker, 2) AS BIGINT) % 7 = 0 AND day(date) = 1 THEN 1e8 ELSE high END AS high) FROM dirty"
ORACLES["quarantined_rows"] = sql("dirty", f"""
, huge AS ({_HUGE}),
judged AS ({TABLES["judged"].replace("FROM dirty", "FROM (FROM huge WHERE day(date) <> 13)")}),
kept AS (SELECT *, CASE WHEN date < DATE '2000-01-01' THEN 'first' ELSE 'second' END AS run FROM judged
         WHERE verdict = 'ok' AND date < DATE '2001-11-05'),
-- a ticker fails in the first run if one of its bars until then overflows, in the second if any does
failed AS (SELECT ticker, min(run) AS run FROM kept WHERE high = 1e8 GROUP BY ticker)
SELECT date, ticker, open, high, low, close, volume, CAST(NULL AS VARCHAR) AS bad_date, kept.run AS dag_run_id,
       'numeric field overflow in column high' AS error_message
FROM kept JOIN failed USING (ticker) WHERE failed.run = 'first' OR kept.run = 'second'
UNION ALL
SELECT DISTINCT NULL, ticker, open, high, low, close, volume, 'day ' || CAST(date AS VARCHAR), 'first', 'date_format'
FROM huge WHERE day(date) = 13""")
ORACLES["correction_applied"] = sql("bars", f"SELECT date, ticker, {STORED} FROM (" + metrics("""(
    SELECT * REPLACE (CASE WHEN CAST(substr(ticker, 2) AS BIGINT) % 3 = 0 AND date = min(
        CASE WHEN date >= DATE '1998-01-01' THEN date END) OVER (PARTITION BY ticker) THEN close + 100 ELSE close END AS close)
    FROM bars)""") + ")")
ORACLES["stored_keys"] = sql("bars", "SELECT date, ticker FROM bars WHERE date < DATE '2000-01-01'")
ORACLES["close_stats_of_years"] = ORACLES["close_stats"]
ORACLES["enriched_by_year"] = ORACLES["enriched_bars"]
ORACLES["sealed_rerun_log"] = ORACLES["rerun_log"]
ORACLES["date_notations"] = sql("bars", f"SELECT {BAR}, CAST(NULL AS VARCHAR) AS bad_date FROM bars")
