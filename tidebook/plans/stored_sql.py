"""What the queries through sources, stored tables and streams give, in DuckDB SQL over the tables they began with."""

from __future__ import annotations

from tidebook.plans.oracles import BARS, INVALID, LOG, MACD, ORDERED, RSI, SEGMENTS, SMA_WINDOWS, SUCCEEDED, SYMBOLS, TEXT_BARS
from tidebook.plans.queries import TODAY
from tidebook.plans.stored import STAMPS

TEXT = f"""{BARS}, texts AS (
  SELECT symbol, CAST(date AS VARCHAR) AS date, CAST(CAST(open AS DECIMAL(18,2)) AS VARCHAR) AS open, CAST(CAST(high AS DECIMAL(18,2)) AS VARCHAR) AS high,
    CAST(CAST(low AS DECIMAL(18,2)) AS VARCHAR) AS low, CAST(CAST(close AS DECIMAL(18,2)) AS VARCHAR) AS close, CAST(CAST(volume AS BIGINT) AS VARCHAR) AS volume FROM bars)"""
STORED = f"""{TEXT}, stored AS (
  SELECT symbol, date, open, high, low, close, CASE WHEN date >= '1997' THEN volume || '0' ELSE volume END AS volume, CASE WHEN date >= '1997' THEN '{STAMPS[1]}' ELSE '{STAMPS[0]}' END AS updated_at FROM texts)"""
#: Of two keys with 20 calls each 40 are spent, and the symbol behind them is skipped.
RESULTS = f"""{SYMBOLS}, results AS (
  SELECT symbol, line, CASE WHEN n > 40 THEN 'skipped_rate_limit' WHEN CAST(symbol AS INTEGER) % 10 IN (3, 5, 7) THEN 'failed' ELSE 'done' END AS status,
    CASE WHEN n > 40 OR CAST(symbol AS INTEGER) % 10 IN (3, 5, 7) THEN 0 ELSE CAST(symbol AS INTEGER) % 10 + 1 END AS rows,
    CASE WHEN n > 40 THEN 'all_keys_exhausted' WHEN CAST(symbol AS INTEGER) % 10 = 3 THEN 'no route' WHEN CAST(symbol AS INTEGER) % 10 = 5 THEN 'unknown symbol' WHEN CAST(symbol AS INTEGER) % 10 = 7 THEN 'no rows' END AS error
  FROM (SELECT *, row_number() OVER (ORDER BY line) AS n FROM symbols) WHERE n <= 41)"""


def _text(value: str, name: str) -> str:
    """A number as text, nothing as the empty text."""
    return f"coalesce(regexp_replace(regexp_replace(printf('%.6f', {value}), '0+$', ''), '\\.$', ''), '') AS {name}"


def _sma(p: int) -> str:
    return f"CASE WHEN count(close) OVER w{p} = {p} THEN avg(close) OVER w{p} END AS sma_{p}"


#: All indicators of the bars as text, with a gap in every other year, however they were come by.
KEPT_UP = f"""WITH RECURSIVE {TEXT}, gapped AS (SELECT * REPLACE (CASE WHEN substr(date, 6) = '06-13' AND CAST(substr(date, 1, 4) AS INTEGER) % 2 = 0 THEN '' ELSE close END AS close) FROM texts),
  closes AS (SELECT symbol, date, TRY_CAST(close AS DOUBLE) AS close FROM gapped), {SEGMENTS}, {ORDERED}, {MACD}, {RSI},
  sma AS (SELECT symbol, date, {_sma(20)}, {_sma(50)}, {_sma(200)} FROM seg {SMA_WINDOWS})
  SELECT t.*, {_text('sma_20', 'sma_20')}, {_text('sma_50', 'sma_50')}, {_text('sma_200', 'sma_200')}, {_text('rsi_14', 'rsi_14')},
    {_text('m.macd', 'macd_12_26')}, {_text('sig.e', 'macd_signal_9')}, {_text('m.macd - sig.e', 'macd_hist')}
  FROM gapped t LEFT JOIN sma USING (symbol, date) LEFT JOIN rsi USING (symbol, date) LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)"""

#: Batches of broken and repeated bars, an empty text where there is no value.
CHECKED = f"""{BARS}, {TEXT_BARS}, flagged AS (SELECT *, CASE WHEN {INVALID} THEN 'invalid_numeric_or_range' ELSE 'stored' END AS outcome FROM text_bars),
  batches AS (
    SELECT 1 AS batch, '{STAMPS[0]}' AS updated_at, * FROM flagged WHERE date < '1997' UNION ALL SELECT 2, '{STAMPS[1]}', * FROM flagged WHERE date >= '1996'
    UNION ALL SELECT 2, '{STAMPS[1]}', * REPLACE ('' AS date, 'no_key' AS outcome) FROM flagged WHERE substr(date, 6) = '02-02')"""

ORACLES: dict[str, str] = {
    "checked_counts": f"""WITH {CHECKED}, keys AS (SELECT batch, updated_at, symbol, date, count(*) AS n FROM batches WHERE outcome = 'stored' GROUP BY ALL),
      faults AS (SELECT DISTINCT batch, symbol, date, open, high, low, close, volume, outcome FROM batches WHERE outcome <> 'stored')
      SELECT 'ohlcv' AS "table", batch, updated_at AS "at", count(*) AS stored, count(*) FILTER (n > 1) AS duplicate_keys,
        (SELECT count(*) FROM faults f WHERE f.batch = k.batch AND outcome = 'no_key') AS no_key,
        (SELECT count(*) FROM faults f WHERE f.batch = k.batch AND outcome <> 'no_key') AS faulty FROM keys k GROUP BY batch, updated_at""",
    "checked_bars": f"WITH {CHECKED} SELECT symbol, date, open, high, low, close, volume, max(updated_at) AS updated_at FROM batches WHERE outcome = 'stored' GROUP BY ALL",
    "quarantined_bars": f"WITH {CHECKED} SELECT DISTINCT symbol, date, open, high, low, close, volume, outcome, batch FROM batches WHERE outcome <> 'stored'",
    "stored_bars": f"WITH {STORED} SELECT * FROM stored",
    "stored_history": f"WITH {STORED} SELECT date, open, high, low, close, volume FROM stored WHERE symbol = '3-MEDIUM'",
    "stored_indicators": f"""WITH RECURSIVE {TEXT}, closes AS (SELECT symbol, date, CAST(close AS DOUBLE) AS close FROM texts), {SEGMENTS}, {ORDERED}, {MACD}, {RSI},
      sma AS (SELECT symbol, date, {_sma(20)}, {_sma(50)}, {_sma(200)} FROM seg {SMA_WINDOWS})
      SELECT t.*, {_text('sma_20', 'sma_20')}, {_text('sma_50', 'sma_50')}, {_text('sma_200', 'sma_200')}, {_text('rsi_14', 'rsi_14')},
        {_text('m.macd', 'macd_12_26')}, {_text('sig.e', 'macd_signal_9')}, {_text('m.macd - sig.e', 'macd_hist')}, CASE WHEN t.symbol IN ('1-URGENT', '2-HIGH') THEN '{STAMPS[1]}' ELSE '{STAMPS[0]}' END AS updated_at
      FROM texts t LEFT JOIN sma USING (symbol, date) LEFT JOIN rsi USING (symbol, date) LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)""",
    "incremental_indicators": KEPT_UP,
    "corrected_indicators": KEPT_UP,
    "live_stream_indicators": KEPT_UP,
    "written_report": f"WITH {STORED} SELECT 'pass' AS status, CAST(0 AS BIGINT) AS issue_count, CAST(0 AS BIGINT) AS rows_indicators, CAST(0 AS BIGINT) AS rows_macro, CAST(0 AS BIGINT) AS rows_news, count(*) AS rows_ohlcv FROM stored",
    "written_summary": f"WITH {STORED} SELECT '{TODAY}' AS date, CAST(0 AS BIGINT) AS raw_count, count(*) AS ohlcv, CAST(0 AS BIGINT) AS news, CAST(0 AS BIGINT) AS run_count FROM stored",
    "recorded_statuses": f"WITH {LOG} SELECT provider, symbol, status, rows, last_success_at FROM latest",
    "archived_payloads": "SELECT regexp_extract(url, '^(\\w+):', 1) AS provider, page_id % 2 + 1 AS seq, count(*) AS payloads, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes FROM pages GROUP BY 1, 2",
    "archived_files": "SELECT CAST(n_regionkey AS BIGINT) AS region, CAST(1 AS BIGINT) AS files, CAST(sum(octet_length(encode(n_name)) + 1) AS BIGINT) AS bytes FROM nation GROUP BY n_regionkey",
    "streamed_bars": f"WITH {TEXT} SELECT symbol, date, open, high, low, close, CASE WHEN substr(date, 6, 2) = '03' THEN 'again' ELSE volume END AS volume FROM texts",
    "stream_progress": f"WITH {TEXT} SELECT CAST(2 AS BIGINT) AS runs, 'ended' AS status, count(*) AS rows FROM texts",
    "replayed_stream": f"""WITH {TEXT}, listed AS (SELECT symbol, count(*) AS payload_rows, (row_number() OVER (ORDER BY symbol) - 1) // 2 AS stretch FROM texts GROUP BY 1)
      SELECT symbol, date, open, high, low, close, volume, 'done' AS status, payload_rows, stretch + 1 AS batch FROM texts JOIN listed USING (symbol)""",
    "collected_run": f"WITH {RESULTS} SELECT symbol, status, CAST(rows AS BIGINT) AS rows, error FROM results",
    "collected_bars": f"""WITH {RESULTS} SELECT symbol, '2024-01-' || lpad(CAST(d AS VARCHAR), 2, '0') AS date, symbol AS close, '{TODAY} 22:30:00' AS updated_at
      FROM results, range(1, 12) t(d) WHERE d <= rows""",
    "recorded_runs": f"""WITH {RESULTS} SELECT CAST(1 AS BIGINT) AS seq, 'primary' AS provider, 'bar_list' AS kind, 'finished' AS status, FALSE AS force, count(*) FILTER (status = 'done') AS processed,
      count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped_rate_limit') AS skipped_rate_limit, CAST(40 AS BIGINT) AS total_remaining_start FROM results""",
    "configured_symbols": """SELECT line, symbol FROM (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS line, trim(p_brand) AS symbol, p_partkey FROM part)
      WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0""",
    "configured_keys": """WITH k AS (SELECT n_nationkey AS n, n_name, 0 AS key_index, CASE WHEN n_nationkey % 2 = 0 THEN FALSE ELSE n_nationkey % 4 = 0 END AS has_key FROM nation
        UNION ALL SELECT n_nationkey, n_name, 1, n_nationkey % 4 = 0 FROM nation WHERE n_nationkey % 2 = 0)
      SELECT n_name AS provider, key_index, has_key, CAST(n * 10 AS BIGINT) AS daily_limit, CAST(30 AS BIGINT) AS daily_reserve, n % 3 = 0 AS enabled FROM k""",
    "news_archive": "SELECT CAST(conv_id AS VARCHAR) AS symbol, '2024-01-13' AS \"from\", '2024-01-20' AS \"to\", CAST(count(*) AS INTEGER) AS items, arg_min(role, turn) AS first FROM conversations GROUP BY 1",
    "archive_names": "SELECT c_custkey, replace(replace(c_name, '#', '/'), '/', '_') || '_20240120T000000Z.json' AS name FROM customer",
    "dry_run_statuses": f"""WITH {LOG.replace("FROM events)", f"FROM events WHERE CAST(ts AS DATE) < DATE '{TODAY}')")}, {SYMBOLS}
      SELECT symbol, 'dry_run' AS status, CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS payloads FROM (
        SELECT s.symbol FROM symbols s LEFT JOIN latest USING (symbol) ORDER BY CASE WHEN status = 'failed' THEN 0 WHEN status IS NULL THEN 1 WHEN status = 'skipped_rate_limit' THEN 2 ELSE 3 END, s.line LIMIT 20)""",
    "current_run": f"""WITH {LOG}, g AS (SELECT *, date_diff('day', DATE '2024-01-01', CAST("at" AS DATE)) + 1 AS run FROM log), m AS (SELECT * FROM g WHERE run = (SELECT max(run) FROM g) AND run >= 30)
      SELECT run AS seq, count(*) FILTER (status IN ('done', 'dry_run')) AS processed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped_rate_limit') AS skipped,
        arg_max(symbol, row("at", symbol)) AS last_symbol, max("at") AS updated_at FROM m GROUP BY run""",
    "kept_files": "SELECT * FROM (VALUES ('ohlcv', CAST(5 AS BIGINT)), ('indicators', 0), ('macro', 0), ('news', 1)) t(dataset, files)",
    "first_series": f"WITH {SYMBOLS} SELECT line, symbol FROM symbols ORDER BY line LIMIT 25",
    "stored_news": """SELECT source AS symbol, CAST(doc_id AS VARCHAR) AS id, strftime(make_timestamp((1700000000 + doc_id * 3600) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS datetime,
      strftime(make_timestamp((1700000000 + doc_id * 3600) * 1000000), '%Y-%m-%d') AS date, text AS headline, '' AS source, '' AS summary, '' AS url,
      CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS image, lang AS category FROM documents
      WHERE source = (SELECT min(source) FROM documents) AND CAST(make_timestamp((1700000000 + doc_id * 3600) * 1000000) AS DATE) BETWEEN DATE '2023-11-15' AND DATE '2023-12-31'""",
    "progress_text": f"WITH {LOG} SELECT 'collected ' || least(count(*), 100) || ' of 100' AS message FROM ({SUCCEEDED})",
}
