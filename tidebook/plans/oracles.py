"""The queries' results in DuckDB SQL, written independently of the operators."""

from __future__ import annotations

from tidebook.plans.queries import ODD_PAYLOADS, TODAY

BARS = """bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""
CLOSES = "closes AS (SELECT symbol, date, close FROM bars)"
GAPPED = "closes AS (SELECT symbol, date, CASE WHEN month(date) = 6 AND day(date) = 13 THEN NULL ELSE close END AS close FROM bars)"


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


def _sma_columns() -> str:
    return ", ".join(
        f"CASE WHEN close IS NOT NULL AND count(close) OVER w{p} = {p} THEN round(avg(close) OVER w{p}, 6) + 0.0 END AS sma_{p}" for p in (20, 50, 200)
    )


SEGMENTS = "seg AS MATERIALIZED (SELECT *, sum(CASE WHEN close IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS seg FROM closes)"
SMA_WINDOWS = "WINDOW " + ", ".join(f"w{p} AS (PARTITION BY symbol, seg ORDER BY date ROWS {p - 1} PRECEDING)" for p in (20, 50, 200))
ORDERED = """o AS MATERIALIZED (
  SELECT symbol, date, seg, close, row_number() OVER w AS n, close - lag(close) OVER w AS d,
         avg(close) OVER (PARTITION BY symbol, seg ORDER BY date ROWS 11 PRECEDING) AS s12, avg(close) OVER (PARTITION BY symbol, seg ORDER BY date ROWS 25 PRECEDING) AS s26
  FROM seg WHERE close IS NOT NULL WINDOW w AS (PARTITION BY symbol, seg ORDER BY date))"""


def _ema(name: str, source: str, period: int, seed: str, value: str = "close", first: int | None = None) -> str:
    first = first or period
    return f"""{name} AS (
  SELECT symbol, date, seg, n, {seed} AS e FROM {source} WHERE n = {first}
  UNION ALL
  SELECT s.symbol, s.date, s.seg, s.n, (s.{value} - p.e) * (2.0::DOUBLE / {period + 1}) + p.e
  FROM {name} p JOIN {source} s ON s.symbol = p.symbol AND s.seg = p.seg AND s.n = p.n + 1)"""


RSI = """g AS MATERIALIZED (
  SELECT *, CASE WHEN d > 0 THEN d ELSE 0 END AS gain, CASE WHEN d < 0 THEN -d ELSE 0 END AS loss FROM o),
g14 AS MATERIALIZED (
  SELECT *, avg(gain) OVER w AS ag0, avg(loss) OVER w AS al0 FROM g WINDOW w AS (PARTITION BY symbol, seg ORDER BY date ROWS 13 PRECEDING)),
rs AS (
  SELECT symbol, date, seg, n, ag0 AS ag, al0 AS al FROM g14 WHERE n = 15
  UNION ALL
  SELECT s.symbol, s.date, s.seg, s.n, (p.ag * 13 + s.gain) / 14, (p.al * 13 + s.loss) / 14
  FROM rs p JOIN g14 s ON s.symbol = p.symbol AND s.seg = p.seg AND s.n = p.n + 1),
rsi AS (SELECT symbol, date, CASE WHEN al = 0 THEN 100.0 ELSE 100 - 100 / (1 + ag / al) END AS rsi_14 FROM rs)"""
MACD = ", ".join([
    _ema("e12", "o", 12, "s12"), _ema("e26", "o", 26, "s26"),
    """m AS MATERIALIZED (SELECT a.symbol, a.date, a.seg, a.n, a.e - b.e AS macd FROM e12 a JOIN e26 b USING (symbol, date)),
m9 AS MATERIALIZED (SELECT *, avg(macd) OVER (PARTITION BY symbol, seg ORDER BY date ROWS 8 PRECEDING) AS s9 FROM m)""",
    _ema("sig", "m9", 9, "s9", "macd", 34),
])
MACD_COLUMNS = f"{r6('m.macd', 'macd_12_26')}, {r6('sig.e', 'macd_signal_9')}, {r6('m.macd - sig.e', 'macd_hist')}"
FLAT = "closes AS (SELECT symbol, date, 7.5::DOUBLE AS close FROM bars)"

TEXT_BARS = """text_rows AS (
  SELECT symbol, CAST(date AS VARCHAR) AS date,
    CASE WHEN day(date) = 3 THEN 'n/a' ELSE CAST(CAST(open AS DECIMAL(18,2)) AS VARCHAR) END AS open,
    CASE WHEN day(date) = 5 THEN '-1' ELSE CAST(CAST(high AS DECIMAL(18,2)) AS VARCHAR) END AS high,
    CAST(CAST(low AS DECIMAL(18,2)) AS VARCHAR) AS low,
    CASE WHEN day(date) = 7 THEN '' WHEN day(date) = 9 THEN 'nan' ELSE CAST(CAST(close AS DECIMAL(18,2)) AS VARCHAR) END AS close,
    CASE WHEN day(date) = 11 THEN '-5' WHEN day(date) = 13 THEN NULL ELSE CAST(CAST(volume AS BIGINT) AS VARCHAR) END AS volume
  FROM bars),
text_bars AS (SELECT * FROM text_rows UNION ALL SELECT * FROM text_rows WHERE substr(date, 9, 2) = '17')"""
INVALID = """(TRY_CAST(high AS DOUBLE) < TRY_CAST(low AS DOUBLE) OR TRY_CAST(volume AS DOUBLE) < 0 OR TRY_CAST(open AS DOUBLE) IS NULL OR TRY_CAST(high AS DOUBLE) IS NULL
  OR TRY_CAST(low AS DOUBLE) IS NULL OR TRY_CAST(close AS DOUBLE) IS NULL OR TRY_CAST(volume AS DOUBLE) IS NULL)"""
TEXT_SMA = ", ".join(
    f"CASE WHEN c IS NOT NULL AND count(c) OVER w{p} = {p} THEN regexp_replace(regexp_replace(printf('%.6f', avg(c) OVER w{p}), '0+$', ''), '\\.$', '') ELSE '' END AS sma_{p}"
    for p in (20, 50, 200)
)
DUPES = "dupes AS (SELECT symbol, date, count(*) AS n FROM text_bars GROUP BY 1, 2 HAVING count(*) > 1)"

LOG = """log AS (
  SELECT 'primary' AS provider, CAST(event_id % 3 AS INTEGER) AS key_index, CAST(user_id AS VARCHAR) AS symbol,
    CASE event_type WHEN 'purchase' THEN 'done' WHEN 'click' THEN 'failed' WHEN 'view' THEN 'skipped_rate_limit' WHEN 'signup' THEN 'done' ELSE 'dry_run' END AS status,
    event_id AS rows, ts AS "at", event_id AS seq FROM events),
latest AS (
  SELECT provider, symbol, arg_max(status, row("at", seq)) AS status, max("at") AS updated_at, arg_max(rows, row("at", seq)) AS rows,
    max(CASE WHEN status = 'done' THEN "at" END) AS last_success_at FROM log GROUP BY 1, 2)"""
SYMBOLS = "symbols AS (SELECT c_custkey AS line, CAST(c_custkey AS VARCHAR) AS symbol FROM customer)"
SUCCEEDED = f"SELECT symbol FROM latest WHERE CAST(last_success_at AS DATE) = DATE '{TODAY}'"
KEYS = """keys(provider, key_index, has_key, daily_limit, daily_reserve, enabled) AS (VALUES
  ('primary', 0, TRUE, 800, 700, TRUE), ('primary', 1, TRUE, 800, 100, TRUE), ('primary', 2, FALSE, 800, 100, TRUE), ('backup', 0, TRUE, 25, 5, TRUE), ('off', 0, TRUE, 25, 5, FALSE))"""
SLOTS = f"""used AS (SELECT provider, key_index, count(*) AS n FROM log WHERE status IN ('done', 'failed') AND CAST("at" AS DATE) = DATE '{TODAY}' GROUP BY 1, 2),
slots AS (
  SELECT k.provider, k.key_index, has_key, coalesce(n, 0) AS calls_used, greatest(0, greatest(0, daily_limit - daily_reserve) - coalesce(n, 0)) AS remaining, enabled
  FROM keys k LEFT JOIN used u ON u.provider = k.provider AND u.key_index = k.key_index)"""
WRITES = """writes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS symbol, CAST(l_linenumber AS VARCHAR) AS date, l_quantity AS quantity, l_extendedprice AS price, CAST(l_shipdate AS DATE) AS day, l_partkey, l_suppkey FROM lineitem)"""
MACRO = """macro AS (
  SELECT o_orderstatus AS symbol, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
    CASE day(CAST(o_orderdate AS DATE)) WHEN 1 THEN '.' WHEN 2 THEN '' ELSE CAST(count(*) AS VARCHAR) END AS value FROM orders GROUP BY o_orderstatus, CAST(o_orderdate AS DATE))"""

#: What the odd payloads say.
SAID = {
    ("bar_list", "a"): "rate limit reached", ("bar_list", "b"): "error", ("bar_list", "c"): "missing values", ("bar_map", "a"): "slow down", ("bar_map", "b"): "plan",
    ("bar_map", "c"): "bad", ("bar_map", "d"): "missing series", ("bar_map", "e"): "None", ("macro", "a"): "Bad Request", ("macro", "b"): "m", ("macro", "c"): "missing observations",
    ("news", "a"): "no access", ("news", "b"): "unexpected object response", ("news", "d"): "not a list", ("listing", "a"): "401", ("listing", "b"): "missing data list",
}


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


ORACLES: dict[str, str] = {
    "ohlcv_bars": f"WITH {BARS} SELECT * FROM bars",
    "event_bars": """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, round(arg_min(value, row(ts, event_id)), 6) + 0.0 AS open, round(max(value), 6) + 0.0 AS high,
      round(min(value), 6) + 0.0 AS low, round(arg_max(value, row(ts, event_id)), 6) + 0.0 AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2""",
    "sma": f"WITH {BARS}, {CLOSES}, {SEGMENTS} SELECT symbol, date, round(close, 6) + 0.0 AS close, {_sma_columns()} FROM seg {SMA_WINDOWS}",
    "sma_with_gaps": f"WITH {BARS}, {GAPPED}, {SEGMENTS} SELECT symbol, date, round(close, 6) + 0.0 AS close, {_sma_columns()} FROM seg {SMA_WINDOWS}",
    "ema_12": f"WITH RECURSIVE {BARS}, {CLOSES}, {SEGMENTS}, {ORDERED}, {_ema('e12', 'o', 12, 's12')} SELECT c.symbol, c.date, {r6('e', 'ema_12')} FROM closes c LEFT JOIN e12 USING (symbol, date)",
    "ema_with_gaps": f"""WITH RECURSIVE {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}, {_ema('e12', 'o', 12, 's12')}, {_ema('e26', 'o', 26, 's26')}
      SELECT c.symbol, c.date, {r6('e12.e', 'ema_12')}, {r6('e26.e', 'ema_26')} FROM closes c LEFT JOIN e12 USING (symbol, date) LEFT JOIN e26 USING (symbol, date)""",
    "rsi_14": f"WITH RECURSIVE {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}, {RSI} SELECT c.symbol, c.date, {r6('rsi_14', 'rsi_14')} FROM closes c LEFT JOIN rsi USING (symbol, date)",
    "rsi_flat": f"WITH {BARS} SELECT symbol, date, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date) > 14 THEN 100.0::DOUBLE END AS rsi_14 FROM bars",
    "macd": f"""WITH RECURSIVE {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}, {MACD}
      SELECT c.symbol, c.date, {MACD_COLUMNS} FROM closes c LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)""",
    "scanned_indicators": f"""WITH RECURSIVE {BARS.replace("o_orderpriority AS symbol", "'ALL' AS symbol")}, {GAPPED}, {SEGMENTS}, {ORDERED}, {MACD}, {RSI}
      SELECT c.symbol, c.date, close, round(rsi_14, 4) + 0.0 AS rsi_14, round(m.macd, 4) + 0.0 AS macd_12_26, round(sig.e, 4) + 0.0 AS macd_signal_9, round(m.macd - sig.e, 4) + 0.0 AS macd_hist
      FROM closes c LEFT JOIN rsi USING (symbol, date) LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)""",
    "indicators_full": f"""WITH RECURSIVE {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}, {MACD}, {RSI},
      sma AS (SELECT symbol, date, {_sma_columns()} FROM seg {SMA_WINDOWS})
      SELECT c.symbol, c.date, round(c.close, 6) + 0.0 AS close, sma_20, sma_50, sma_200, {r6('rsi_14', 'rsi_14')}, {MACD_COLUMNS}
      FROM closes c LEFT JOIN sma USING (symbol, date) LEFT JOIN rsi USING (symbol, date) LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)""",
    "indicators_by_sql": f"""WITH RECURSIVE {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}, {MACD}, {RSI},
      sma AS (SELECT symbol, date, {_sma_columns()} FROM seg {SMA_WINDOWS})
      SELECT c.symbol, CAST(c.date AS VARCHAR) AS date, round(c.close, 6) + 0.0 AS close, sma_20, sma_50, sma_200, {r6('rsi_14', 'rsi_14')}, {MACD_COLUMNS}
      FROM closes c LEFT JOIN sma USING (symbol, date) LEFT JOIN rsi USING (symbol, date) LEFT JOIN m USING (symbol, date) LEFT JOIN sig USING (symbol, date)""",
    "indicator_text": f"""WITH {BARS}, {TEXT_BARS}, closes AS (SELECT *, TRY_CAST(close AS DOUBLE) AS c FROM text_rows),
      seg AS (SELECT *, sum(CASE WHEN c IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS seg FROM closes)
      SELECT symbol, date, open, coalesce(volume, '') AS volume, {TEXT_SMA} FROM seg {SMA_WINDOWS}""",
    "indicators_processed": f"""WITH {BARS}, n AS (SELECT symbol, count(*) AS rows FROM bars GROUP BY 1), asked AS (SELECT symbol FROM n UNION ALL SELECT n_name FROM nation)
      SELECT symbol, CASE WHEN rows > 0 THEN 'done' ELSE 'missing_ohlcv' END AS status, coalesce(rows, 0) AS rows FROM asked LEFT JOIN n USING (symbol)""",
    "price_delta_gain_loss": f"""WITH {BARS}, {GAPPED}, {SEGMENTS}, {ORDERED}
      SELECT c.symbol, c.date, round(c.close, 6) + 0.0 AS close, CASE WHEN d IS NOT NULL THEN round(greatest(d, 0), 6) + 0.0 END AS gain,
        CASE WHEN d IS NOT NULL THEN round(greatest(-d, 0), 6) + 0.0 END AS loss FROM closes c LEFT JOIN o USING (symbol, date)""",
    "upsert_last_wins": f"""WITH {WRITES} SELECT symbol, date, quantity, price, day FROM writes
      QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY day DESC, l_partkey DESC, l_suppkey DESC, price DESC) = 1""",
    "upsert_idempotent": f"""WITH {WRITES}, w AS (SELECT symbol, date, quantity, price, CAST(day AS VARCHAR) AS stamp FROM writes),
      stored AS (SELECT * FROM w WHERE stamp < '1999-01-01' QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY stamp DESC, price DESC, quantity DESC) = 1),
      incoming AS (SELECT * FROM w WHERE stamp >= '1997-01-01' AND date <> '4' QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY stamp DESC, price DESC, quantity DESC) = 1)
      SELECT * FROM incoming UNION ALL SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.symbol = s.symbol AND i.date = s.date)""",
    "duplicate_keys": f'WITH {WRITES} SELECT symbol, date, count(*) AS "count" FROM writes GROUP BY 1, 2 HAVING count(*) > 1',
    "invalid_rows": f"WITH {BARS}, {TEXT_BARS} SELECT * FROM text_bars WHERE {INVALID}",
    "validation_issues": f"""WITH {BARS}, {TEXT_BARS}, {DUPES}
      SELECT 'ohlcv' AS dataset, 'duplicate_date' AS type, symbol, date, n AS "count" FROM dupes
      UNION ALL SELECT 'ohlcv', 'invalid_numeric_or_range', symbol, date, NULL FROM text_bars WHERE {INVALID}""",
    "validation_rollup": f"""WITH {BARS}, {TEXT_BARS}, {DUPES}, n AS (SELECT (SELECT count(*) FROM dupes) + (SELECT count(*) FROM text_bars WHERE {INVALID}) AS issue_count)
      SELECT CASE WHEN issue_count = 0 THEN 'pass' ELSE 'fail' END AS status, issue_count, (SELECT count(*) FROM bars) AS rows_indicators, (SELECT count(*) FROM orders) AS rows_macro,
        (SELECT count(*) FROM documents) AS rows_news, (SELECT count(*) FROM text_bars) AS rows_ohlcv FROM n""",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("orders", "lineitem", "events", "documents")),
    "symbol_history": f"WITH {BARS} SELECT date, open, high, low, close, volume FROM bars WHERE symbol = '1-URGENT' ORDER BY date",
    "normalize_ohlcv_list": f"""WITH {BARS} SELECT symbol AS "key", CAST(date AS VARCHAR) AS date, CAST(CAST(open AS DECIMAL(18,2)) AS VARCHAR) AS open, CAST(CAST(high AS DECIMAL(18,2)) AS VARCHAR) AS high,
      CAST(CAST(low AS DECIMAL(18,2)) AS VARCHAR) AS low, CAST(CAST(close AS DECIMAL(18,2)) AS VARCHAR) AS close, CAST(CAST(volume AS BIGINT) AS VARCHAR) AS volume FROM bars""",
    "normalize_macro": f"""WITH {MACRO} SELECT symbol AS "key", date, value, '' AS realtime_start, 'x' AS realtime_end FROM macro""",
    "normalize_news": """SELECT source AS "key", CAST(doc_id AS VARCHAR) AS id, strftime(make_timestamp((1700000000 + doc_id * 3600) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS datetime,
      strftime(make_timestamp((1700000000 + doc_id * 3600) * 1000000), '%Y-%m-%d') AS date, text AS headline, '' AS source, '' AS summary, '' AS url,
      CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS image, lang AS category FROM documents""",
    "normalize_errors": """SELECT doc_id, kind, form, CASE WHEN error = 'bad' THEN 'bad ' || coalesce(lang, 'none') ELSE error END AS error, coalesce(contains(lower(error), 'rate limit'), FALSE) AS rate_limited
      FROM documents JOIN (VALUES """
    + ", ".join(f"({n}, '{k}', '{form}', CAST({_quoted(SAID.get((k, form)))} AS VARCHAR))" for n, (k, form, _) in enumerate(ODD_PAYLOADS))
    + f") v(n, kind, form, error) ON doc_id % {len(ODD_PAYLOADS)} = n",
    "listing_symbols": "SELECT DISTINCT upper(trim(p_brand)) AS symbol FROM part ORDER BY 1",
    "merge_symbols": """WITH a AS (SELECT 0 AS list, c_custkey AS line, upper(trim(c_mktsegment)) AS symbol FROM customer
      UNION ALL SELECT 1, p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'BUILDING' ELSE upper(trim(p_brand)) END FROM part)
      SELECT list, line, symbol FROM a QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY list, line) = 1""",
    "latest_status": f"WITH {LOG} SELECT * FROM latest",
    "pending_symbols": f"""WITH {LOG}, {SYMBOLS}, ranked AS (
        SELECT s.symbol, s.line, CAST(CASE WHEN status = 'failed' THEN 0 WHEN status IS NULL THEN 1 WHEN status = 'skipped_rate_limit' THEN 2 ELSE 3 END AS INTEGER) AS priority
        FROM symbols s LEFT JOIN latest USING (symbol) WHERE s.symbol NOT IN ({SUCCEEDED}))
      SELECT * FROM ranked ORDER BY priority, line LIMIT 700""",
    "done_today": f"WITH {LOG} SELECT least(count(*), 100) AS progress_done, CAST(100 AS BIGINT) AS progress_total FROM ({SUCCEEDED})",
    "not_done_today": f"WITH {LOG}, {SYMBOLS} SELECT symbol FROM symbols WHERE symbol NOT IN ({SUCCEEDED})",
    "budget_remaining": f"WITH {LOG}, {KEYS}, {SLOTS} SELECT provider, key_index, has_key, enabled, calls_used, CAST(remaining AS BIGINT) AS remaining, (enabled AND has_key AND remaining > 0) AS allowed FROM slots",
    "call_decisions": f"""WITH {LOG}, {KEYS}, {SLOTS} SELECT provider, key_index, CASE WHEN NOT enabled THEN 'provider_disabled' WHEN remaining >= 50 THEN 'ok' ELSE 'daily_budget_reserved' END AS reason,
      (enabled AND remaining >= 50) AS allowed_cost FROM slots""",
    "active_key": f"""WITH {LOG}, {KEYS}, {SLOTS} SELECT provider, min(CASE WHEN enabled AND has_key AND remaining > 0 THEN key_index END) AS key_index,
      CAST(sum(CASE WHEN has_key THEN remaining ELSE 0 END) AS BIGINT) AS total_remaining FROM slots GROUP BY provider""",
    "allocated_calls": f"""WITH {LOG.replace("SELECT 'primary' AS provider", "SELECT CASE WHEN event_id % 4 = 0 THEN 'backup' ELSE 'primary' END AS provider")}, {SYMBOLS}, {KEYS}, {SLOTS},
      limits(provider, most) AS (VALUES ('primary', 450), ('backup', 700), ('off', 700)),
      lists AS (SELECT provider, line, symbol, most FROM symbols, limits WHERE provider = 'primary' OR provider = 'backup' AND line % 3 = 0 OR provider = 'off' AND line % 10 = 0),
      waiting AS (SELECT l.provider, l.symbol, l.line, most, CASE WHEN status = 'failed' THEN 0 WHEN status IS NULL THEN 1 WHEN status = 'skipped_rate_limit' THEN 2 ELSE 3 END AS priority
        FROM lists l LEFT JOIN latest t ON t.provider = l.provider AND t.symbol = l.symbol WHERE coalesce(CAST(last_success_at AS DATE) <> DATE '{TODAY}', TRUE)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY priority, line) AS n FROM waiting),
      ends AS (SELECT provider, key_index, sum(remaining) OVER (PARTITION BY provider ORDER BY key_index) AS until FROM slots WHERE enabled AND has_key AND remaining > 0)
      SELECT provider, symbol, line, priority, n, (SELECT min(key_index) FROM ends e WHERE e.provider = r.provider AND e.until >= r.n) AS key_index
      FROM ranked r WHERE n <= most AND n <= 1 + coalesce((SELECT max(until) FROM ends e WHERE e.provider = r.provider), 0)""",
    "news_days": f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'soon' WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 20 - 1 AS INTEGER) AS VARCHAR) END AS from_date,
        CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 <> 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS to_date, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 30 AS INTEGER) END AS days_back FROM orders),
      d AS (SELECT *, CASE WHEN coalesce(to_date, '') = '' THEN DATE '{TODAY}' ELSE TRY_CAST(to_date AS DATE) END AS z FROM r),
      e AS (SELECT *, CASE WHEN from_date IS NULL THEN z - coalesce(days_back, 7) ELSE TRY_CAST(from_date AS DATE) END AS a FROM d)
      SELECT o_orderkey, from_date, to_date, days_back, CAST(CAST(a AS DATE) AS VARCHAR) AS first, CAST(z AS VARCHAR) AS last, coalesce(a <= z, FALSE) AS in_order FROM e""",
    "calls_in_last_minute": """SELECT event_id, event_type AS "key", count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS calls FROM events""",
    "run_counters": f"""WITH {LOG} SELECT CAST("at" AS DATE) AS run, count(*) FILTER (status IN ('done', 'dry_run')) AS processed, count(*) FILTER (status = 'failed') AS failed,
      count(*) FILTER (status = 'skipped_rate_limit') AS skipped FROM log GROUP BY 1""",
    "last_20_runs": "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 20",
    "daily_summary": f"""WITH {BARS}, {MACRO} SELECT '{TODAY}' AS date, (SELECT count(*) FROM pages) AS raw_count, (SELECT count(*) FROM bars) AS indicators, (SELECT count(*) FROM macro) AS macro,
      (SELECT count(*) FROM documents) AS news, (SELECT count(*) FROM bars) AS ohlcv, (SELECT count(*) FROM orders) AS run_count, (SELECT max(o_orderkey) FROM orders) AS last_run""",
    "summary_message": f"""WITH {BARS}, {MACRO} SELECT 'summary of {TODAY}: raw_count=' || (SELECT count(*) FROM pages) || ' ohlcv=' || (SELECT count(*) FROM bars) || ' indicators=' || (SELECT count(*) FROM bars)
      || ' macro=' || (SELECT count(*) FROM macro) || ' news=' || (SELECT count(*) FROM documents) AS message""",
    "format6": """SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 3 THEN '' ELSE
      regexp_replace(regexp_replace(printf('%.6f', l_extendedprice * (1 - l_discount) / 7.0::DOUBLE), '0+$', ''), '\\.$', '') END AS text FROM lineitem""",
    "try_double": """WITH f AS (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem), t AS (
        SELECT *, CASE l_partkey % 11 WHEN 0 THEN q WHEN 1 THEN ' ' || q || ' ' WHEN 2 THEN '+' || q WHEN 3 THEN q || 'e2' WHEN 4 THEN q || 'd' WHEN 5 THEN '0x' || q
          WHEN 6 THEN q || ',5' WHEN 7 THEN 'nan' WHEN 8 THEN 'inf' WHEN 9 THEN '--' || q ELSE '' END AS s FROM f),
      v AS (SELECT *, CASE WHEN l_partkey % 11 = 5 THEN NULL ELSE TRY_CAST(s AS DOUBLE) END AS d FROM t)
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN NOT isnan(d) THEN d END AS value, coalesce(isnan(d), FALSE) AS not_a_number FROM v""",
    "raw_archive_counts": "SELECT regexp_extract(url, '^(\\w+):', 1) AS provider, count(*) AS files FROM pages GROUP BY 1",
}
ORACLES["normalize_ohlcv_map"] = ORACLES["normalize_ohlcv_list"]
