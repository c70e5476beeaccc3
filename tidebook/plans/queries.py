"""The engine's queries over the sample tables: orders and events stand for trades, calls and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import casts
from tidebook.operators import bars as bar_ops
from tidebook.operators import indicators, listing, normalize, planner, scan, summary, table_functions, upsert, validate

TODAY = "2024-01-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to so many places, and no negative zeros."""
    return df.select(*[(F.round(c, places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- inputs ---------------------------------------------------------------------


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return bar_ops.daily_bars(orders, F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_totalprice"), [F.col("o_orderkey")])


def gap() -> Column:
    return (F.month("date") == 6) & (F.dayofmonth("date") == 13)


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_bars(spark, sf_dir).select("symbol", "date", F.when(~gap(), F.col("close")).alias("close"))


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_bars(spark, sf_dir).select("symbol", "date", "close")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bars as text, some of them broken and some stored twice."""
    b = order_bars(spark, sf_dir)
    day = F.dayofmonth("date")
    rows = b.select(
        "symbol", F.col("date").cast("string").alias("date"),
        F.when(day == 3, F.lit("n/a")).otherwise(money("open")).alias("open"),
        F.when(day == 5, F.lit("-1")).otherwise(money("high")).alias("high"),
        money("low").alias("low"),
        F.when(day == 7, F.lit("")).when(day == 9, F.lit("nan")).otherwise(money("close")).alias("close"),
        F.when(day == 11, F.lit("-5")).when(day == 13, F.lit(None).cast("string")).otherwise(F.col("volume").cast("bigint").cast("string")).alias("volume"),
    )
    return rows.unionByName(rows.where("substring(date, 9, 2) = '17'"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a fetch log: users are symbols."""
    kinds = F.create_map(*[F.lit(x) for x in ("purchase", "done", "click", "failed", "view", "skipped_rate_limit", "signup", "done")])
    events = table(spark, sf_dir, "events")
    return events.select(
        F.lit("primary").alias("provider"), F.pmod("event_id", F.lit(3)).cast("int").alias("key_index"), F.col("user_id").cast("string").alias("symbol"),
        F.coalesce(kinds[F.col("event_type")], F.lit("dry_run")).alias("status"), F.col("event_id").alias("rows"),
        F.lit(None).cast("string").alias("error"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"),
    )


def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a list of symbols: more than ever were asked for."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), F.col("c_custkey").cast("string").alias("symbol"))


def lines_as_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("symbol"), F.col("l_linenumber").cast("string").alias("date"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").cast("date").alias("day"), "l_partkey", "l_suppkey",
    )


# --- queries --------------------------------------------------------------------


def ohlcv_bars(spark, sf_dir):
    return order_bars(spark, sf_dir)


def event_bars(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(bar_ops.daily_bars(events, F.col("event_type"), F.col("ts"), F.col("value"), [F.col("ts"), F.col("event_id")]))


def sma(spark, sf_dir):
    return rounded(indicators.sma(closes(spark, sf_dir)))


def sma_with_gaps(spark, sf_dir):
    return rounded(indicators.sma(gapped(spark, sf_dir)))


def ema_12(spark, sf_dir):
    return rounded(indicators.recursive(closes(spark, sf_dir), ema_periods=(12,)).select("symbol", "date", "ema_12"))


def ema_with_gaps(spark, sf_dir):
    return rounded(indicators.recursive(gapped(spark, sf_dir), ema_periods=(12, 26)).select("symbol", "date", "ema_12", "ema_26"))


def rsi_14(spark, sf_dir):
    return rounded(indicators.recursive(gapped(spark, sf_dir)).select("symbol", "date", "rsi_14"))


def rsi_flat(spark, sf_dir):
    flat = closes(spark, sf_dir).withColumn("close", F.lit(7.5))
    return indicators.recursive(flat).select("symbol", "date", "rsi_14")


def macd(spark, sf_dir):
    return rounded(indicators.recursive(gapped(spark, sf_dir)).select("symbol", "date", "macd_12_26", "macd_signal_9", "macd_hist"))


def scanned_indicators(spark, sf_dir):
    """All orders as one symbol, whose history is dealt out by stretches of 64 days."""
    orders = table(spark, sf_dir, "orders")
    bars = bar_ops.daily_bars(orders, F.lit("ALL"), F.col("o_orderdate"), F.col("o_totalprice"), [F.col("o_orderkey")])
    return rounded(scan.recursive(bars.select("symbol", "date", F.when(~gap(), F.col("close")).alias("close")), days=64), 4)


def indicators_full(spark, sf_dir):
    return rounded(indicators.all_indicators(gapped(spark, sf_dir)))


def indicators_by_sql(spark, sf_dir):
    """All indicators by the table function that SQL calls."""
    table_functions.register(spark)
    return rounded(spark.sql("SELECT * FROM indicators(TABLE({bars}) PARTITION BY symbol ORDER BY date)", bars=gapped(spark, sf_dir)))


def indicator_text(spark, sf_dir):
    stored = text_bars(spark, sf_dir).dropDuplicates(["symbol", "date"])
    return indicators.indicator_rows(stored).select("symbol", "date", "open", "volume", "sma_20", "sma_50", "sma_200")


def indicators_processed(spark, sf_dir):
    asked = order_bars(spark, sf_dir).select("symbol").distinct().unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("symbol")))
    return indicators.processed(asked, order_bars(spark, sf_dir))


def price_delta_gain_loss(spark, sf_dir):
    return rounded(indicators.deltas(gapped(spark, sf_dir)))


def upsert_last_wins(spark, sf_dir):
    writes = lines_as_writes(spark, sf_dir)
    return upsert.last_wins(writes, ["symbol", "date"], ["day", "l_partkey", "l_suppkey", "price"]).select("symbol", "date", "quantity", "price", "day")


def upsert_idempotent(spark, sf_dir):
    writes = lines_as_writes(spark, sf_dir).select("symbol", "date", "quantity", "price", F.col("day").cast("string").alias("stamp"))
    stored = upsert.last_wins(writes.where("stamp < '1999-01-01'"), ["symbol", "date"], ["stamp", "price", "quantity"])
    incoming = writes.where("stamp >= '1997-01-01'").withColumn("date", F.when(F.col("date") == "4", F.lit("")).otherwise(F.col("date")))
    once = upsert.upsert(stored, incoming, ["symbol", "date"], ["stamp", "price", "quantity"])
    return upsert.upsert(once, incoming, ["symbol", "date"], ["stamp", "price", "quantity"])


def duplicate_keys(spark, sf_dir):
    return validate.duplicate_keys(lines_as_writes(spark, sf_dir), ["symbol", "date"])


def invalid_rows(spark, sf_dir):
    return text_bars(spark, sf_dir).where(validate.invalid()).select("symbol", "date", "open", "high", "low", "close", "volume")


def validation_issues(spark, sf_dir):
    return validate.issues(text_bars(spark, sf_dir))


def validation_rollup(spark, sf_dir):
    tables = {"ohlcv": text_bars(spark, sf_dir), "indicators": order_bars(spark, sf_dir), "macro": table(spark, sf_dir, "orders"), "news": table(spark, sf_dir, "documents")}
    report = validate.report(tables)
    return report.select("status", "issue_count", *[F.col("checked_tables")[k].alias(f"rows_{k}") for k in sorted(tables)])


def table_counts(spark, sf_dir):
    names = ("orders", "lineitem", "events", "documents")
    return validate.table_counts({n: table(spark, sf_dir, n) for n in names})


def symbol_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    bars = bar_ops.daily_bars(orders, F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_totalprice"), [F.col("o_orderkey")])
    return bars.orderBy("date").select("date", "open", "high", "low", "close", "volume")


def _payload(rows: DataFrame, key: str, *texts: Column, name: str = "values") -> DataFrame:
    return rows.groupBy(F.col(key).alias("key")).agg(F.to_json(F.struct(F.collect_list(F.struct(*texts)).alias(name))).alias("payload"))


def normalize_ohlcv_list(spark, sf_dir):
    b = order_bars(spark, sf_dir)
    fields = [F.col("date").cast("string").alias("datetime"), *[money(c).alias(c) for c in ("open", "high", "low", "close")], F.col("volume").cast("bigint").alias("volume")]
    # a number where text is usual, an item without a time, and one that isn't an object
    payloads = _payload(b, "symbol", *fields).withColumn("payload", F.replace(F.col("payload"), F.lit('{"values":['), F.lit('{"values":[{"open":"1"},7,')))
    return normalize.bar_list(payloads, ["key"]).drop("pos")


def normalize_ohlcv_map(spark, sf_dir):
    b = order_bars(spark, sf_dir)
    entry = F.struct(*[money(c).alias(n) for c, n in list(normalize.SERIES_FIELDS.items())[:4]], F.col("volume").cast("bigint").cast("string").alias("5. volume"))
    series = F.map_from_entries(F.collect_list(F.struct(F.col("date").cast("string"), entry)))
    payloads = b.groupBy(F.col("symbol").alias("key")).agg(F.to_json(F.create_map(F.lit(normalize.SERIES), series)).alias("payload"))
    return normalize.bar_map(payloads, ["key"]).drop("pos")


def macro_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    total = orders.groupBy("o_orderstatus", F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    value = F.when(F.dayofmonth("day") == 1, F.lit(".")).when(F.dayofmonth("day") == 2, F.lit("")).otherwise(F.col("n").cast("string"))
    return total.select(F.col("o_orderstatus").alias("symbol"), F.col("day").cast("string").alias("date"), value.alias("value"))


def normalize_macro(spark, sf_dir):
    values = macro_values(spark, sf_dir)
    payloads = _payload(values, "symbol", F.col("date"), F.col("value"), F.lit(None).cast("string").alias("realtime_start"), F.lit("x").alias("realtime_end"), name="observations")
    return normalize.macro(payloads, ["key"]).drop("pos")


#: Bytes of text in a payload of news, about.
NEWS_BYTES = 4 << 20


def news_payloads(docs: DataFrame) -> DataFrame:
    """Payloads of each source's news, as many as keep one to about NEWS_BYTES of text."""
    sizes = docs.groupBy("source").agg(F.ceil(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 100) / NEWS_BYTES).alias("chunks"))
    sizes = sizes.select(F.col("source").alias("__source"), "chunks")
    item = F.struct(
        F.col("doc_id").alias("id"), (F.lit(1_700_000_000) + F.col("doc_id") * 3600).alias("datetime"), F.col("text").alias("headline"),
        F.col("lang").alias("category"), (F.col("doc_id") % 2 == 0).alias("image"),
    )
    dealt = docs.join(sizes, F.col("source").eqNullSafe(F.col("__source")))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), "chunks")
    return dealt.groupBy(F.col("source").alias("key"), chunk.alias("chunk")).agg(F.to_json(F.collect_list(item)).alias("payload")).drop("chunk")


def normalize_news(spark, sf_dir):
    return normalize.news(news_payloads(table(spark, sf_dir, "documents")), ["key"]).drop("pos")


#: Payloads that say something instead of rows.
ODD_PAYLOADS = [
    ("bar_list", "a", '{"status":"error","message":"rate limit reached"}'), ("bar_list", "b", '{"status":"error"}'), ("bar_list", "c", '{"values":null,"message":""}'),
    ("bar_list", "d", '{"values":[],"status":"error","message":"x"}'), ("bar_map", "a", '{"Note":"slow down","Error Message":"bad"}'),
    ("bar_map", "b", '{"Information":"plan","Error Message":"bad"}'), ("bar_map", "c", '{"Error Message":"bad"}'), ("bar_map", "d", "{}"), ("bar_map", "e", '{"Note":null,"Time Series (Daily)":{}}'),
    ("macro", "a", '{"error_message":"Bad Request","message":"m"}'), ("macro", "b", '{"message":"m"}'), ("macro", "c", '{"observations":7}'),
    ("news", "a", '{"error":"no access"}'), ("news", "b", "{}"), ("news", "c", "[]"), ("news", "d", '"text"'),
    ("listing", "a", '{"status":"error","code":401}'), ("listing", "b", '{"status":"ok"}'), ("listing", "c", '{"data":[]}'),
]


def normalize_errors(spark, sf_dir):
    """Each document as a payload that says something instead of rows, some of them with the document's language in it."""
    odd = spark.createDataFrame([(n, *row) for n, row in enumerate(ODD_PAYLOADS)], "n int, kind string, form string, said string")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(len(ODD_PAYLOADS))).cast("int").alias("n"), F.coalesce("lang", F.lit("none")).alias("lang"))
    payloads = docs.join(F.broadcast(odd), "n").select("doc_id", "kind", "form", F.replace("said", F.lit('"bad"'), F.concat(F.lit('"bad '), "lang", F.lit('"'))).alias("payload"))
    out = None
    for kind in normalize.ERRORS:
        one = normalize.payload_errors(payloads.where(F.col("kind") == kind), kind, ["doc_id", "kind", "form"])
        out = one if out is None else out.unionByName(one)
    return out


def listing_symbols(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(F.concat(F.lit("  "), F.lower("p_brand"), F.lit(" ")).alias("symbol"), (F.col("p_partkey") % 64).alias("page"))
    payloads = _payload(items, "page", F.col("symbol"), name="data")
    return normalize.listing(payloads)


def merge_symbols(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), F.concat(F.lower("c_mktsegment"), F.lit("  ")).alias("symbol"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 5 == 0, F.lit("building")).otherwise(F.col("p_brand")).alias("symbol"))
    return listing.merge_symbols(customer, part)


def latest_status(spark, sf_dir):
    return planner.latest_status(log(spark, sf_dir)).select(
        "provider", "symbol", "status", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), "rows", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at")
    )


def pending_symbols(spark, sf_dir):
    return planner.pending(symbol_list(spark, sf_dir), planner.latest_status(log(spark, sf_dir)), "primary", TODAY, 700)


def done_today(spark, sf_dir):
    return planner.done_today(symbol_list(spark, sf_dir), planner.latest_status(log(spark, sf_dir)), "primary", TODAY, 100)


def not_done_today(spark, sf_dir):
    return planner.not_done_today(symbol_list(spark, sf_dir), planner.latest_status(log(spark, sf_dir)), "primary", TODAY).select("symbol")


def api_keys(spark: SparkSession) -> DataFrame:
    rows = [("primary", 0, True, 800, 700, True), ("primary", 1, True, 800, 100, True), ("primary", 2, False, 800, 100, True), ("backup", 0, True, 25, 5, True), ("off", 0, True, 25, 5, False)]
    return spark.createDataFrame(rows, "provider string, key_index int, has_key boolean, daily_limit bigint, daily_reserve bigint, enabled boolean")


def budget_remaining(spark, sf_dir):
    return planner.key_slots(api_keys(spark), planner.usage(log(spark, sf_dir)), TODAY)


def call_decisions(spark, sf_dir):
    return planner.decide(budget_remaining(spark, sf_dir), 50).select("provider", "key_index", "reason", "allowed_cost")


def active_key(spark, sf_dir):
    return planner.active_key(budget_remaining(spark, sf_dir))


def provider_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the lists of three providers: all of them, every third and every tenth."""
    symbols = symbol_list(spark, sf_dir)
    names = F.array_compact(F.array(F.lit("primary"), F.when(F.col("line") % 3 == 0, F.lit("backup")), F.when(F.col("line") % 10 == 0, F.lit("off"))))
    return symbols.select(F.explode(names).alias("provider"), "line", "symbol")


def allocated_calls(spark, sf_dir):
    """What all providers are to be asked for in one run, and with which key."""
    calls = log(spark, sf_dir).withColumn("provider", F.when(F.col("seq") % 4 == 0, F.lit("backup")).otherwise(F.col("provider")))
    limits = spark.createDataFrame([("primary", 450), ("backup", 700), ("off", 700)], "provider string, max_symbols bigint")
    candidates = planner.waiting(provider_lists(spark, sf_dir), planner.latest_status(calls), TODAY)
    return planner.allocate(candidates, planner.key_slots(api_keys(spark), planner.usage(calls), TODAY), limits)


def news_days(spark, sf_dir):
    """Orders as requests for news, some without a last day, some without a first, and some that can't be asked."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    to_date = F.when(key % 4 == 0, F.lit("")).when(key % 4 != 1, day.cast("string"))
    from_date = F.when(key % 7 == 0, F.lit("soon")).when(key % 3 != 0, F.date_sub(day, (key % 20 - 1).cast("int")).cast("string"))
    requests = table(spark, sf_dir, "orders").select("o_orderkey", from_date.alias("from_date"), to_date.alias("to_date"), F.when(key % 5 != 0, (key % 30).cast("int")).alias("days_back"))
    return planner.news_days(requests, TODAY)


def calls_in_last_minute(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("key"), F.col("ts").cast("timestamp").alias("at"))
    return planner.calls_in_window(events, "key", "at", 60).select("event_id", "key", F.col("calls_before").alias("calls"))


def run_counters(spark, sf_dir):
    events = log(spark, sf_dir).withColumn("run", F.to_date("at"))
    return planner.run_counts(events, "run")


def last_20_runs(spark, sf_dir):
    return planner.last_runs(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")), ["day", "o_orderkey"])


def daily_summary(spark, sf_dir):
    tables = {"ohlcv": order_bars(spark, sf_dir), "indicators": order_bars(spark, sf_dir), "macro": macro_values(spark, sf_dir), "news": table(spark, sf_dir, "documents")}
    runs = table(spark, sf_dir, "orders").select("o_orderkey")
    made = summary.daily(tables, table(spark, sf_dir, "pages"), runs, ["o_orderkey"], TODAY)
    return made.select("date", "raw_count", *sorted(tables), "run_count", F.col("last_run.o_orderkey").alias("last_run"), )


def summary_message(spark, sf_dir):
    tables = {"ohlcv": order_bars(spark, sf_dir), "indicators": order_bars(spark, sf_dir), "macro": macro_values(spark, sf_dir), "news": table(spark, sf_dir, "documents")}
    runs = table(spark, sf_dir, "orders").select("o_orderkey")
    return summary.message(summary.daily(tables, table(spark, sf_dir, "pages"), runs, ["o_orderkey"], TODAY))


def format6(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    value = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.lit(7.0)
    value = F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double")).otherwise(value)
    return lines.select("l_orderkey", "l_partkey", casts.number_text(value).alias("text"))


def try_double(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    # as SQL casts: to the nearest whole number, halves to the even one
    q = F.rint("l_quantity").cast("bigint").cast("string")
    forms = [q, F.concat(F.lit(" "), q, F.lit(" ")), F.when(q.startswith("-"), q).otherwise(F.concat(F.lit("+"), q)), F.concat(q, F.lit("e2")), F.concat(q, F.lit("d")), F.concat(F.lit("0x"), q), F.concat(q, F.lit(",5")), F.lit("nan"), F.lit("inf"), F.concat(F.lit("--"), q)]
    # a remainder below 0 has no form, "nan" and "inf" are there without a quantity, and a plus before a minus is passed over
    text = F.coalesce(*[F.when(F.col("l_partkey") % 11 == k, form) for k, form in enumerate(forms)])
    out = casts.try_double(text)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(~F.isnan(out), out).alias("value"), F.coalesce(F.isnan(out), F.lit(False)).alias("not_a_number"))


def raw_archive_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", r"^(\w+):", 1).alias("provider")).agg(F.count(F.lit(1)).alias("files"))


QUERIES = {
    f.__name__: f
    for f in (
        ohlcv_bars, event_bars, sma, sma_with_gaps, ema_12, ema_with_gaps, rsi_14, rsi_flat, macd, scanned_indicators, indicators_full, indicators_by_sql, indicator_text, indicators_processed,
        price_delta_gain_loss, upsert_last_wins, upsert_idempotent, duplicate_keys, invalid_rows, validation_issues, validation_rollup, table_counts,
        symbol_history, normalize_ohlcv_list, normalize_ohlcv_map, normalize_macro, normalize_news, normalize_errors, listing_symbols, merge_symbols,
        latest_status, pending_symbols, done_today, not_done_today, budget_remaining, call_decisions, active_key, allocated_calls, news_days, calls_in_last_minute, run_counters, last_20_runs,
        daily_summary, summary_message, format6, try_double, raw_archive_counts,
    )
}
