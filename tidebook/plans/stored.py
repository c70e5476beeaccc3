"""Queries through sources, stored tables and streams: each writes to a folder of its own in the shared one and reads back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import casts, schemas
from tidebook.operators import normalize, planner, summary, validate
from tidebook.plans import collect, queries, refresh
from tidebook.plans.queries import TODAY, table
from tidebook.sources import config, payload_files, scratch
from tidebook.sources.store import Store, dataset_files, files
from tidebook.streaming import collecting, ingest, live, progress

BUCKETS = 8
NOW = f"{TODAY} 22:30:00"
STAMPS = ("2024-01-19T00:00:00Z", "2024-01-20T00:00:00Z")


def new_store(spark: SparkSession) -> Store:
    return Store(spark, scratch.new_path(spark, "store"), BUCKETS)


def bars_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = queries.order_bars(spark, sf_dir)
    return b.select("symbol", F.col("date").cast("string").alias("date"), *[queries.money(c).alias(c) for c in ("open", "high", "low", "close")], F.col("volume").cast("bigint").cast("string").alias("volume"))


def two_batches(spark: SparkSession, sf_dir: str) -> Store:
    """Bars up to 1998, then those from 1997 on with another volume, some of them twice and some without a date."""
    store, bars = new_store(spark), bars_as_text(spark, sf_dir)
    store.upsert("ohlcv", bars.where("date < '1998'"), STAMPS[0], ["date"])
    later = bars.where("date >= '1997'").withColumn("volume", F.concat("volume", F.lit("0")))
    later = later.select("*", F.lit(2).alias("place")).unionByName(later.select("*", F.lit(1).alias("place")).withColumn("close", F.lit("first")))
    nameless = later.limit(5).withColumn("date", F.lit(""))
    store.upsert("ohlcv", later.unionByName(nameless), STAMPS[1], ["place"])
    return store


def stored_bars(spark, sf_dir):
    return two_batches(spark, sf_dir).table("ohlcv")


def stored_history(spark, sf_dir):
    return two_batches(spark, sf_dir).history("3-MEDIUM")


def stored_indicators(spark, sf_dir):
    store = new_store(spark)
    store.upsert("ohlcv", bars_as_text(spark, sf_dir), STAMPS[0], ["date"])
    collect.refresh_indicators(store, STAMPS[0])
    some = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "symbol string")
    collect.refresh_indicators(store, STAMPS[1], some)
    return store.table("indicators")


def gapped_bars_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as text, with a day without a close in every other year."""
    missing = queries.gap() & (F.year("date") % 2 == 0)
    return bars_as_text(spark, sf_dir).withColumn("close", F.when(missing, F.lit("")).otherwise(F.col("close")))


def incremental_indicators(spark, sf_dir):
    """Indicators of the bars before June 1998, and then of two batches of later days, each computed on from the stored states."""
    store, bars = new_store(spark), gapped_bars_as_text(spark, sf_dir)
    for first, end in (("", "1998-06-01"), ("1998-06-01", "1998-06-20"), ("1998-06-20", "9999")):
        refresh.upsert_bars(store, bars.where((F.col("date") >= first) & (F.col("date") < end)), STAMPS[0], ["date"])
        refresh.refresh(store, STAMPS[0])
    return store.table("indicators").drop("updated_at")


def corrected_indicators(spark, sf_dir):
    """Indicators after corrections: closes of some days that were wrong, a day that came late, and a gap that is filled; what they made dirty is computed again."""
    store, bars = new_store(spark), gapped_bars_as_text(spark, sf_dir)
    wrong = F.col("date").isin("1994-03-01", "1994-03-02", "1997-01-15") & (F.col("symbol") == "1-URGENT")
    late = (F.col("date") == "1995-09-01") & (F.col("symbol") == "2-HIGH")
    filled = (F.col("date") == "1996-02-01") & (F.col("symbol") == "5-LOW")
    begun = bars.where(~late).withColumn("close", F.when(wrong, F.lit("1.5")).when(filled, F.lit("n/a")).otherwise(F.col("close")))
    refresh.upsert_bars(store, begun, STAMPS[0], ["date"])
    refresh.refresh(store, STAMPS[0])
    refresh.upsert_bars(store, bars.where(wrong | late | filled), STAMPS[1], ["date"])
    refresh.refresh(store, STAMPS[1])
    return store.table("indicators").drop("updated_at")


def live_stream_indicators(spark, sf_dir):
    """Bars as a stream: years in turn, one bar corrected and one that comes late, with a restart before those."""
    store, bars, inbox, checkpoint = new_store(spark), gapped_bars_as_text(spark, sf_dir), scratch.new_path(spark, "inbox"), scratch.new_path(spark, "stream")
    late = (F.col("symbol") == "2-HIGH") & F.col("date").isin("1994-05-05", "1997-05-05")
    wrong = bars.withColumn("close", F.when(late, F.lit("1.5")).otherwise(F.col("close"))).where("not (symbol = '2-HIGH' and date = '1997-05-05')")
    for rows in ((wrong.where("date < '1996'"), wrong.where("date >= '1996'")), (bars.where(late),)):
        for some in rows:
            some.withColumn("seq", F.lit(1)).coalesce(1).write.mode("append").json(inbox)
        source = spark.readStream.schema(live.BARS).option("maxFilesPerTrigger", 1).json(inbox)
        live.keep_indicators(source, store, checkpoint, STAMPS[0]).awaitTermination()
    return store.table("indicators").drop("updated_at")


def checked_store(spark: SparkSession, sf_dir: str) -> Store:
    """Bars of which some are broken, twice in their batch or without a date, put into a store by batches that are checked while they are written."""
    store, bars = new_store(spark), queries.text_bars(spark, sf_dir)
    nameless = bars.where("substring(date, 6) = '02-02'").withColumn("date", F.lit(""))
    for stamp, rows in ((STAMPS[0], bars.where("date < '1997'")), (STAMPS[1], bars.where("date >= '1996'").unionByName(nameless))):
        store.upsert_checked("ohlcv", rows, stamp, ["date"], validate.fault())
    return store


def checked_counts(spark, sf_dir):
    """What was counted while two batches were written."""
    return checked_store(spark, sf_dir).checks()


def checked_bars(spark, sf_dir):
    """The bars without a fault, after a merge."""
    store = checked_store(spark, sf_dir)
    store.merge("ohlcv")
    return store.table("ohlcv")


def quarantined_bars(spark, sf_dir):
    """The faulty ones, which stay where they are when batches are merged."""
    store = checked_store(spark, sf_dir)
    store.merge("ohlcv")
    return store.quarantine("ohlcv").drop("updated_at")


def written_report(spark, sf_dir):
    store = two_batches(spark, sf_dir)
    collect.report(store)
    found = spark.read.json(f"{store.root}/documents/validation/latest")
    return found.select("status", "issue_count", *[F.col("checked_tables")[name].alias(f"rows_{name}") for name in sorted(schemas.TABLES)])


def written_summary(spark, sf_dir):
    store = two_batches(spark, sf_dir)
    collect.daily_summary(store, TODAY)
    return spark.read.json(f"{store.root}/documents/daily/{TODAY}").select("date", "raw_count", "ohlcv", "news", "run_count")


def recorded_statuses(spark, sf_dir):
    """The fetch log, recorded in two parts, and the latest statuses it leads to."""
    store, log = new_store(spark), queries.log(spark, sf_dir)
    store.record(log.where("seq % 2 = 0"))
    store.record(log.where("seq % 2 = 1"))
    return planner.latest_status(store.log()).select("provider", "symbol", "status", "rows", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at"))


def archived_payloads(spark, sf_dir):
    """Pages archived as the payloads of two runs."""
    store, pages = new_store(spark), table(spark, sf_dir, "pages")
    for seq in (1, 2):
        rows = pages.where(F.col("page_id") % 2 == seq - 1)
        store.archive(rows.select(F.regexp_extract("url", r"^(\w+):", 1).alias("provider"), F.col("url").alias("key"), F.lit(NOW).cast("timestamp").alias("fetched_at"), F.col("html").alias("payload"), F.lit(seq).cast("bigint").alias("seq")))
    return store.bronze().groupBy("provider", "seq").agg(F.count(F.lit(1)).alias("payloads"), F.sum(F.octet_length("payload")).alias("bytes"))


def archived_files(spark, sf_dir):
    """Names of nations in a file for each region, and what a listing of the files says."""
    path = scratch.new_path(spark, "files")
    nations = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), "n_name")
    nations.repartition(1, "region").write.partitionBy("region").text(path)
    region = F.regexp_extract("path", r"region=(\d+)", 1).cast("bigint").alias("region")
    return files(spark, path, "*.txt").groupBy(region).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def streamed_bars(spark, sf_dir):
    """Files of payloads, a symbol's month each and of some months two versions, upserted as a stream."""
    store, inbox = new_store(spark), scratch.new_path(spark, "inbox")
    fields = [F.col("date").alias("datetime"), "open", "high", "low", "close", "volume"]
    months = bars_as_text(spark, sf_dir).groupBy(F.col("symbol").alias("key"), F.substring("date", 1, 7).alias("month")).agg(F.collect_list(F.struct(*fields)).alias("values"))
    first = months.select("key", F.to_json(F.struct("values")).alias("payload"), F.lit(1).cast("bigint").alias("seq"), "month")
    again = months.where("substring(month, 6, 2) = '03'").select("key", F.to_json(F.struct(F.transform("values", lambda v: v.withField("volume", F.lit("again"))).alias("values"))).alias("payload"), F.lit(2).cast("bigint").alias("seq"), "month")
    first.unionByName(again).drop("month").repartition(3, "key").write.json(inbox)
    ingest.stream_payloads(spark, inbox, store, "bar_list", scratch.new_path(spark, "stream"), files_per_batch=2, clock=lambda: STAMPS[0]).awaitTermination()
    return store.table("ohlcv").drop("updated_at")


def stream_progress(spark, sf_dir):
    """Bars in files, streamed in two runs, and what a listener kept of them."""
    store, inbox, checkpoint = new_store(spark), scratch.new_path(spark, "inbox"), scratch.new_path(spark, "stream")
    values = F.to_json(F.struct(F.array(F.struct(F.col("date").alias("datetime"), "open", "high", "low", "close", "volume")).alias("values")))
    payloads = bars_as_text(spark, sf_dir).select(F.col("symbol").alias("key"), values.alias("payload"), F.lit(1).cast("bigint").alias("seq"), F.substring("date", 1, 4).alias("year"))
    heard = progress.listen(spark, store)
    try:
        for years in ("year < '1995'", "year >= '1995'"):
            payloads.where(years).drop("year").write.mode("append").json(inbox)
            stream = ingest.stream_payloads(spark, inbox, store, "bar_list", checkpoint, clock=lambda: STAMPS[0])
            stream.awaitTermination()
            heard.wait(str(stream.runId))
    finally:
        spark.streams.removeListener(heard)
    return progress.current(store).select("runs", "status", "rows")


def replayed_stream(spark, sf_dir):
    """Payloads of each symbol, written as files by name, asked for as a stream that stops in the middle of the list and is started again."""
    store, folder, spool, checkpoint = new_store(spark), scratch.new_path(spark, "payloads"), scratch.new_path(spark, "spool"), scratch.new_path(spark, "stream")
    fields = [F.col("date").alias("datetime"), "open", "high", "low", "close", "volume"]
    payloads = bars_as_text(spark, sf_dir).groupBy("symbol").agg(F.to_json(F.struct(F.collect_list(F.struct(*fields)).alias("values"))).alias("payload"))
    payload_files.register(spark)
    payloads.select(F.concat("symbol", F.lit(".json")).alias("name"), "payload").write.format("payload_files").option("folder", folder).mode("append").save()
    symbols = [r.symbol for r in payloads.select("symbol").orderBy("symbol").collect()]  # the kinds of priority, which are a list of symbols
    options = {"transport": "replay", "folder": folder, "symbolsPerBatch": "2"}
    for some in (symbols[:2], symbols):
        collecting.drain(collecting.collect_stream(spark, store, "primary", "bar_list", some, spool, checkpoint, NOW, options))
    log = store.log().select("symbol", "status", F.col("rows").alias("payload_rows"), F.col("seq").alias("batch"))
    return store.table("ohlcv").join(F.broadcast(log), "symbol").drop("updated_at")


def fake(kind: str, symbol: str, options: dict[str, str]) -> str:
    """A provider that knows symbols by number: of ten one fails, one says that it is unknown, and one has no bars."""
    last = int(symbol) % 10
    if last == 3:
        raise OSError("no route")
    if last == 5:
        return '{"status":"error","message":"unknown symbol"}'
    return json.dumps({"values": [] if last == 7 else [{"datetime": f"2024-01-{d:02d}", "close": symbol} for d in range(1, last + 2)]})


def collect_once(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    settings = config.Provider("primary", enabled=True, api_key_envs=("A", "B"), daily_limit=30, daily_reserve=10, max_symbols_per_run=60)
    run = collect.Run(settings, "bar_list", TODAY, NOW, {"transport": "fake", "backoff": "0", "symbolsPerTask": "10"}, keys_set=(True, True), transports={"fake": fake}, symbols_at_once=20)
    store = new_store(spark)
    return store, collect.collect(spark, store, queries.symbol_list(spark, sf_dir), run)


def collected_run(spark, sf_dir):
    return collect_once(spark, sf_dir)[1].withColumn("error", F.regexp_replace("error", r"^.*no route$", "no route"))


def collected_bars(spark, sf_dir):
    return collect_once(spark, sf_dir)[0].table("ohlcv").select("symbol", "date", "close", "updated_at")


def recorded_runs(spark, sf_dir):
    return collect_once(spark, sf_dir)[0].runs().select("seq", "provider", "kind", "status", "force", "processed", "failed", "skipped_rate_limit", "total_remaining_start")


def configured_symbols(spark, sf_dir):
    """Names of parts as a list of symbols, written and read again, with the lines that count for nothing left out."""
    path = scratch.new_path(spark, "symbols")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 7 == 0, F.lit("# left out")).when(F.col("p_partkey") % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_brand")).alias("symbol"))
    config.write_lines(parts, path, ["line"])
    return config.lines(spark, path)


def configured_keys(spark, sf_dir):
    """Nations as providers in a file of settings, and the keys that it names."""
    path, n = scratch.new_path(spark, "settings"), F.col("n_nationkey")
    envs = F.when(n % 2 == 0, F.concat(F.lit("api_key_envs: KEY_A, KEY_"), n, F.lit(",KEY_A"))).otherwise(F.concat(F.lit("api_key_env: KEY_"), n))
    section = [F.lit("# a provider"), F.concat("n_name", F.lit(":")), F.concat(F.lit("enabled: "), n % 3 == 0), envs, F.concat(F.lit("daily_limit: "), n * 10), F.lit("daily_reserve: 30")]
    lines = F.concat_ws("\n", *[c if k < 2 else F.concat(F.lit("  "), c) for k, c in enumerate(section)])
    table(spark, sf_dir, "nation").select(lines.alias("value")).coalesce(1).write.text(path)
    said = "\n".join(r.value for r in spark.read.text(path).collect())  # a file of settings
    return config.keys(spark, [config.provider(said, name) for name in config.parse_providers(said)], {f"KEY_{k}": "secret" for k in range(0, 25, 4)})


def news_archive(spark, sf_dir):
    """Each conversation as a symbol's news, archived with the days that were asked for."""
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("key")).agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("id"), F.col("role").alias("headline"))))).alias("payload"))
    store, (first, last) = new_store(spark), ("2024-01-13", TODAY)
    store.archive(turns.select(F.lit("news").alias("provider"), "key", F.lit(NOW).cast("timestamp").alias("fetched_at"), "payload", F.lit(first).alias("asked_from"), F.lit(last).alias("asked_to"), F.lit(1).cast("bigint").alias("seq")))
    kept = F.from_json("envelope", "symbol string, from string, to string, items array<struct<id: bigint, headline: string>>")
    return normalize.news_envelopes(store.bronze()).select(kept.alias("x")).select("x.symbol", "x.from", "x.to", F.size("x.items").alias("items"), F.element_at("x.items", 1)["headline"].alias("first"))


def dry_run_statuses(spark, sf_dir):
    """A dry run of symbols of which some are known: recorded, but nothing fetched."""
    store, symbols = new_store(spark), queries.symbol_list(spark, sf_dir)
    store.record(queries.log(spark, sf_dir).where(F.to_date("at") < TODAY))
    run = collect.Run(config.Provider("primary", enabled=True, daily_limit=1), "bar_list", TODAY, NOW, max_symbols=20, dry_run=True)
    done = collect.collect(spark, store, symbols, run)
    return done.select("symbol", "status", "rows", F.lit(store.bronze().count()).alias("payloads"))


def current_run(spark, sf_dir):
    """Days of the log as runs of which all but the last have ended."""
    log = queries.log(spark, sf_dir).withColumn("seq", F.datediff(F.to_date("at"), F.lit("2024-01-01").cast("date")).cast("bigint") + 1)
    runs = log.groupBy("seq").agg(F.count(F.lit(1)).alias("n")).where("seq < 30")
    return planner.current_run(log, runs).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def kept_files(spark, sf_dir):
    """Bars and news as files of comma-separated values, and how many there are of each data set."""
    root = scratch.new_path(spark, "legacy")
    table(spark, sf_dir, "nation").select("n_regionkey", "n_name").repartition(1, "n_regionkey").write.partitionBy("n_regionkey").csv(f"{root}/ohlcv")
    table(spark, sf_dir, "region").coalesce(1).write.csv(f"{root}/news")
    return dataset_files(spark, root)


def first_series(spark, sf_dir):
    return planner.first_lines(queries.symbol_list(spark, sf_dir), 25)


def stored_news(spark, sf_dir):
    """The news of one source from some days, out of all that were upserted."""
    store = new_store(spark)
    payloads = queries.news_payloads(table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang"))
    rows = normalize.news(payloads, ["key"]).withColumnRenamed("key", "symbol")
    store.upsert("news", rows, STAMPS[0], ["datetime", "url", "pos"])
    source = table(spark, sf_dir, "documents").agg(F.min("source")).first()[0]
    return store.news(source, "2023-11-15", "2023-12-31").drop("updated_at")


def archive_names(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", casts.archive_name(F.replace("c_name", F.lit("#"), F.lit("/")), F.lit(STAMPS[1])).alias("name"))


def progress_text(spark, sf_dir):
    return summary.progress_message(queries.done_today(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        stored_bars, stored_history, stored_indicators, incremental_indicators, corrected_indicators, live_stream_indicators, checked_counts, checked_bars, quarantined_bars, written_report, written_summary, recorded_statuses, archived_payloads, archived_files, streamed_bars, stream_progress, replayed_stream, collected_run, collected_bars,
        recorded_runs, configured_symbols, configured_keys, news_archive, archive_names, progress_text,
        dry_run_statuses, current_run, kept_files, first_series, stored_news,
    )
}
