"""A day's work: collect payloads, keep them, normalize and upsert them, and derive the rest."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.functions import schemas
from tidebook.operators import indicators, listing, normalize, planner, summary, validate
from tidebook.sources import config, rest
from tidebook.sources.config import Provider
from tidebook.sources.store import Store
from tidebook.streaming.ingest import TARGETS, upsert_batch

#: Symbols whose payloads, rows and statuses are written together: what a run that breaks off has to do again.
SYMBOLS_AT_ONCE = 50
#: A run without any call left for it, and one that went through.
EXHAUSTED, FINISHED = "all_keys_exhausted", "finished"


def utc_now() -> str:
    return time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())


@dataclass(frozen=True)
class Run:
    """What decides a run beside the stored tables. ``now`` is given, so that a run can be repeated; ``clock`` says when it ended."""

    provider: Provider
    kind: str
    today: str
    now: str
    options: dict[str, str] = field(default_factory=dict)
    keys_set: tuple[bool, ...] = (True,)
    max_symbols: int | None = None
    force: bool = False
    dry_run: bool = False
    transports: dict[str, rest.Transport] = field(default_factory=dict)
    symbols_at_once: int = SYMBOLS_AT_ONCE
    clock: Callable[[], str] = utc_now


def budget(spark: SparkSession, store: Store, run: Run) -> DataFrame:
    p = run.provider
    rows = [(p.name, k, has, p.daily_limit, p.daily_reserve, p.enabled) for k, has in enumerate(run.keys_set)]
    keys = spark.createDataFrame(rows, "provider string, key_index int, has_key boolean, daily_limit bigint, daily_reserve bigint, enabled boolean")
    return planner.key_slots(keys, planner.usage(store.log()), run.today)


def plan(spark: SparkSession, store: Store, symbols: DataFrame, run: Run) -> DataFrame:
    """symbol, line, priority, key_index (null: no call left) of the symbols that this run is to collect.

    Keys are used up one after the other. The first symbol for which no call is left is
    in the plan as well, to be recorded as skipped; those behind it are not. A dry run needs no calls, and has no keys.
    """
    limit = run.provider.max_symbols_per_run if run.max_symbols is None else run.max_symbols
    statuses = planner.latest_status(store.log())
    if run.dry_run:
        return planner.pending(symbols, statuses, run.provider.name, run.today, limit, run.force).withColumn("key_index", F.lit(None).cast("int"))
    candidates = planner.waiting(symbols.withColumn("provider", F.lit(run.provider.name)), statuses, run.today, run.force)
    limits = spark.createDataFrame([(run.provider.name, limit)], "provider string, max_symbols bigint")
    return planner.allocate(candidates, budget(spark, store, run), limits).select("symbol", "line", "priority", "key_index")


def days(spark: SparkSession, run: Run) -> tuple[str | None, str | None]:
    """The first and last day to ask for; only news are asked for by day."""
    if run.kind != "news":
        return None, None
    asked = spark.createDataFrame([(run.options.get("from"), run.options.get("to"), None)], "from_date string, to_date string, days_back int")
    made = planner.news_days(asked, run.today).first()
    if not made.in_order:
        raise ValueError(f"no days to ask news for: {made.from_date!r} to {made.to_date!r}")
    return made["first"], made["last"]


def recent_calls(store: Store, run: Run) -> list[float]:
    """Times of the provider's calls that still count towards its rate, of this run and those before: as many as the rate allows, and no more.

    They are in the archive, so batches of a run, and a run after one that broke off, go on in one row of calls.
    """
    limit = run.provider.per_minute_limit
    if limit <= 0:
        return []
    since = time.time() - float(run.options.get("windowSeconds", rest.MINUTE))
    at = store.bronze().where(F.col("provider") == run.provider.name).select(F.explode(F.from_json("calls", "array<double>")).alias("at"))
    return [r["at"] for r in at.where(F.col("at") > since).orderBy(F.desc("at")).limit(limit).collect()]


def payloads(spark: SparkSession, run: Run, symbols: list[str], key_index: int | None = None, called_at: list[float] | None = None) -> DataFrame:
    """provider, key, payload, error, earlier, calls of these symbols, by the run's transport and within its provider's rate."""
    p, (first, last) = run.provider, days(spark, run)
    envs = p.key_envs()
    options = {
        "provider": p.name, "kind": run.kind, "symbols": json.dumps(symbols), "perMinute": p.per_minute_limit, "base": p.base_url, "interval": p.interval, "outputsize": p.outputsize,
        "keyEnv": envs[key_index] if key_index is not None and key_index < len(envs) else p.api_key_env,
        "calledAt": json.dumps(called_at or []),
    } | ({"from": first, "to": last} if first else {}) | run.options
    rest.register(spark, **run.transports)
    return spark.read.format("rest_payloads").options(**options).load()


def collect(spark: SparkSession, store: Store, symbols: DataFrame, run: Run) -> DataFrame:
    """Collect the plan's symbols and return their results: symbol, status, rows, error.

    Payloads are archived before anything is made of them, so that bad ones are kept too. A symbol that fails
    is a row of its own and holds up no other. Symbols are taken ``symbols_at_once`` at a time,
    and what became of them is recorded before the next ones: a run that breaks off loses those at most, and the next
    one goes on from there, under a number that nothing archived or recorded has. A symbol that is listed twice is asked for once. The run
    itself is recorded at its end. A dry run records its symbols as such and does nothing else.
    """
    planned = plan(spark, store, symbols, run).orderBy("priority", "line").collect()  # a run's symbols, limited by its budget
    slots = budget(spark, store, run).agg(F.sum(F.when(F.col("has_key"), F.col("remaining")).otherwise(0)).alias("n"), F.max("allowed").alias("any")).first()
    seq = max(t.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] for t in (store.log(), store.runs(), store.bronze())) + 1
    left = list({r.symbol: r for r in reversed(planned)}.values())[::-1]
    while left:
        key = left[0].key_index
        some = [r for r in left[: run.symbols_at_once] if r.key_index == key]
        left = left[len(some) :]
        if key is None:
            rows = [(r.symbol, "dry_run", 0, None) if run.dry_run else (r.symbol, "skipped_rate_limit", 0, EXHAUSTED) for r in some]
            results = spark.createDataFrame(rows, "symbol string, status string, rows bigint, error string")
        else:
            results = _collect_some(spark, store, run, seq, [r.symbol for r in some], key)
        store.record(results.select(
            F.lit(run.provider.name).alias("provider"), F.lit(key).cast("int").alias("key_index"), "symbol", "status", "rows", "error",
            F.lit(run.now).cast("timestamp").alias("at"), F.lit(seq).cast("bigint").alias("seq"),
        ))
    if run.kind in TARGETS:
        store.merge(TARGETS[run.kind][0])
    mine = store.log().where(F.col("seq") == seq)
    count = lambda *s: F.count_if(F.col("status").isin(*s))
    store.record_run(mine.agg(count("done", "dry_run").alias("processed"), count("failed").alias("failed"), count("skipped_rate_limit").alias("skipped_rate_limit")).select(
        F.lit(seq).cast("bigint").alias("seq"), F.lit(run.provider.name).alias("provider"), F.lit(run.kind).alias("kind"), F.lit(FINISHED if slots["any"] or run.dry_run else EXHAUSTED).alias("status"),
        F.lit(run.dry_run).alias("dry_run"), F.lit(run.force).alias("force"), F.lit(run.now).alias("started_at"), F.lit(run.clock()).alias("finished_at"), "processed", "failed", "skipped_rate_limit",
        F.lit(slots["n"]).cast("bigint").alias("total_remaining_start"),
    ))
    return mine.select("symbol", "status", "rows", "error")


def _collect_some(spark: SparkSession, store: Store, run: Run, seq: int, symbols: list[str], key_index: int) -> DataFrame:
    """Fetch, archive, normalize and upsert; symbol, status, rows, error of each."""
    first, last = days(spark, run)
    fetched = payloads(spark, run, symbols, key_index, recent_calls(store, run))
    store.archive(fetched.select(
        "provider", "key", F.lit(run.now).cast("timestamp").alias("fetched_at"), "payload", F.lit(first).cast("string").alias("asked_from"), F.lit(last).cast("string").alias("asked_to"),
        "error", "earlier", "calls", F.lit(seq).cast("bigint").alias("seq"),
    ))
    # the folder of this run alone is read
    kept = store.bronze().where((F.col("provider") == run.provider.name) & (F.col("seq") == seq) & F.col("key").isin(symbols))
    if run.kind in TARGETS:
        upsert_batch(store, run.kind, kept, run.now)
    asked = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    results = normalize.collect_results(kept, run.kind, ["key"]).join(kept.select("key", F.col("error").alias("fetch_error")), "key")
    found = asked.join(F.broadcast(results.withColumnRenamed("key", "symbol")), "symbol", "left")
    return found.select("symbol", F.coalesce("status", F.lit("failed")).alias("status"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.coalesce("fetch_error", "error").alias("error"))


def listed_symbols(spark: SparkSession, store: Store, exchanges: list[str], run: Run, existing: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """Collect the listings of exchanges: their symbols in order, or those of ``existing`` (line, symbol) with the new ones behind them.

    ``run`` has the kind "listing". Listings are archived and recorded as other payloads are. With ``path`` the list is written
    there, if any came. Returns line, symbol.
    """
    collect(spark, store, spark.createDataFrame(list(enumerate(exchanges)), "line bigint, symbol string"), run)
    seq = store.log().agg(F.max("seq")).first()[0]
    kept = store.bronze().where((F.col("provider") == run.provider.name) & (F.col("seq") == seq))
    found = normalize.listing(kept).select((F.row_number().over(Window.orderBy("symbol")) - 1).cast("bigint").alias("line"), "symbol")  # a list of symbols
    if existing is not None:
        merged = listing.merge_symbols(existing, found)
        found = merged.select((F.row_number().over(Window.orderBy("list", "line")) - 1).cast("bigint").alias("line"), "symbol")
    if path and not found.isEmpty():
        config.write_lines(found, path, ["line"])
    return found


def refresh_indicators(store: Store, now: str, symbols: DataFrame | None = None) -> None:
    """Put the indicators of stored bars over those in the table ``indicators``: of all symbols, or of those given, in one job."""
    bars = store.table("ohlcv")
    if symbols is not None:
        bars = bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    store.upsert("indicators", indicators.indicator_rows(bars), now, ["date"])


def tables(store: Store) -> dict[str, DataFrame]:
    return {name: store.table(name) for name in schemas.TABLES}


def report(store: Store) -> DataFrame:
    """Status, number of issues and counts of the stored tables; kept as the document validation/latest."""
    found = validate.report(tables(store))
    store.save("validation/latest", found)
    return found


def daily_summary(store: Store, today: str) -> DataFrame:
    """One row: archived payloads, rows of the tables, runs and the last of them; kept as the document daily/<today>."""
    found = summary.daily(tables(store), store.bronze(), store.runs(), ["seq"], today)
    store.save(f"daily/{today}", found)
    return found
