"""What to collect next: statuses, work selection, call budgets and rates, all derived from the fetch log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Statuses by what is collected first; those not listed here, such as done and dry_run, come last.
PRIORITY = {"failed": 0, None: 1, "skipped_rate_limit": 2}
LAST_PRIORITY = 3
#: Lines of a list that one task counts.
STRETCH = 65_536
#: Days of news before the last one.
DAYS_BACK = 7


def latest_status(log: DataFrame) -> DataFrame:
    """provider, symbol, status, updated_at, rows, error and last_success_at of the latest event, per provider and symbol."""
    last = F.max_by(F.struct("status", "at", "rows", "error"), F.struct("at", "seq")).alias("last")
    found = log.groupBy("provider", "symbol").agg(last, F.max(F.when(F.col("status") == "done", F.col("at"))).alias("last_success_at"))
    return found.select("provider", "symbol", "last.status", F.col("last.at").alias("updated_at"), "last.rows", "last.error", "last_success_at")


def priority(status: Column) -> Column:
    out = F.lit(LAST_PRIORITY)
    for name, rank in PRIORITY.items():
        out = F.when(status.isNull() if name is None else F.coalesce(status == name, F.lit(False)), rank).otherwise(out)
    return out


def waiting(lists: DataFrame, statuses: DataFrame, today: str, force: bool = False) -> DataFrame:
    """provider, symbol, line, priority of what the providers' lists (provider, line, symbol) have to be asked for; what succeeded ``today`` is left out unless ``force``."""
    known = statuses.select("provider", "symbol", "status", F.to_date("last_success_at").alias("day"))
    joined = lists.select("provider", "line", "symbol").join(known, ["provider", "symbol"], "left")
    done = F.coalesce(F.col("day") == F.lit(today).cast("date"), F.lit(False))
    return (joined if force else joined.where(~done)).select("provider", "symbol", "line", priority(F.col("status")).alias("priority"))


def pending(symbols: DataFrame, statuses: DataFrame, provider: str, today: str, limit: int, force: bool = False) -> DataFrame:
    """symbol, line, priority of the next ``limit`` symbols: failed ones, then new ones, then skipped ones, then the rest.

    ``symbols`` (line, symbol) come in the order of their lines; those that succeeded ``today`` are left out
    unless ``force``. Ends in a top-k: no full sort.
    """
    mine = waiting(symbols.withColumn("provider", F.lit(provider)), statuses, today, force)
    return mine.select("symbol", "line", "priority").orderBy("priority", "line").limit(limit)


def running_ranks(candidates: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``waiting`` with n, the place of a symbol among its provider's by priority and line, from 1.

    Places are counted within stretches of ``stretch`` lines, each a task's work, and begin behind the running sum of
    what is in the stretches before, so a long list doesn't meet in one task.
    """
    at = candidates.withColumn("__stretch", F.floor(F.coalesce("line", F.lit(-1)) / stretch))
    cell = ["provider", "priority", "__stretch"]
    before = Window.partitionBy("provider").orderBy("priority", "__stretch").rowsBetween(Window.unboundedPreceding, -1)  # a row per stretch
    sizes = at.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).select(*cell, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy(*cell).orderBy("line", "symbol"))
    return at.withColumn("__within", within).join(sizes, cell).withColumn("n", F.col("__within") + F.col("__before")).drop("__stretch", "__within", "__before")


def allocate(candidates: DataFrame, slots: DataFrame, limits: DataFrame) -> DataFrame:
    """provider, symbol, line, priority, n, key_index (null: no call left) of what all providers are to be asked for in one run.

    ``candidates``: as ``waiting`` gives them; ``slots``: ``key_slots``; ``limits``: provider and max_symbols. The calls left on a provider's keys, one key after
    the other, are intervals of running sums; a symbol's place falls into one of them. The first symbol behind
    all of them is there as well, to be recorded as skipped; a provider that has no limit's row is asked for nothing.
    """
    up_to = Window.partitionBy("provider").orderBy("key_index").rowsBetween(Window.unboundedPreceding, 0)
    keys = slots.where("allowed").withColumn("__last", F.sum("remaining").over(up_to))
    keys = keys.select(F.col("provider").alias("__provider"), "key_index", (F.col("__last") - F.col("remaining")).alias("__first"), "__last")  # a row per key
    calls = keys.groupBy(F.col("__provider").alias("provider")).agg(F.max("__last").alias("__calls"))
    room = limits.join(calls, "provider", "left").select("provider", F.least("max_symbols", F.coalesce("__calls", F.lit(0)) + 1).alias("__room"))
    asked = running_ranks(candidates).join(F.broadcast(room), "provider").where(F.col("n") <= F.col("__room")).drop("__room")  # a row per provider
    inside = (F.col("provider") == F.col("__provider")) & (F.col("n") > F.col("__first")) & (F.col("n") <= F.col("__last"))
    return asked.join(F.broadcast(keys), inside, "left").select("provider", "symbol", "line", "priority", "n", "key_index")


def first_lines(symbols: DataFrame, limit: int | None = None) -> DataFrame:
    """A list (line, symbol) in its order, or the first ``limit`` of it."""
    ordered = symbols.orderBy("line")
    return ordered if limit is None else ordered.limit(limit)


def current_run(log: DataFrame, runs: DataFrame) -> DataFrame:
    """One row for a run that goes on (or broke off), none without: seq, processed, failed, skipped, last_symbol and updated_at."""
    ended = runs.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("ended"))  # one row
    going = log.join(F.broadcast(ended), F.col("seq") > F.col("ended"))
    counts = run_counts(going, "seq")
    last = going.groupBy(F.col("seq").alias("s")).agg(F.max_by("symbol", F.struct("at", "symbol")).alias("last_symbol"), F.max("at").alias("updated_at"))
    return counts.join(last, F.col("seq") == F.col("s")).drop("s").orderBy(F.desc("seq")).limit(1)


def done_today(symbols: DataFrame, statuses: DataFrame, provider: str, today: str, total: int) -> DataFrame:
    """One row: progress_done (``total`` at most) and progress_total."""
    mine = statuses.where((F.col("provider") == provider) & (F.to_date("last_success_at") == F.lit(today).cast("date")))
    return mine.agg(F.least(F.count(F.lit(1)), F.lit(total)).cast("bigint").alias("progress_done")).withColumn("progress_total", F.lit(total).cast("bigint"))


def not_done_today(symbols: DataFrame, statuses: DataFrame, provider: str, today: str) -> DataFrame:
    mine = statuses.where((F.col("provider") == provider) & (F.to_date("last_success_at") == F.lit(today).cast("date")))
    return symbols.join(mine.select("symbol"), "symbol", "left_anti")


def usage(log: DataFrame) -> DataFrame:
    """provider, key_index, utc_date and calls_used: a call per event, whether it went well or not. A new day starts at none."""
    spent = log.where("key_index is not null and status in ('done', 'failed')")
    return spent.groupBy("provider", "key_index", F.to_date("at").alias("utc_date")).agg(F.count(F.lit(1)).alias("calls_used"))


def remaining(daily_limit: Column, reserve: Column, used: Column) -> Column:
    """Calls left today without touching the reserve."""
    return F.greatest(F.lit(0), F.greatest(F.lit(0), daily_limit - reserve) - used)


def key_slots(keys: DataFrame, used: DataFrame, today: str) -> DataFrame:
    """provider, key_index, has_key, enabled, calls_used, remaining and allowed per key.

    ``keys``: provider, key_index, has_key, daily_limit, daily_reserve, enabled. A disabled provider has no call allowed.
    """
    now = used.where(F.col("utc_date") == F.lit(today).cast("date")).drop("utc_date")
    joined = keys.join(now, ["provider", "key_index"], "left").withColumn("calls_used", F.coalesce("calls_used", F.lit(0)))
    joined = joined.withColumn("remaining", remaining(F.col("daily_limit"), F.col("daily_reserve"), F.col("calls_used")))
    return joined.select("provider", "key_index", "has_key", "enabled", "calls_used", "remaining", (F.col("enabled") & F.col("has_key") & (F.col("remaining") > 0)).alias("allowed"))


def active_key(slots: DataFrame) -> DataFrame:
    """provider, key_index (the first with calls left, or null) and total_remaining (of keys that are set)."""
    return slots.groupBy("provider").agg(
        F.min(F.when(F.col("allowed"), F.col("key_index"))).alias("key_index"),
        F.sum(F.when(F.col("has_key"), F.col("remaining")).otherwise(F.lit(0))).alias("total_remaining"),
    )


def decide(slots: DataFrame, cost: int = 1) -> DataFrame:
    """Adds reason and allowed_cost for a call of ``cost`` on each of the key_slots."""
    fits = F.col("remaining") >= cost
    return slots.withColumn("reason", F.when(~F.col("enabled"), "provider_disabled").when(fits, "ok").otherwise("daily_budget_reserved")).withColumn("allowed_cost", F.col("enabled") & fits)


def calls_in_window(calls: DataFrame, key: str, at: str, seconds: int = 60, slice_seconds: int = 3600) -> DataFrame:
    """Adds calls_before: calls of the same key within the ``seconds`` up to and with each call, strictly fewer seconds ago.

    A key's calls are cut into slices of time, each with the last seconds before it
    as well, so that a busy key is counted in many tasks.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    size, reach = slice_seconds * 1_000_000, seconds * 1_000_000
    marked = calls.withColumn("__us", micros).withColumn("__slice", F.floor(F.col("__us") / size))
    edge = marked.where(F.col("__us") % size >= size - reach).withColumn("__slice", F.col("__slice") + 1).withColumn("__own", F.lit(False))
    both = marked.withColumn("__own", F.lit(True)).unionByName(edge)
    w = Window.partitionBy(key, "__slice").orderBy("__us").rangeBetween(-(reach - 1), 0)
    return both.withColumn("calls_before", F.count(F.lit(1)).over(w)).where("__own").drop("__us", "__slice", "__own")


def run_counts(log: DataFrame, run: str) -> DataFrame:
    """Per run: processed, failed, skipped."""
    count = lambda *s: F.count_if(F.col("status").isin(*s))
    return log.groupBy(run).agg(count("done", "dry_run").alias("processed"), count("failed").alias("failed"), count("skipped_rate_limit").alias("skipped"))


def last_runs(runs: DataFrame, order: list[str], keep: int = 20) -> DataFrame:
    """The last ``keep`` runs; a top-k, not a window over all."""
    return runs.orderBy(*[F.desc(c) for c in order]).limit(keep)


def news_days(requests: DataFrame, today: str) -> DataFrame:
    """Adds first and last, the days of news that each request is for, and in_order: whether it is one that can be asked.

    ``requests``: from_date, to_date (text, may be empty) and days_back. Without a last day it is ``today``; without a first
    it is as many days before the last. A text that is no day, or a first day behind the last, can't be asked.
    """
    given = {c: F.nullif(F.col(c), F.lit("")) for c in ("from_date", "to_date")}
    day = {c: F.try_to_date(v) for c, v in given.items()}
    last = F.when(given["to_date"].isNull(), F.lit(today).cast("date")).otherwise(day["to_date"])
    back = F.date_sub(F.col("__last"), F.coalesce("days_back", F.lit(DAYS_BACK)).cast("int"))
    first = F.when(given["from_date"].isNull(), back).otherwise(day["from_date"])
    made = requests.withColumn("__last", last).withColumn("__first", first)
    fine = F.coalesce(F.col("__first") <= F.col("__last"), F.lit(False))
    return made.select(*requests.columns, F.col("__first").cast("string").alias("first"), F.col("__last").cast("string").alias("last"), fine.alias("in_order"))
