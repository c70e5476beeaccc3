"""Smoothed means of one symbol's history over many tasks: a parallel scan of linear recurrences.

A mean m' = (1 - rate) m + rate x is an affine map of m, and so is each step of its beginning: of the first ``period`` values
each adds x / period, and a gap sets it to 0. Maps of a stretch of days compose to one map. So each stretch composes its own,
stretches' maps are applied one after the other, a row each, and what comes in at a stretch is put into the maps of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import workers
from tidebook.sources import scratch

#: Days of a stretch: what one task has of a symbol at a time, as there is one row a day.
STRETCH_DAYS = 512


@dataclass(frozen=True)
class Mean:
    """The mean ``name`` of the column ``value``: begun as a plain mean of ``period`` values, then smoothed by ``rate``. The first ``after`` values since a gap are none yet."""

    name: str
    value: str
    period: int
    rate: float
    after: int = 0


def ema(name: str, value: str, period: int, after: int = 0) -> Mean:
    return Mean(name, value, period, 2 / (period + 1), after)


def wilder(name: str, value: str, period: int, after: int = 0) -> Mean:
    return Mean(name, value, period, 1 / period, after)


def _stretch(date: Column, days: int) -> Column:
    return F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / days)


def _placed(rows: DataFrame, value: str, days: int) -> DataFrame:
    """Adds stretch, __place (a value's place since the last gap, from 1; 0 in a gap) and __before (the value of the row before).

    Places are counted in stretches, then over the stretches' counts, a row each.
    """
    own = Window.partitionBy("symbol", "stretch").orderBy("date")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("stretch", _stretch(F.col("date"), days)).withColumns({"__n": F.count(value).over(so_far), "__row": F.row_number().over(own), "__last": F.lag(value).over(own)})
    local = local.withColumn("__gap", F.max(F.when(F.col(value).isNull(), F.col("__n"))).over(so_far))
    sums = local.groupBy("symbol", "stretch").agg(F.max("__n").alias("n"), F.max("__gap").alias("gap"), F.max_by(F.struct(value), "date").alias("edge"))
    in_turn = Window.partitionBy("symbol").orderBy("stretch")
    before = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.withColumn("total", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("at_gap", F.col("total") + F.col("gap"))
    carried = totals.select("symbol", "stretch", (F.col("total") - F.coalesce(F.last("at_gap", ignorenulls=True).over(before), F.lit(0))).alias("__carried"), F.lag("edge").over(in_turn)[value].alias("__edge"))
    place = F.when(F.col(value).isNull(), 0).when(F.col("__gap").isNotNull(), F.col("__n") - F.col("__gap")).otherwise(F.col("__n") + F.col("__carried"))
    found = local.join(carried, ["symbol", "stretch"])
    return found.withColumns({"__place": place, "__before": F.when(F.col("__row") == 1, F.col("__edge")).otherwise(F.col("__last"))}).drop("__n", "__row", "__last", "__gap", "__carried", "__edge")


def _composed(batches: Iterator[pa.RecordBatch], means: list[Mean]) -> Iterator[pa.RecordBatch]:
    """Each row's maps from the beginning of its stretch: factor and term of each mean."""
    stretch, maps = None, []
    for batch in batches:
        keys = zip(batch.column("symbol").to_pylist(), batch.column("stretch").to_pylist())
        out, given = [], zip(*(batch.column(m.value).to_pylist() for m in means))
        for key, since, row in zip(keys, batch.column("__place").to_pylist(), given):
            if key != stretch:
                stretch, maps = key, [(1.0, 0.0)] * len(means)
            for k, (m, x) in enumerate(zip(means, row)):
                (a, b), place = maps[k], max(0, since - m.after)
                if place <= 1:  # a gap, or the first value behind one: nothing is left of what was before
                    maps[k] = (0.0, 0.0 if place == 0 else x / m.period)
                elif place <= m.period:
                    maps[k] = (a, b + x / m.period)
                else:
                    maps[k] = ((1 - m.rate) * a, b + (x - b) * m.rate)
            out.append([y for pair in maps for y in pair])
        names = [f"__{x}{k}" for k in range(len(means)) for x in "ab"]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.float64()) for c in zip(*out))], [*batch.schema.names, *names]) if out else pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array([], pa.float64()) for _ in names)], [*batch.schema.names, *names])


def _applied(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """What comes in at each stretch, from the maps of those before it."""
    symbol, now = None, []
    for batch in batches:
        its, stretches, *maps = (c.to_pylist() for c in batch.columns)
        incoming = []
        for s, *row in zip(its, *maps):
            if s != symbol:
                symbol, now = s, [0.0] * n
            incoming.append(now)
            now = [row[2 * k + 1] + (row[2 * k] * now[k] if row[2 * k] else 0.0) for k in range(n)]  # nothing of a NaN gets over a gap
        columns = zip(*incoming) if incoming else [[] for _ in range(n)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.float64()) for c in columns)], ["symbol", "stretch", *(f"__in{k}" for k in range(n))])


def _scanned(placed: DataFrame, means: list[Mean]) -> DataFrame:
    """Adds the means to placed rows."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    n, names = len(means), [f"__{x}{k}" for k in range(len(means)) for x in "ab"]
    dealt = placed.repartition("symbol", "stretch").sortWithinPartitions("symbol", "stretch", "date")
    composed = scratch.written(dealt.mapInArrow(lambda b: _composed(b, means), kinds + "".join(f", {c} double" for c in names)), "scan")
    ends = composed.groupBy("symbol", "stretch").agg(F.max_by(F.struct(*names), "date").alias("map"))
    in_turn = ends.select("symbol", "stretch", "map.*").repartition("symbol").sortWithinPartitions("symbol", "stretch")
    kind = composed.schema["symbol"].dataType.simpleString()
    incoming = in_turn.mapInArrow(lambda b: _applied(b, n), f"symbol {kind}, stretch bigint" + "".join(f", __in{k} double" for k in range(n)))
    came = [F.when(F.col(f"__a{k}") == 0, 0.0).otherwise(F.col(f"__a{k}") * F.col(f"__in{k}")) for k in range(n)]
    made = [F.when(F.col("__place") - m.after >= m.period, came[k] + F.col(f"__b{k}")).alias(m.name) for k, m in enumerate(means)]
    return composed.join(incoming, ["symbol", "stretch"]).select(*placed.columns, *made)


def smoothed(rows: DataFrame, means: list[Mean], value: str = "close", days: int = STRETCH_DAYS) -> DataFrame:
    """Adds the means to ``rows`` (symbol, date, and the values): null until there are ``period`` values since the last gap, a null ``value``.

    A symbol's rows are dealt by stretches of ``days``, so a single symbol is as many tasks' work as it has stretches. Rows and their
    maps are written once; the stretches' own maps, a row each, are all that goes through one task a symbol.
    """
    workers.ship(rows.sparkSession)
    found = _scanned(_placed(rows, value, days), means)
    return found.select(*rows.columns, *[m.name for m in means])


def recursive(bars: DataFrame, ema_periods: tuple[int, ...] = (), rsi: int = 14, macd: tuple[int, int, int] = (12, 26, 9), days: int = STRETCH_DAYS) -> DataFrame:
    """What ``indicators.recursive`` adds to bars (symbol, date, close), with each symbol's history split over tasks.

    The first change of a stretch is against the last close of the stretch before. NaN spreads to the end of its segment, as it does in one pass.
    """
    workers.ship(bars.sparkSession)
    change = F.col("close") - F.col("__before")
    up, down = (F.when(change.isNotNull(), F.when(F.isnan(change), change).otherwise(F.greatest(x, F.lit(0.0)))) for x in (change, -change))
    rows = _placed(bars, "close", days).withColumns({"__up": up, "__down": down})
    fast, slow, signal = macd
    means = [*(ema(f"ema_{p}", "close", p) for p in ema_periods), ema("__fast", "close", fast), ema("__slow", "close", slow), wilder("__gain", "__up", rsi, 1), wilder("__loss", "__down", rsi, 1)]
    found = _scanned(rows, means).withColumn("__macd", F.col("__fast") - F.col("__slow"))
    found = _scanned(found, [ema("__signal", "__macd", signal, max(fast, slow) - 1)])
    strength = F.when(F.col("__loss") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("__gain") / F.col("__loss")))
    return found.select(
        *bars.columns, *[f"ema_{p}" for p in ema_periods], F.when(F.col("__gain").isNotNull(), strength).alias(f"rsi_{rsi}"), F.col("__macd").alias(f"macd_{fast}_{slow}"),
        F.col("__signal").alias(f"macd_signal_{signal}"), (F.col("__macd") - F.col("__signal")).alias("macd_hist"),
    )
