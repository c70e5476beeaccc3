"""Technical indicators of close prices, ordered by date within each symbol.

A null close is a gap: it has no value itself and everything starts anew after it.
NaN is a value like any other.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import casts, schemas, workers

SMA_PERIODS = (20, 50, 200)


def segments(bars: DataFrame) -> DataFrame:
    """Adds ``seg``, the number of gaps up to a row: rows of a segment have no gap between them."""
    before = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return bars.withColumn("seg", F.sum(F.col("close").isNull().cast("int")).over(before))


def sma(bars: DataFrame, periods: tuple[int, ...] = SMA_PERIODS) -> DataFrame:
    """Adds sma_<period>: the mean of as many consecutive closes, null before there are so many.

    All periods share one shuffle and one sort. Frames are summed anew for each row, so a NaN
    leaves a mean once it leaves the window.
    """
    out = segments(bars)
    for p in periods:
        frame = Window.partitionBy("symbol", "seg").orderBy("date").rowsBetween(1 - p, 0)
        enough = (F.count("close").over(frame) == p) & F.col("close").isNotNull()
        out = out.withColumn(f"sma_{p}", F.when(enough, F.avg("close").over(frame)))
    return out.drop("seg")


def deltas(bars: DataFrame) -> DataFrame:
    """Adds gain and loss against the close before in the same segment; null on a segment's first row."""
    w = Window.partitionBy("symbol", "seg").orderBy("date")
    change = F.col("close") - F.lag(F.when(F.col("close").isNotNull(), F.col("close"))).over(w)
    out = segments(bars).withColumn("delta", change)
    return out.select(
        *bars.columns, F.when(F.col("delta").isNotNull(), F.greatest("delta", F.lit(0.0))).alias("gain"),
        F.when(F.col("delta").isNotNull(), F.greatest(-F.col("delta"), F.lit(0.0))).alias("loss"),
    )


class Ema:
    """An exponential mean that begins as the mean of its first ``period`` values."""

    def __init__(self, period: int):
        self.period, self.rate = period, 2 / (period + 1)
        self.reset()

    def reset(self) -> None:
        self.seed: list[float] = []
        self.now: float | None = None

    def add(self, x: float) -> float | None:
        if self.now is not None:
            self.now = (x - self.now) * self.rate + self.now
        else:
            self.seed.append(x)
            if len(self.seed) == self.period:
                self.now = sum(self.seed) / self.period
        return self.now


class Rsi:
    """Wilder's relative strength: smoothed mean gain against smoothed mean loss."""

    def __init__(self, period: int):
        self.period = period
        self.reset()

    def reset(self) -> None:
        self.last: float | None = None
        self.seed: deque[float] = deque()
        self.gain = self.loss = 0.0
        self.ready = False

    def add(self, x: float) -> float | None:
        last, self.last = self.last, x
        if last is None:
            return None
        change = x - last
        # comparisons as max(change, 0) makes them: NaN stays, being the first
        gain, loss = (0.0 if 0.0 > change else change), (0.0 if 0.0 > -change else -change)
        n = self.period
        if self.ready:
            self.gain, self.loss = (self.gain * (n - 1) + gain) / n, (self.loss * (n - 1) + loss) / n
        else:
            self.seed.append((gain, loss))
            if len(self.seed) < n:
                return None
            self.gain, self.loss = (sum(s[k] for s in self.seed) / n for k in (0, 1))
            self.ready = True
        return 100.0 if self.loss == 0 else 100 - 100 / (1 + self.gain / self.loss)


class Recursive:
    """All recursive indicators of one symbol."""

    def __init__(self, ema_periods: tuple[int, ...], rsi: int, fast: int, slow: int, signal: int):
        self.emas = [Ema(p) for p in ema_periods]
        self.rsi, self.fast, self.slow, self.signal = Rsi(rsi), Ema(fast), Ema(slow), Ema(signal)
        self.all = [*self.emas, self.rsi, self.fast, self.slow, self.signal]

    def reset(self) -> None:
        for x in self.all:
            x.reset()

    def add(self, close: float | None) -> list[float | None]:
        if close is None:
            self.reset()
            return [None] * (len(self.emas) + 4)
        fast, slow = self.fast.add(close), self.slow.add(close)
        macd = None if fast is None or slow is None else fast - slow
        signal = None if macd is None else self.signal.add(macd)
        return [*(e.add(close) for e in self.emas), self.rsi.add(close), macd, signal, None if signal is None else macd - signal]


def recursive(bars: DataFrame, ema_periods: tuple[int, ...] = (), rsi: int = 14, macd: tuple[int, int, int] = (12, 26, 9)) -> DataFrame:
    """Adds ema_<period>, rsi_<period>, macd_<fast>_<slow>, macd_signal_<signal> and macd_hist.

    Rows are dealt by symbol and sorted by date by Spark, and each task goes through
    its sorted rows once, an Arrow batch at a time, with a few numbers of state: however long a
    symbol's history, it is never held as a whole.
    """
    workers.ship(bars.sparkSession)
    names = [*(f"ema_{p}" for p in ema_periods), f"rsi_{rsi}", f"macd_{macd[0]}_{macd[1]}", f"macd_signal_{macd[2]}", "macd_hist"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bars.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, symbol, begun = Recursive(ema_periods, rsi, *macd), None, False
        for batch in batches:
            out: list[list[float | None]] = []
            for s, close in zip(batch.column("symbol").to_pylist(), batch.column("close").to_pylist()):
                if not begun or s != symbol:
                    state.reset()
                    symbol, begun = s, True
                out.append(state.add(close))
            made = [pa.array([r[k] for r in out], pa.float64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    dealt = bars.repartition("symbol").sortWithinPartitions("symbol", "date")
    return dealt.mapInArrow(run, kinds + "".join(f", {n} double" for n in names))


def all_indicators(bars: DataFrame) -> DataFrame:
    """Bars with sma_20, sma_50, sma_200, rsi_14, macd_12_26, macd_signal_9 and macd_hist, as numbers."""
    return recursive(sma(bars))


def indicator_rows(ohlcv: DataFrame) -> DataFrame:
    """Rows of the table ``indicators`` for stored bars: bars as they are, indicators as text, none as the empty text."""
    typed = ohlcv.select("symbol", "date", *[F.col(c).alias(f"__{c}") for c in schemas.BAR[1:]], casts.try_double(F.col("close")).alias("close"))
    made = all_indicators(typed)
    text = [casts.number_text(F.col(c)).alias(c) for c in schemas.INDICATORS]
    return made.select("symbol", "date", *[F.coalesce(F.col(f"__{c}"), F.lit("")).alias(c) for c in schemas.BAR[1:]], *text)


def processed(symbols: DataFrame, ohlcv: DataFrame) -> DataFrame:
    """symbol, status (done or missing_ohlcv) and rows for the symbols asked for."""
    rows = ohlcv.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    joined = symbols.select("symbol").join(rows, "symbol", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return joined.select("symbol", F.when(F.col("rows") > 0, "done").otherwise("missing_ohlcv").alias("status"), "rows")
