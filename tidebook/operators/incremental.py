"""Indicators kept up to date from stored states: what changed is computed again, and no more.

A state is what the recursions carry from one bar to the next: the closes of the longest mean, the smoothed means, and
the values they begin from. Some of a symbol's states are stored, those of its last bar and of dates that a hash picks, so
that late bars don't move them. A change makes dirty what comes after it, up to the next gap, where everything begins anew, or to a
stored state that the new computation meets again.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import casts, schemas, workers
from tidebook.operators.indicators import SMA_PERIODS, Ema, Recursive, Rsi

#: Of so many dates about one has its state stored.
EVERY = 64
#: States meet if they differ by less than this part of their largest number: differences shrink at each bar until rounding holds them up.
CLOSE = 2e-15
OUT = "symbol string, date string, open string, high string, low string, close string, volume string, " + ", ".join(f"{c} double" for c in schemas.INDICATORS) + ", state string"


class Running:
    """All indicators of one symbol, with a state that can be stored."""

    def __init__(self):
        self.tail: deque[float] = deque(maxlen=max(SMA_PERIODS))
        self.recursive = Recursive((), 14, 12, 26, 9)

    def reset(self) -> None:
        self.tail.clear()
        self.recursive.reset()

    def add(self, close: float | None) -> list[float | None]:
        rest = self.recursive.add(close)
        if close is None:
            self.tail.clear()
            return [None] * len(SMA_PERIODS) + rest
        self.tail.append(close)
        last = np.array(self.tail)
        return [float(np.add.accumulate(last[-p:])[-1] / p) if len(last) >= p else None for p in SMA_PERIODS] + rest

    def numbers(self) -> list[float]:
        """The state as numbers: lists with their lengths, and what isn't there as NaN."""
        out = [len(self.tail), *self.tail]
        for part in self.recursive.all:
            if isinstance(part, Ema):
                out += [len(part.seed), *part.seed, part.now is not None, part.now or 0.0]
            else:
                out += [2 * len(part.seed), *(x for pair in part.seed for x in pair), part.last is not None, part.last or 0.0, part.ready, part.gain, part.loss]
        return [float(x) for x in out]

    def load(self, numbers: list[float]) -> None:
        rest = iter(numbers)
        some = lambda: [next(rest) for _ in range(int(next(rest)))]
        self.reset()
        self.tail.extend(some())
        for part in self.recursive.all:
            seed, there, value = some(), next(rest), next(rest)
            if isinstance(part, Rsi):
                part.seed.extend(zip(seed[::2], seed[1::2]))
                part.last, part.ready, part.gain, part.loss = value if there else None, bool(next(rest)), next(rest), next(rest)
            else:
                part.seed, part.now = seed, value if there else None


def pack(numbers: list[float]) -> str:
    return base64.b64encode(struct.pack(f"<{len(numbers)}d", *numbers)).decode()


def unpack(state: str) -> list[float]:
    return np.frombuffer(base64.b64decode(state), "<f8").tolist()


def met(state: list[float], stored: list[float], close: float = CLOSE) -> bool:
    """Whether two states are as good as equal."""
    if len(state) != len(stored):
        return False
    largest = max((abs(x) for x in stored if abs(x) < float("inf")), default=0.0)
    return bool(np.allclose(state, stored, rtol=0, atol=close * largest, equal_nan=True))


def picked(date: str, every: int) -> bool:
    """Whether a date's state is stored: by a hash, so that other dates have no say in it."""
    return zlib.crc32(date.encode()) % every == 0


def _go_on(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """Rows by symbol and date, a bar before the state stored for its date. A bar is held back until what follows it is known."""
    schema = pa.schema([(c, pa.float64() if t == "double" else pa.string()) for c, t in (x.split() for x in OUT.split(", "))])
    running, symbol, held, keep, done, out = Running(), None, None, False, False, []

    def let_go(keep: bool) -> None:
        if held:
            out.append((*held, pack(running.numbers()) if keep or picked(held[1], every) else None))

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    for batch in batches:
        for its, date, is_state, price, last, state, *texts in zip(*(c.to_pylist() for c in batch.columns)):
            if its != symbol:
                let_go(True)
                symbol, held, keep, done = its, None, False, False
                running.reset()
            if done:
                continue
            if is_state:
                if held is None:
                    running.load(unpack(state))
                elif held[1] == date:
                    done = date >= last and met(running.numbers(), unpack(state))
                    keep = not done
            else:
                let_go(keep)
                held, keep, done = None, False, price is None and date > last
                if not done:
                    held = (its, date, *texts, *running.add(price))
            if done:
                let_go(False)
                held = None
        if out:
            yield made()
            out.clear()
    let_go(True)
    if out:
        yield made()


def changed_bars(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Those of ``incoming`` (a row a key) that ``stored`` doesn't have just so."""
    old = stored.select("symbol", "date", *[F.col(c).alias(f"__{c}") for c in schemas.BAR[1:]], F.lit(True).alias("__there"))
    same = F.col("__there").isNotNull()
    for c in schemas.BAR[1:]:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return incoming.join(old, ["symbol", "date"], "left").where(~same).select("symbol", *schemas.BAR)


def dirty_ranges(changed: DataFrame, states: DataFrame) -> DataFrame:
    """symbol, first and last changed date, since (the stored state before them that computing goes on from, or null), appended (nothing is stored behind)."""
    span = changed.groupBy("symbol").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    known = states.select("symbol", F.col("date").alias("__at")).join(span, "symbol")
    before = known.groupBy("symbol").agg(F.max(F.when(F.col("__at") < F.col("first"), F.col("__at"))).alias("since"), F.max("__at").alias("__latest"))
    return span.join(before, "symbol", "left").select("symbol", "first", "last", "since", F.coalesce(F.col("first") > F.col("__latest"), F.lit(False)).alias("appended"))


def recompute(changed: DataFrame, ranges: DataFrame, bars: DataFrame | None, states: DataFrame, every: int = EVERY) -> DataFrame:
    """Rows of what changes made dirty: bars as they are, indicators as numbers, and the states to be stored (null: none for this date).

    Symbols with changes behind all that is stored take only ``changed`` and their last state; ``bars``, the stored table with the changes in
    it, is read for others, from the state before their first change on (None: there are none). Rows are dealt by symbol and sorted, and each task
    goes through them once with one state.
    """
    workers.ship(changed.sparkSession)
    price = casts.try_double(F.col("close"))
    columns = ["symbol", "date", "is_state", "price", "last", "state", *schemas.BAR[1:]]

    def as_bars(rows: DataFrame) -> DataFrame:
        return rows.select("symbol", "date", F.lit(False).alias("is_state"), price.alias("price"), "last", F.lit(None).cast("string").alias("state"), *schemas.BAR[1:])

    dirty = as_bars(changed.join(ranges.where("appended"), "symbol"))
    if bars is not None:
        others = bars.join(ranges.where("not appended"), "symbol").where(F.col("date") > F.coalesce("since", F.lit("")))
        dirty = dirty.unionByName(as_bars(others))
    none = [F.lit(None).cast("string").alias(c) for c in schemas.BAR[1:]]
    kept = states.join(ranges, "symbol").where((F.col("date") == F.col("since")) | (F.col("date") >= F.col("first")))
    rows = dirty.unionByName(kept.select("symbol", "date", F.lit(True).alias("is_state"), F.lit(None).cast("double").alias("price"), "last", "state", *none))
    dealt = rows.repartition("symbol").sortWithinPartitions("symbol", "date", "is_state").select(*columns)
    return dealt.mapInArrow(lambda batches: _go_on(batches, every), OUT)


def as_text(rows: DataFrame) -> DataFrame:
    """Recomputed rows as rows of the table ``indicators``."""
    text = [F.coalesce(casts.number_text(F.col(c)), F.lit("")).alias(c) for c in schemas.INDICATORS]
    return rows.select("symbol", "date", *[F.coalesce(c, F.lit("")).alias(c) for c in schemas.BAR[1:]], *text)
