"""Indicators of a stream of bars: each symbol's running state is the stream's own, kept by Spark from batch to batch.

Bars that come in the order of their dates are computed at once from the state. What the state can't tell, a date that was passed already
or a symbol whose state has expired, is left to the dirty ranges of ``refresh``, which compute on from stored states; after a late
bar the stream's state no longer holds, and that symbol's bars go the same way from then on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidebook.functions import casts, schemas, workers
from tidebook.operators import incremental
from tidebook.operators import upsert as upserts
from tidebook.plans import refresh
from tidebook.sources import scratch
from tidebook.sources.store import Store

#: What the stream's session needs: a state store with several values a key, and no batches without rows, which states that may expire would ask for without end.
NEEDED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
BARS = "symbol string, " + ", ".join(f"{c} string" for c in schemas.BAR) + ", seq long"
#: Milliseconds without a bar after which a symbol's running state goes; its last date stays.
STATE_TTL = 30 * 24 * 3600 * 1000
OUT = f"symbol string, {', '.join(f'{c} string' for c in schemas.BAR)}, seq long, behind boolean, " + ", ".join(f"{c} double" for c in schemas.INDICATORS) + ", state string"


class LiveIndicators(StatefulProcessor):
    """``seen``: the last date and whether the running state holds; ``running``: that state, which may expire."""

    def __init__(self, ttl: int, every: int):
        self.ttl, self.every = ttl, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "date string, holds boolean")
        self.running = handle.getValueState("running", "state string", ttlDurationMs=self.ttl or None)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for date, state in zip(initialState["date"], initialState["state"]):
            self.seen.update((date, True))
            self.running.update((state,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars = pd.concat(list(rows)).sort_values(["date", "seq"], kind="stable").drop_duplicates("date", keep="last")
        last, holds = self.seen.get() if self.seen.exists() else ("", True)
        known = self.running.exists()
        running = incremental.Running()
        if known:
            running.load(incremental.unpack(self.running.get()[0]))
        holds = bool(holds) and (known or not last)
        late = (bars["date"] <= last).any()
        if late or not holds:  # all of the batch, so that what comes after a late bar isn't computed from before it
            out = bars.assign(behind=True, **dict.fromkeys(schemas.INDICATORS), state=None)
            self.running.clear()
            self.seen.update((max(last, bars["date"].max()), False))
        else:
            made, dates = [], list(bars["date"])
            for k, (date, price) in enumerate(zip(dates, bars["price"])):
                values = running.add(None if price is None or (price != price and not bars["is_nan"].iloc[k]) else float(price))
                stored = k == len(dates) - 1 or incremental.picked(date, self.every)
                made.append((*values, incremental.pack(running.numbers()) if stored else None))
            out = bars.assign(behind=False, **{c: [m[j] for m in made] for j, c in enumerate((*schemas.INDICATORS, "state"))})
            self.running.update((made[-1][-1],))
            self.seen.update((dates[-1], True))
        yield out[[c.split()[0] for c in OUT.split(", ")]]

    def close(self) -> None:
        pass


def live_indicators(bars: DataFrame, initial: DataFrame | None = None, ttl: int = STATE_TTL, every: int = incremental.EVERY) -> DataFrame:
    """A stream of bars (symbol, date, open, high, low, close, volume as text, seq) with their indicators and the states to be stored.

    ``behind`` marks bars that the running state can't tell; they have no indicators. Of bars with one date in a batch
    the last by ``seq`` counts. ``initial`` (symbol, date, state) is what symbols begin from. A batch's bars of one symbol meet in one task: as many as
    a trigger takes in of its days.
    """
    workers.ship(bars.sparkSession)
    price = casts.try_double(F.col("close"))
    rows = bars.where("date <> ''").withColumns({"price": price, "is_nan": F.coalesce(F.isnan(price), F.lit(False))})
    start = None if initial is None else initial.select("symbol", "date", "state").groupBy("symbol")
    return rows.groupBy("symbol").transformWithStateInPandas(LiveIndicators(ttl, every), OUT, "Append", "ProcessingTime" if ttl else "None", initialState=start)


def last_states(store: Store) -> DataFrame:
    return upserts.last_wins(store.table("indicator_states").select("symbol", "date", "state"), ["symbol"], ["date"])


def keep_indicators(source: DataFrame, store: Store, checkpoint: str, now: str, ttl: int = STATE_TTL, every: int = incremental.EVERY) -> StreamingQuery:
    """Store the bars of a stream and their indicators; takes what is there and ends. Begun anew it goes on from its checkpoint.

    A batch that is run again puts the same rows; a stream without a checkpoint begins from the store's own states.
    """
    spark: SparkSession = store.spark
    begun = scratch.exists(spark, f"{checkpoint}/commits")
    made = live_indicators(source, None if begun else scratch.written(last_states(store), "states"), ttl, every)

    def each(batch: DataFrame, number: int) -> None:
        rows = scratch.written(batch, "live")
        in_turn, behind = rows.where("not behind"), rows.where("behind")
        store.upsert("ohlcv", in_turn, now, ["seq"])
        store.upsert("indicators", incremental.as_text(in_turn), now, ["date"])
        store.upsert("indicator_states", in_turn.where("state is not null").select("symbol", "date", "state"), now, ["date"])
        if not behind.isEmpty():
            refresh.upsert_bars(store, behind.select("symbol", *schemas.BAR, "seq"), now, ["seq"])
            refresh.refresh(store, now, every)

    before = {k: spark.conf.get(k, None) for k in NEEDED}
    try:
        for k, v in NEEDED.items():
            spark.conf.set(k, v)
        return made.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()  # in a session of its own from here
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
