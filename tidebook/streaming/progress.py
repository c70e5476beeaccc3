"""Progress of streams, appended to a table of the store by a listener."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidebook.sources.store import Store

#: ``query`` stays the same over restarts from one checkpoint, ``run`` doesn't. ``event`` is begun, batch, ended or failed.
PROGRESS = T.StructType([
    T.StructField("query", T.StringType(), False), T.StructField("run", T.StringType(), False), T.StructField("name", T.StringType()), T.StructField("event", T.StringType(), False),
    T.StructField("batch", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("milliseconds", T.LongType()), T.StructField("at", T.StringType()), T.StructField("error", T.StringType()),
])


class ProgressLog(StreamingQueryListener):
    """Keeps what streams of a session say of themselves, and writes it every ``every`` events and whenever a stream ends.

    Events come one at a time from a thread of Spark's. What is written is a row an event; a driver that is lost loses
    at most ``every`` - 1 events that weren't written, not the stream's own progress, which is in its checkpoint. An error in writing is kept in
    ``errors`` and doesn't stop the stream; its events are tried again with the next ones.
    """

    def __init__(self, store: Store, every: int = 20):
        self.store, self.every, self.waiting, self.names, self.errors = store, every, [], {}, []
        self.ended: set[str] = set()
        self._one = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self._keep((str(event.id), str(event.runId), event.name, "begun", None, None, None, str(event.timestamp), None))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._keep((str(p.id), str(p.runId), p.name, "batch", p.batchId, p.numInputRows, p.batchDuration, str(p.timestamp), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run, error = str(event.runId), event.exception
        self._keep((str(event.id), run, self.names.pop(run, None), "failed" if error else "ended", None, None, None, None, error), last=run)

    def _keep(self, row: tuple, last: str | None = None) -> None:
        with self._one:
            self.waiting.append(row)
            if last or len(self.waiting) >= self.every:
                try:
                    rows, spark = self.waiting, self.store.spark
                    spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(f"{self.store.root}/progress")
                    self.waiting = []
                except Exception as e:  # a listener mustn't end what it listens to
                    self.errors.append(e)
            if last:
                self.ended.add(last)
                self._one.notify_all()

    def wait(self, run: str, seconds: float = 60) -> bool:
        """Wait until the end of a run is written; events come some time after the stream itself."""
        with self._one:
            return self._one.wait_for(lambda: run in self.ended, seconds)


def listen(spark: SparkSession, store: Store, every: int = 20) -> ProgressLog:
    """A log that hears of the session's streams; ``spark.streams.removeListener`` ends it."""
    log = ProgressLog(store, every)
    spark.streams.addListener(log)
    return log


def progress(store: Store) -> DataFrame:
    """What was written of all streams."""
    return store._read(f"{store.root}/progress", PROGRESS)


def current(store: Store) -> DataFrame:
    """Of each stream: batches and rows over all its runs (a batch that was done again counts once, as it was last), the last event with its time, and its error."""
    events = progress(store)
    batches = events.where("event = 'batch'").groupBy("query", "batch").agg(F.max_by("rows", "at").alias("rows"))
    counted = batches.groupBy("query").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"))
    begun = events.where("event = 'begun'").groupBy("query").agg(F.max_by("run", "at").alias("run"), F.max("name").alias("name"), F.count("*").alias("runs"))
    latest = events.groupBy("query", "run").agg(F.max("at").alias("at"), F.max(F.when(F.col("event").isin("ended", "failed"), F.col("event"))).alias("end"), F.max("error").alias("error"))
    joined = begun.join(latest, ["query", "run"]).join(counted, "query", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("batches", "rows")]
    return joined.select("query", "name", "runs", F.coalesce("end", F.lit("running")).alias("status"), *zero, "at", "error")
