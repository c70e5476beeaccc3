"""Streams of payload files into stored tables.

New files are taken as they come; a key that is delivered again overwrites what was stored, whenever it
comes, so there is no watermark. A batch that is run again writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.functions import casts
from tidebook.operators import normalize, validate
from tidebook.sources.store import Store

#: Payload kind: (table, its key column for the symbol)
TARGETS = {"bar_list": ("ohlcv", "symbol"), "bar_map": ("ohlcv", "symbol"), "macro": ("macro", "series_id"), "news": ("news", "symbol")}
PAYLOADS = "key string, payload string, seq bigint"


def upsert_batch(store: Store, kind: str, batch: DataFrame, now: str, checked: bool = False) -> None:
    """``checked``: faulty rows go to quarantine, and what was counted is kept with the batch."""
    table, name = TARGETS[kind]
    rows = normalize.ROWS[kind](batch, ["key", "seq"]).withColumnRenamed("key", name)
    # payloads in turn, rows of a payload by date, and by place where dates are equal
    order = ["seq", "date", "pos"] if kind != "news" else ["seq", "datetime", "url", "pos"]
    if checked:
        store.upsert_checked(table, rows, now, order, validate.fault() if table == "ohlcv" else F.lit(None).cast("string"))
    else:
        store.upsert(table, rows, now, order)  # of a batch's buckets alone


def stream_payloads(spark: SparkSession, folder: str, store: Store, kind: str, checkpoint: str, files_per_batch: int = 1000, clock=None, checked: bool = False) -> StreamingQuery:
    """Upsert JSON lines files (key, payload, seq) that are in ``folder`` or come to it; takes what is there and ends."""
    source = spark.readStream.schema(PAYLOADS).option("maxFilesPerTrigger", files_per_batch).json(folder)

    def each(batch: DataFrame, number: int) -> None:
        now = clock() if clock else batch.sparkSession.sql("select current_timestamp() as t").select(casts.iso_z(F.col("t"))).first()[0]
        upsert_batch(store, kind, batch, now, checked)

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
