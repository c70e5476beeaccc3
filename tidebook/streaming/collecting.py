"""A provider's list collected as a stream: archived, upserted and recorded batch by batch, and gone on with where it broke off."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.operators import normalize
from tidebook.sources import rest_stream
from tidebook.sources.rest import Transport
from tidebook.sources.store import Store
from tidebook.streaming.ingest import TARGETS, upsert_batch


def keep_batch(store: Store, provider: str, kind: str, batch: DataFrame, seq: int, now: str) -> None:
    """Archive a batch's payloads, upsert their rows and record what became of each symbol, under ``seq``.

    What an earlier try has archived or recorded under it stays as it is, so a batch that is run again adds nothing.
    """
    mine = (F.col("provider") == provider) & (F.col("seq") == seq)
    if store.bronze().where(mine).isEmpty():
        at = F.lit(now).cast("timestamp").alias("fetched_at")
        store.archive(batch.select("provider", "key", at, "payload", "error", "earlier", "calls", F.lit(seq).cast("bigint").alias("seq")))
    kept = store.bronze().where(mine)
    if kind in TARGETS:
        upsert_batch(store, kind, kept, now)
    if store.log().where(mine).isEmpty():
        results = normalize.collect_results(kept, kind, ["key"]).join(kept.select("key", F.col("error").alias("fetch_error")), "key")
        store.record(results.select(
            F.lit(provider).alias("provider"), F.lit(None).cast("int").alias("key_index"), F.col("key").alias("symbol"), "status", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce("fetch_error", "error").alias("error"), F.lit(now).cast("timestamp").alias("at"), F.lit(seq).cast("bigint").alias("seq"),
        ))


def collect_stream(spark: SparkSession, store: Store, provider: str, kind: str, symbols: list[str], spool: str, checkpoint: str, now: str, options: dict[str, str] | None = None, first_seq: int = 1, **transports: Transport) -> StreamingQuery:
    """Start collecting a list of symbols, each of them once. Batch n has the number ``first_seq`` + n, which must be the same
    whenever the stream starts again and free of other runs' numbers. ``drain`` ends it with the list."""
    rest_stream.register(spark, **transports)
    said = {"provider": provider, "kind": kind, "symbols": json.dumps(symbols), "spool": spool} | (options or {})
    source = spark.readStream.format("rest_stream").options(**said).load()

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():  # a last batch may only bring the times of calls; answers come from the spool when they are read again
            keep_batch(store, provider, kind, batch, first_seq + number, now)

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()


def drain(query: StreamingQuery) -> None:
    """Let a stream work off what there is, and end it; what it failed with is raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
