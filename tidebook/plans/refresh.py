"""Bars and their indicators kept in step: changes are marked before they are stored, and made good by a refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import schemas
from tidebook.operators import incremental
from tidebook.operators import upsert as upserts
from tidebook.sources import scratch
from tidebook.sources.store import Store

MARKED = "symbol string, " + ", ".join(f"{c} string" for c in schemas.BAR) + ", batch long"


def _folder(store: Store) -> str:
    return f"{store.root}/changed_bars"


def marks(store: Store) -> DataFrame:
    """Changed bars whose indicators aren't refreshed yet: of each key the last version."""
    return upserts.last_wins(store._read(_folder(store), MARKED), ["symbol", "date"], ["batch"]).drop("batch")


def upsert_bars(store: Store, incoming: DataFrame, now: str, order: list[str]) -> None:
    """Upsert bars and mark those that change something. A run that ends in between has marked what it may have stored."""
    keys = ["symbol", "date"]
    texts = schemas.with_text(incoming.withColumn("updated_at", F.lit(now)), "ohlcv", [F.col(c).alias(f"__order_{c}") for c in order]).where("date <> ''")
    new = upserts.last_wins(texts, keys, [f"__order_{c}" for c in order])
    stored = store.table("ohlcv").join(new.select(*keys), keys, "left_semi")
    batch = (store._read(_folder(store), MARKED).agg(F.max("batch")).first()[0] or 0) + 1
    incremental.changed_bars(stored, new).withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").parquet(_folder(store))
    store.upsert("ohlcv", incoming, now, order)


def refresh(store: Store, now: str, every: int = incremental.EVERY) -> DataFrame:
    """Compute what the marks made dirty, and upsert it with its states; the rows that were computed.

    Marks go when everything is stored: a refresh that ends before is done again by the next one.
    """
    spark, changed = store.spark, marks(store)
    states = store.table("indicator_states")
    ranges = scratch.written(incremental.dirty_ranges(changed, states), "dirty")
    bars = None if ranges.where("not appended").isEmpty() else store.table("ohlcv")
    rows = scratch.written(incremental.recompute(changed, ranges, bars, states, every), "recomputed")
    store.upsert("indicators", incremental.as_text(rows), now, ["date"])
    store.upsert("indicator_states", rows.where("state is not null").select("symbol", "date", "state"), now, ["date"])
    scratch.delete(spark, _folder(store))
    return rows
