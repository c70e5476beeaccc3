"""Keyed upsert: the last write of a key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import schemas


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes last by ``order``, nothing before anything. Other columns go along.

    A window of which only the first row is wanted: each task leaves one row of a key before the shuffle, so
    a key written very often doesn't meet in one task, and rows are moved as they are.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order]))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stored rows with incoming ones put over them by key.

    Incoming rows whose last key column (date or id) is empty are dropped. Within ``incoming`` the last row by
    ``order`` wins; any incoming row wins over a stored one.
    """
    kinds = {f.name: f.dataType.simpleString() for f in incoming.schema.fields}
    ranks = [f"__{k}" for k in range(len(order))]
    # all in one shuffle: a stored row comes before any incoming one
    none = [F.lit(None).cast(kinds[c]).alias(r) for c, r in zip(order, ranks, strict=True)]
    given = [F.col(c).alias(r) for c, r in zip(order, ranks, strict=True)]
    old = stored.select(*stored.columns, F.lit(0).alias("__new"), *none)
    new = incoming.where(F.coalesce(F.col(keys[-1]), F.lit("")) != "").select(*stored.columns, F.lit(1).alias("__new"), *given)
    return last_wins(old.unionByName(new), keys, ["__new", *ranks]).select(*stored.columns)


def upsert_table(table: str, stored: DataFrame, incoming: DataFrame, now: str, order: list[str]) -> DataFrame:
    """``upsert`` for one of the stored tables; ``now`` is the batch's updated_at, ``order`` columns of ``incoming``."""
    keys = list(schemas.TABLES[table][0])
    marked = incoming.withColumn("updated_at", F.lit(now))
    ordered = schemas.with_text(marked, table, [F.col(c).alias(f"__order_{c}") for c in order])
    return upsert(schemas.with_text(stored, table), ordered, keys, [f"__order_{c}" for c in order])
