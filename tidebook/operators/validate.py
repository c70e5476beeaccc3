"""Integrity checks of stored bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import casts, schemas


def invalid() -> Column:
    """Whether a bar has a field that is no number, a high below its low, or a negative volume."""
    value = {c: casts.try_double(F.col(c)) for c in schemas.BAR[1:]}
    out = F.coalesce(value["high"] < value["low"], F.lit(False)) | F.coalesce(value["volume"] < 0, F.lit(False))
    for v in value.values():
        out = out | v.isNull()
    return out


def fault() -> Column:
    """What is wrong with a bar by itself, null if nothing is: for ``Store.upsert_checked``."""
    return F.when(invalid(), F.lit("invalid_numeric_or_range"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``count``."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def issues(ohlcv: DataFrame) -> DataFrame:
    """dataset, type, symbol, date and count (null but for duplicates) of every issue."""
    twice = duplicate_keys(ohlcv, ["symbol", "date"]).select(F.lit("duplicate_date").alias("type"), "symbol", "date", "count")
    wrong = ohlcv.where(invalid()).select(F.lit("invalid_numeric_or_range").alias("type"), "symbol", "date", F.lit(None).cast("bigint").alias("count"))
    return twice.unionByName(wrong).select(F.lit("ohlcv").alias("dataset"), "type", "symbol", "date", "count")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table and rows of each."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: status (pass or fail), issue_count and the tables' counts."""
    found = issues(tables["ohlcv"]).agg(F.count(F.lit(1)).alias("issue_count"))
    counts = table_counts(tables).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("table", "rows")))).alias("checked_tables"))
    return found.crossJoin(counts).select(F.when(F.col("issue_count") == 0, "pass").otherwise("fail").alias("status"), "issue_count", "checked_tables")


def checked(checks: DataFrame) -> DataFrame:
    """status, issue_count and rows stored of each table, from what was counted while its batches were written; no table is read."""
    counted = checks.groupBy("table").agg(F.sum(F.col("duplicate_keys") + F.col("faulty")).alias("issue_count"), F.sum("no_key").alias("no_key"), F.sum("stored").alias("stored"))
    return counted.select("table", F.when(F.col("issue_count") == 0, "pass").otherwise("fail").alias("status"), "issue_count", "no_key", "stored")
