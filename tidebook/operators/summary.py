"""Daily summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.operators import validate


def last_run(runs: DataFrame, order: list[str]) -> DataFrame:
    """The latest run and how many there are, one row."""
    return runs.agg(F.count(F.lit(1)).alias("run_count"), F.max_by(F.struct(*runs.columns), F.struct(*order)).alias("last_run"))


def daily(tables: dict[str, DataFrame], bronze: DataFrame, runs: DataFrame, order: list[str], today: str) -> DataFrame:
    """One row: date, raw_count, counts of the tables, run_count and the last run."""
    counts = validate.table_counts(tables).groupBy().pivot("table", sorted(tables)).agg(F.first("rows"))
    raw = bronze.agg((F.count("payload") if "payload" in bronze.columns else F.count(F.lit(1))).alias("raw_count"))
    return raw.crossJoin(counts).crossJoin(last_run(runs, order)).select(F.lit(today).alias("date"), "*")


def message(summary: DataFrame) -> DataFrame:
    """The summary as a line of text."""
    parts: list[Column] = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("raw_count", "ohlcv", "indicators", "macro", "news")]
    return summary.select(F.concat_ws(" ", F.concat(F.lit("summary of "), F.col("date"), F.lit(":")), *parts).alias("message"))


def progress_message(done: DataFrame) -> DataFrame:
    return done.select(F.format_string("collected %d of %d", "progress_done", "progress_total").alias("message"))
