"""Columns and keys of the stored tables. All are text, as providers gave it; ``updated_at`` is set at each write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR = ("date", "open", "high", "low", "close", "volume")
INDICATORS = ("sma_20", "sma_50", "sma_200", "rsi_14", "macd_12_26", "macd_signal_9", "macd_hist")

#: table: (key, other columns)
TABLES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "ohlcv": (("symbol", "date"), BAR[1:]),
    "indicators": (("symbol", "date"), (*BAR[1:], *INDICATORS)),
    "macro": (("series_id", "date"), ("value", "realtime_start", "realtime_end")),
    "news": (("symbol", "id"), ("datetime", "date", "headline", "source", "summary", "url", "image", "category")),
}
#: What isn't data of providers but is stored by key as well: states that indicators are computed on from.
KEYED = TABLES | {"indicator_states": (("symbol", "date"), ("state",))}


def columns(table: str) -> list[str]:
    key, others = KEYED[table]
    return [*key, *others, "updated_at"]


def schema(table: str) -> T.StructType:
    key = {*KEYED[table][0], "updated_at"}
    return T.StructType([T.StructField(c, T.StringType(), c not in key) for c in columns(table)])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def with_text(df: DataFrame, table: str, more: list[Column] | None = None) -> DataFrame:
    """The table's columns, as text (those ``df`` lacks are empty), and ``more``."""
    return df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit("")).alias(c) for c in columns(table)], *(more or []))


#: Events of collection, from which statuses, budgets and runs are derived.
FETCH_LOG = T.StructType([
    T.StructField("provider", T.StringType(), False), T.StructField("key_index", T.IntegerType()), T.StructField("symbol", T.StringType(), False),
    T.StructField("status", T.StringType(), False), T.StructField("rows", T.LongType()), T.StructField("error", T.StringType()),
    T.StructField("at", T.TimestampType(), False), T.StructField("seq", T.LongType(), False),
])
#: Payloads as they came, with the days asked for where the request had any, kept before anything is made of them; or why none came. ``earlier`` is a payload that
#: said that a rate limit was reached, ``calls`` the times of the calls (seconds, a JSON list).
BRONZE = T.StructType([
    T.StructField("provider", T.StringType(), False), T.StructField("key", T.StringType(), False), T.StructField("fetched_at", T.TimestampType(), False),
    T.StructField("payload", T.StringType()), T.StructField("asked_from", T.StringType()), T.StructField("asked_to", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("earlier", T.StringType()), T.StructField("calls", T.StringType()), T.StructField("seq", T.LongType(), False),
])
#: A run as it ended.
RUNS = T.StructType([
    T.StructField("seq", T.LongType(), False), T.StructField("provider", T.StringType(), False), T.StructField("kind", T.StringType(), False),
    T.StructField("status", T.StringType(), False), T.StructField("dry_run", T.BooleanType(), False), T.StructField("force", T.BooleanType(), False),
    T.StructField("started_at", T.StringType()), T.StructField("finished_at", T.StringType()),
    T.StructField("processed", T.LongType()), T.StructField("failed", T.LongType()), T.StructField("skipped_rate_limit", T.LongType()), T.StructField("total_remaining_start", T.LongType()),
])
