"""Price bars from trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bars(trades: DataFrame, symbol: Column, date: Column, price: Column, order: list[Column]) -> DataFrame:
    """symbol, date, open, high, low, close, volume (trades) of each symbol and day; ``order`` decides first and last."""
    rows = trades.select(symbol.alias("symbol"), date.cast("date").alias("date"), price.cast("double").alias("price"), F.struct(*order).alias("at"))
    return rows.groupBy("symbol", "date").agg(
        F.min_by("price", "at").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", "at").alias("close"), F.count(F.lit(1)).cast("double").alias("volume"),
    )
