"""Symbol lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import casts


def merge_symbols(existing: DataFrame, fetched: DataFrame) -> DataFrame:
    """line, symbol: normalized symbols of both lists (line, symbol), each once, in order of their first place.

    ``line`` of the result are the old places, fetched ones behind existing ones; it orders rows and may have gaps.
    """
    first = existing.select(F.lit(0).alias("list"), "line", casts.normal_symbol(F.col("symbol")).alias("symbol"))
    second = fetched.select(F.lit(1).alias("list"), "line", casts.normal_symbol(F.col("symbol")).alias("symbol"))
    both = first.unionByName(second).where("symbol <> ''")
    return both.groupBy("symbol").agg(F.min(F.struct("list", "line")).alias("at")).select(
        F.col("at.list").alias("list"), F.col("at.line").alias("line"), "symbol"
    ).orderBy("list", "line")
