"""The table function gives what the DataFrame operator gives, over any batches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidebook.functions import schemas
from tidebook.operators import indicators, table_functions


@pytest.mark.parametrize("batch", [7, 10000])
def test_indicators_of_any_batches(spark, batch):
    r = random.Random(5)
    rows = [(s, f"20{k // 336:02d}-{k // 28 % 12 + 1:02d}-{k % 28 + 1:02d}", None if r.random() < 0.02 else math.nan if k == 300 and s == "A" else r.randrange(900) / 10) for s in ("A", "B", None, "") for k in range(330)]
    r.shuffle(rows)
    bars = spark.createDataFrame(rows, "symbol string, date string, close double")
    table_functions.register(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = spark.sql("SELECT * FROM indicators(TABLE({bars}) PARTITION BY symbol ORDER BY date)", bars=bars.withColumn("volume", F.lit("more columns"))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    keyed = {(x.symbol, x.date): x for x in found}
    wanted = indicators.all_indicators(bars).collect()
    assert len(found) == len(keyed) == len(wanted) == len(rows)
    for w in wanted:
        for c in ("close", *schemas.INDICATORS):
            a, b = keyed[w.symbol, w.date][c], w[c]
            assert (a is None) == (b is None), (w, c)
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or math.isnan(a) and math.isnan(b), (w, c)


def test_numbers_of_other_kinds_and_no_rows(spark):
    table_functions.register(spark)
    bars = spark.range(25).select(F.lit("A").alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("decimal(9,2)").alias("close"))
    call = "SELECT * FROM indicators(TABLE({bars}) PARTITION BY symbol ORDER BY date)"
    last = spark.sql(call, bars=bars).orderBy(F.desc("date")).first()
    assert (last.date, last.close, last.sma_20, last.rsi_14) == ("2024-01-25", 24.0, 14.5, 100.0)
    assert spark.sql(call, bars=bars.where("close < 0")).collect() == []
