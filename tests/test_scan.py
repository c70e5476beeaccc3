"""A scan over stretches gives what one pass gives."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidebook.operators import indicators, scan

pytestmark = pytest.mark.slow

FIRST = datetime.date(2001, 1, 1)


def history(seed, n, gaps=(), nans=(), skip=0.1):
    draw, price, out = random.Random(seed), 50.0, []
    for k in range(n):
        price *= draw.uniform(0.96, 1.042)
        if draw.random() >= skip:
            out.append((FIRST + datetime.timedelta(days=k), None if k in gaps else math.nan if k in nans else price))
    return out


@pytest.fixture(scope="module")
def bars(spark):
    hot = history(1, 4000, gaps={*range(700, 710), 1500, 2047, 2048}, nans={3300}, skip=0)
    some = {"HOT": hot, "GAPS": history(2, 600, gaps=set(range(0, 600, 9))), "SHORT": history(3, 11), "NULL": [(FIRST, None)], "NAN": history(4, 300, nans={40}, gaps={120}), "FLAT": [(d, 5.0) for d, _ in history(5, 200)]}
    rows = [(s, d, x, "kept") for s, days in some.items() for d, x in days]
    return spark.createDataFrame(rows, "symbol string, date date, close double, place string")


@pytest.mark.parametrize("days", [64, 512, 100_000])
def test_scan_equals_one_pass(bars, days):
    found = {(r.symbol, r.date): tuple(r) for r in scan.recursive(bars, (12, 50), days=days).collect()}
    expected = {(r.symbol, r.date): tuple(r) for r in indicators.recursive(bars, (12, 50)).collect()}
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        for x, y in zip(found[key], row):
            assert x == y or x is not None and y is not None and (math.isnan(x) and math.isnan(y) or abs(x - y) <= 1e-9 * max(1, abs(y))), (key, found[key], row)


def test_one_symbol_is_many_tasks_work(spark, bars, monkeypatch):
    """No task has the hot symbol's rows, and what goes through one task is a row a stretch."""
    seen = {}

    def written(rows, label):
        seen[label] = rows.where("symbol = 'HOT'").groupBy(F.spark_partition_id().alias("task")).count().collect()
        return rows

    monkeypatch.setattr(scan.scratch, "written", written)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scan.smoothed(bars.drop("place"), [scan.ema("e", "close", 12)], days=64)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(seen["scan"]) > 4 and max(r["count"] for r in seen["scan"]) < 2000


def test_nothing(spark, bars):
    assert scan.recursive(bars.limit(0)).collect() == []
