"""Indicators for SQL, as a table function: ``SELECT * FROM indicators(TABLE(bars) PARTITION BY symbol ORDER BY date)``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from tidebook.functions import schemas, workers
from tidebook.operators.incremental import Running

OUT = "symbol string, date string, close double, " + ", ".join(f"{c} double" for c in schemas.INDICATORS)


@arrow_udtf(returnType=OUT)
class Indicators:
    """All indicators of a partition's bars (symbol, date, close, other columns are left out), in the order they come in.

    Spark makes one of these for each partition and hands over its sorted rows in Arrow batches; what stays between batches is the
    running state, however long a symbol's history. A null close is a gap, after which all begins anew; NaN is a value. Rows
    of one date come in any order, each as a bar of its own; a null symbol is a symbol. ``close`` may be any number.
    """

    def __init__(self):
        self.running = Running()

    def eval(self, bars: pa.RecordBatch) -> Iterator[pa.Table]:
        closes = pc.cast(bars.column("close"), pa.float64())
        made = [self.running.add(x) for x in closes.to_pylist()]
        values = {c: pa.array([m[k] for m in made], pa.float64()) for k, c in enumerate(schemas.INDICATORS)}
        yield pa.table({"symbol": bars.column("symbol"), "date": pc.cast(bars.column("date"), pa.string()), "close": closes, **values})


def register(spark: SparkSession) -> None:
    """Let SQL in this session call ``indicators``."""
    workers.ship(spark)
    spark.udtf.register("indicators", Indicators)
