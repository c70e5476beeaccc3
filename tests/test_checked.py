"""Batches that are checked while they are written: counts, quarantine and the stored rows of the one pass."""

import pytest
from pyspark.sql import functions as F

from tidebook.operators import validate
from tidebook.plans import queries
from tidebook.sources import store as stores
from tidebook.sources.store import Store
from tidebook.streaming import ingest

KIND = "symbol string, date string, open string, high string, low string, close string, volume string, seq int"


def bar(symbol, date, close="2", seq=1, volume="5"):
    return (symbol, date, "1", "9", "0", close, volume, seq)


def put(spark, store, rows, stamp="t"):
    return store.upsert_checked("ohlcv", spark.createDataFrame(rows, KIND), stamp, ["seq"], validate.fault())


def kept(store):
    return {(r.symbol, r.date): r.close for r in store.table("ohlcv").collect()}


def test_counts_quarantine_and_what_is_stored(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    rows = [bar("A", "1"), bar("A", "1", "3", 2), bar("A", "2", "x", 3), bar("A", "2", "7", 1), bar("A", "2", "x", 3), bar("A", "", "4"), bar("A", None, "4"), bar("B", "1", volume="-1"), bar(None, "3", "8")]
    assert put(spark, store, rows) == {"stored": 3, "duplicate_keys": 1, "no_key": 2, "faulty": 2}
    # a faulty row that comes later doesn't win over a good one of its key
    assert kept(store) == {("A", "1"): "3", ("A", "2"): "7", (None, "3"): "8"}
    assert sorted((r.symbol, r.date or "", r.outcome, r.batch) for r in store.quarantine("ohlcv").collect()) == [
        ("A", "", "no_key", 1), ("A", "", "no_key", 1), ("A", "2", "invalid_numeric_or_range", 1), ("B", "1", "invalid_numeric_or_range", 1)]
    assert put(spark, store, [bar("A", "1", "y")])["faulty"] == 1 and kept(store)[("A", "1")] == "3"  # nor over a stored one
    assert validate.checked(store.checks()).collect()[0].asDict() == {"table": "ohlcv", "status": "fail", "issue_count": 4, "no_key": 2, "stored": 3}


def test_checked_and_plain_batches_in_turn_and_merges(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    put(spark, store, [bar("A", "1", "1"), bar("B", "1", "1"), bar("C", "1", "bad")])
    store.upsert("ohlcv", spark.createDataFrame([bar("A", "1", "2")], KIND), "t", ["seq"])
    put(spark, store, [bar("B", "1", "3")])
    assert kept(store) == {("A", "1"): "2", ("B", "1"): "3"} and store._batch_numbers("ohlcv") == [1, 2, 3]
    store.merge("ohlcv")
    assert kept(store) == {("A", "1"): "2", ("B", "1"): "3"} and store._batch_numbers("ohlcv") == []
    assert store.quarantine("ohlcv").count() == 1
    # numbers of batches that have something in quarantine aren't taken again
    put(spark, store, [bar("A", "1", "4"), bar("D", "1", "bad")])
    assert store._batch_numbers("ohlcv") == [4] and sorted(r.batch for r in store.quarantine("ohlcv").collect()) == [1, 4]
    monkeypatch.setattr(stores, "MERGE_AFTER", 2)
    put(spark, store, [bar("A", "1", "5")])
    assert store._batch_numbers("ohlcv") == [] and kept(store) == {("A", "1"): "5", ("B", "1"): "3"}


def test_batches_of_no_rows_and_of_faulty_rows_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    assert store.checks().count() == store.quarantine("ohlcv").count() == 0
    assert put(spark, store, []) == {"stored": 0, "duplicate_keys": 0, "no_key": 0, "faulty": 0}
    assert put(spark, store, [bar("A", "1", "bad")]) == {"stored": 0, "duplicate_keys": 0, "no_key": 0, "faulty": 1}
    store.merge("ohlcv")
    assert kept(store) == {} and store.quarantine("ohlcv").count() == 1


def test_a_write_that_broke_off_leaves_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    put(spark, store, [bar("A", "1", "1"), bar("B", "1", "bad")])
    (tmp_path / "store/_checked/ohlcv/batch=1/_SUCCESS").unlink()
    assert kept(store) == {} and store.quarantine("ohlcv").count() == 0
    put(spark, store, [bar("A", "1", "2")])
    assert kept(store) == {("A", "1"): "2"} and store.quarantine("ohlcv").count() == 0


def test_counts_equal_the_report_of_the_same_rows(spark, tmp_path):
    rows = queries.text_bars(spark, "/root/testdata/sf0.001")
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    found = store.upsert_checked("ohlcv", rows, "t", ["date"], validate.fault())
    assert found["duplicate_keys"] + found["faulty"] == validate.issues(rows).count() > 0


def test_rows_are_limited_before_the_one_shuffle(spark, tmp_path, monkeypatch):
    """A key or faulty row that is repeated without end leaves two rows of each task; nothing is scanned for the counts."""
    store, plans = Store(spark, str(tmp_path / "store"), buckets=2), []
    rows = spark.range(40000).select(F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("symbol"), F.lit("1").alias("date"), *[F.lit("1").alias(c) for c in ("open", "high", "low", "volume")],
                                     F.when(F.col("id") % 3 == 0, "1").otherwise("bad").alias("close"), F.lit(1).alias("seq"))
    monkeypatch.setattr(type(rows), "observe", lambda df, *a, _of=type(rows).observe: plans.append(df._jdf.queryExecution().executedPlan().toString()) or _of(df, *a))
    found = store.upsert_checked("ohlcv", rows, "t", ["seq"], validate.fault())
    assert found == {"stored": 1, "duplicate_keys": 1, "no_key": 0, "faulty": 1}
    (plan,) = plans
    limits = [k for k in range(len(plan)) if plan.startswith("WindowGroupLimit", k)]
    assert plan.count("Exchange hashpartitioning") == 1 and limits[0] < plan.index("Exchange hashpartitioning") < limits[1]  # printed from the last operator to the first


@pytest.mark.parametrize("checked", [False, True])
def test_a_stream_of_payloads_checked(spark, tmp_path, checked):
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox/a.json").write_text('{"key": "A", "seq": 1, "payload": "{\\"values\\": [{\\"datetime\\": \\"2024-01-01\\", \\"open\\": \\"1\\", \\"high\\": \\"2\\", \\"low\\": \\"1\\", \\"close\\": \\"1\\", \\"volume\\": \\"3\\"}, {\\"datetime\\": \\"2024-01-02\\", \\"close\\": \\"x\\"}]}"}\n')
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    ingest.stream_payloads(spark, str(tmp_path / "inbox"), store, "bar_list", str(tmp_path / "checkpoint"), clock=lambda: "t", checked=checked).awaitTermination()
    assert store.table("ohlcv").count() == (1 if checked else 2) and store.quarantine("ohlcv").count() == checked
    assert [(r.stored, r.faulty) for r in store.checks().collect()] == [(1, 1)] * checked
