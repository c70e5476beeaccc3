"""Payloads of bounded size, and none that is lost in silence."""

from tidebook.operators import normalize
from tidebook.plans import queries

DATA = "/root/testdata/sf0.001"


def test_news_of_a_source_come_in_payloads_of_bounded_size(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    whole = sorted(map(repr, queries.normalize_news(spark, DATA).collect()))
    monkeypatch.setattr(queries, "NEWS_BYTES", 4_000)
    payloads = queries.news_payloads(docs)
    assert payloads.count() > 3 * docs.select("source").distinct().count()
    assert sorted(map(repr, queries.normalize_news(spark, DATA).collect())) == whole


def test_a_payload_that_cannot_be_read_is_its_symbols_failure(spark):
    """Of any size: no payload ends the job, and others go through."""
    payloads = spark.createDataFrame([("a", '[{"id":1,"headline":"fine"}]'), ("b", "[" + "x" * (17 << 20)), ("c", "["), ("d", None)], "key string, payload string")
    errors = {r.key: r.error for r in normalize.payload_errors(payloads, "news", ["key"]).collect()}
    assert errors == {"a": None, "b": normalize.UNREADABLE, "c": normalize.UNREADABLE, "d": normalize.UNREADABLE}
    assert [r.id for r in normalize.news(payloads, ["key"]).collect()] == ["1"]
    found = {r.key: (r.status, r.error) for r in normalize.collect_results(payloads, "news", ["key"]).collect()}
    assert found == {"a": ("done", None)} | {k: ("failed", normalize.UNREADABLE) for k in "bcd"}
