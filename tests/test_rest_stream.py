"""A provider's list as a stream, and payload files written in two phases."""

import json
import time

import pytest

from tidebook.sources import payload_files, rest_stream
from tidebook.sources.store import Store, files
from tidebook.streaming import collecting

QUICK = {"transport": "fake", "backoff": "0", "pause": "0", "symbolsPerBatch": "3", "symbolsPerTask": "3"}


def provider(folder, broken=None):
    """A provider that writes down each call; it stops the process that asks for ``broken``."""

    def fake(kind, symbol, options):
        import os
        import time
        import uuid

        if symbol == broken:
            raise SystemExit("gone")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{symbol} {time.time()}")
        if symbol == "bad":
            raise OSError("no route")
        assert os.getpid()
        return '{"values":[{"datetime":"2024-01-01","close":"%s"}]}' % symbol

    return fake


def calls(folder):
    return sorted((p.read_text().split() for p in folder.iterdir()), key=lambda x: float(x[1]))


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def called(tmp_path):
    made = tmp_path / "called"
    made.mkdir()
    return made


def collect(spark, tmp_path, store, symbols, fake, checkpoint="checkpoint", **options):
    query = collecting.collect_stream(spark, store, "primary", "bar_list", symbols, f"file://{tmp_path}/spool", str(tmp_path / checkpoint), "2024-01-02 00:00:00", QUICK | options, fake=fake)
    collecting.drain(query)


@pytest.mark.slow
def test_batches_failures_and_a_longer_list(spark, tmp_path, called):
    store, fake = Store(spark, str(tmp_path / "store"), buckets=2), provider(called)
    symbols = ["a", "b", "bad", "c", "d"]
    collect(spark, tmp_path, store, symbols, fake, attempts="1")
    assert [s for s, _ in calls(called)] == symbols  # of two batches, in turn
    assert {r.symbol: (r.status, r.seq) for r in store.log().collect()} == {"a": ("done", 1), "b": ("done", 1), "bad": ("failed", 1), "c": ("done", 2), "d": ("done", 2)}
    assert "no route" in store.log().where("symbol = 'bad'").first().error
    assert store.table("ohlcv").count() == 4 and store.bronze().count() == 5
    collect(spark, tmp_path, store, [*symbols, "e"], fake)
    assert [s for s, _ in calls(called)] == [*symbols, "e"] and store.table("ohlcv").count() == 5
    collect(spark, tmp_path, store, [*symbols, "e"], fake, checkpoint="another")  # the spool's mark is where a new stream begins
    assert len(calls(called)) == 6 and store.bronze().count() == 6


@pytest.mark.slow
def test_a_restart_asks_for_nothing_twice(spark, tmp_path, called):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    with pytest.raises(Exception, match=r"gone|SystemExit|FAILED|failed|exited"):
        collect(spark, tmp_path, store, list("abcdefg"), provider(called, broken="e"))
    assert [s for s, _ in calls(called)] == list("abcd")  # the second batch broke off behind its first symbol
    assert store.bronze().count() == 3
    collect(spark, tmp_path, store, list("abcdefg"), provider(called))
    assert [s for s, _ in calls(called)] == list("abcdefg")
    assert sorted(r.key for r in store.bronze().collect()) == list("abcdefg") and store.table("ohlcv").count() == 7
    assert {r.symbol: r.seq for r in store.log().collect()} == dict(zip("abcdefg", (1, 1, 1, 2, 2, 2, 3), strict=True))


@pytest.mark.slow
def test_the_rate_holds_over_batches_and_restarts(spark, tmp_path, called):
    store, rate = Store(spark, str(tmp_path / "store"), buckets=2), {"perMinute": "2", "windowSeconds": "3", "symbolsPerBatch": "1"}
    collect(spark, tmp_path, store, list("abc"), provider(called), **rate)
    collect(spark, tmp_path, store, list("abcde"), provider(called), **rate)
    at = [float(t) for _, t in calls(called)]
    assert len(at) == 5 and all(b - a >= 2.9 for a, b in zip(at, at[2:], strict=False))
    mark = rest_stream.Spool(f"file://{tmp_path}/spool", 2).now()
    assert mark["place"] == 5 and len(mark["calls"]) == 2


def test_answers_are_kept_until_their_batch_is_committed(tmp_path):
    asked = []

    def fake(kind, symbol, options):
        asked.append(symbol)
        return symbol

    options = {"transport": "fake", "symbols": json.dumps(list("abcd")), "spool": f"file://{tmp_path}/spool", "symbolsperbatch": "2", "perminute": "9", "kind": "macro"}
    reader = rest_stream.PayloadStream(options, {"fake": fake})
    start = reader.initialOffset()
    assert start == {"place": 0, "calls": "[]"}
    end = reader.latestOffset()
    first = [list(reader.read(p)) for p in reader.partitions(start, end)]
    assert [list(reader.read(p)) for p in reader.partitions(start, end)] == first and asked == ["a", "b"]
    again = rest_stream.PayloadStream(options, {"fake": fake})  # before the commit, as after a restart
    later = again.latestOffset()
    assert later["place"] == 4 and len(json.loads(later["calls"])) == 2 and json.loads(later["calls"])[-1] <= time.time()
    again.commit(end)
    again.commit(end)
    assert again._spool().places() == [] and again.latestOffset() == later
    assert reader.partitions(end, end) == []
    assert [r[1] for p in again.partitions(end, later) for r in again.read(p)] == ["c", "d"]
    last = again.latestOffset()
    assert last["place"] == 4 and again.partitions(later, last) == []
    again.commit(last)
    assert again.latestOffset() == last  # so no batch follows


def test_an_empty_list(tmp_path):
    reader = rest_stream.PayloadStream({"transport": "fake", "symbols": "[]", "spool": f"file://{tmp_path}/spool"}, {"fake": None})
    assert reader.latestOffset() == reader.initialOffset()


# --- files by name --------------------------------------------------------------


def put(rows, folder):
    rows.write.format("payload_files").option("folder", f"file://{folder}").mode("append").save()


def test_files_by_name(spark, tmp_path):
    payload_files.register(spark)
    rows = spark.createDataFrame([(f"s/{k}.json", f"é{k}" if k else None) for k in range(40)], "name string, payload string")
    put(rows.repartition(4), tmp_path / "out")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_file()) == sorted(f"s_{k}.json" for k in range(40))
    assert (tmp_path / "out/s_7.json").read_text() == "é7" and (tmp_path / "out/s_0.json").read_text() == ""
    put(spark.createDataFrame([("s/7.json", "new")], rows.schema), tmp_path / "out")
    assert (tmp_path / "out/s_7.json").read_text() == "new" and len(list((tmp_path / "out").glob("*.json"))) == 40
    found = {r.path.rsplit("/", 1)[1]: r.length for r in files(spark, str(tmp_path / "out")).collect()}
    assert found.pop("s_0.json", 0) == 0 and len(found) == 39 and found["s_7.json"] == 3
    put(rows.limit(0), tmp_path / "out")
    assert not list((tmp_path / "out/_temporary").iterdir())


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    payload_files.register(spark)
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, payload string")
    put(rows, tmp_path / "out")
    for bad in (None, "", "_hidden", ".hidden"):
        more = spark.createDataFrame([(f"n{k}", "x") for k in range(50)] + [(bad, "x")], rows.schema)
        with pytest.raises(Exception, match="no name"):
            put(more.repartition(3), tmp_path / "out")
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a", "b"]
    assert files(spark, str(tmp_path / "out"), "*").count() == 2


def test_attempts_that_no_message_tells_of(tmp_path):
    writer = payload_files.PayloadWriter(f"file://{tmp_path}")
    kept = writer.write(iter([{"name": "a", "payload": "1"}]))
    writer.write(iter([{"name": "a", "payload": "other attempt"}]))
    writer.commit([kept, None])
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == ["a"] and (tmp_path / "a").read_text() == "1"
    lost = payload_files.PayloadWriter(f"file://{tmp_path}")
    lost.write(iter([{"name": "b", "payload": "1"}]))
    lost.abort([None])
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == ["a"]
