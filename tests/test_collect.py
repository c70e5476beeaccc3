"""A run from the list of symbols to the summary."""

import json

import pytest

from tidebook.plans import collect
from tidebook.sources.config import Provider
from tidebook.sources.lock import LockHeld, RunLock
from tidebook.sources.store import Store


def test_runs(spark, tmp_path):
    folder = tmp_path / "kept"
    folder.mkdir()

    def bars(close):
        return json.dumps({"values": [{"datetime": f"2024-01-{d:02d}", "open": "1", "high": "9", "low": "1", "close": close, "volume": "5"} for d in (2, 1)]})

    (folder / "A.json").write_text(bars("5"))
    (folder / "B_X.json").write_text('{"status":"error","message":"bad symbol"}')
    (folder / "D.json").write_text(bars("7"))
    symbols = spark.createDataFrame([(k, s) for k, s in enumerate(["A", "B/X", "C", "D", "E"])], "line long, symbol string")
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(Provider("primary", enabled=True, daily_limit=4, daily_reserve=1, max_symbols_per_run=10), "bar_list", "2024-01-03", "2024-01-03 22:30:00", {"folder": f"file://{folder}", "backoff": "0"})
    got = {r.symbol: (r.status, r.rows, r.error) for r in collect.collect(spark, store, symbols, run).collect()}
    assert got["A"] == ("done", 2, None) and got["B/X"] == ("failed", 0, "bad symbol") and got["C"][0] == "failed"
    assert got["D"][0] == "skipped_rate_limit" and "E" not in got  # three calls, the first without one is recorded
    assert "No such file" in got["C"][2] and got["D"][2] == collect.EXHAUSTED
    assert store.bronze().count() == 3 and store.bronze().where("payload is not null").count() == 2 and store.table("ohlcv").count() == 2
    later = collect.Run(run.provider, run.kind, "2024-01-04", "2024-01-04 22:30:00", run.options, max_symbols=3)
    assert [r.symbol for r in collect.plan(spark, store, symbols, later).orderBy("priority", "line").collect()] == ["B/X", "C", "E"]
    got = {r.symbol: r.status for r in collect.collect(spark, store, symbols, later).collect()}
    assert got == {"B/X": "failed", "C": "failed", "E": "failed"}
    off = collect.Run(Provider("primary", enabled=False, daily_limit=9), run.kind, "2024-01-05", "2024-01-05 00:00:00", run.options, max_symbols=3)
    assert {r.status for r in collect.collect(spark, store, symbols, off).collect()} == {"skipped_rate_limit"}
    collect.refresh_indicators(store, "now")
    assert store.table("indicators").count() == 2
    assert collect.report(store).first().status == "pass"
    s = collect.daily_summary(store, "2024-01-05").first()
    assert (s.raw_count, s.ohlcv, s.indicators, s.run_count, s.last_run.skipped_rate_limit, s.last_run.status) == (3, 2, 2, 3, 1, collect.EXHAUSTED)
    assert [(r.processed, r.failed, r.skipped_rate_limit, r.total_remaining_start) for r in store.runs().orderBy("seq").collect()] == [(1, 2, 1, 3), (0, 3, 0, 3), (0, 0, 1, 9)]
    kept = spark.read.json(str(tmp_path / "store/documents/daily/2024-01-05")).first()
    assert (kept.raw_count, kept.date) == (3, "2024-01-05") and spark.read.json(str(tmp_path / "store/documents/validation/latest")).first().status == "pass"


PRIMARY = Provider("primary", enabled=True, daily_limit=100, max_symbols_per_run=50)
QUICK = {"transport": "fake", "backoff": "0", "pause": "0"}


def listed(spark, *symbols):
    return spark.createDataFrame(list(enumerate(symbols)), "line long, symbol string")


def test_calls_are_repeated_and_kept_within_the_rate(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fake(kind, symbol, options):
        import time

        with open(f"{calls}/{symbol}", "a") as f:
            f.write(f"{time.time()}\n")
        n = len(open(f"{calls}/{symbol}").readlines())
        if symbol == "FLAKY" and n == 1 or symbol == "DOWN":
            raise OSError("no route")
        if symbol == "BUSY" and n == 1:
            return '{"status":"error","message":"Rate limit reached"}'
        if symbol == "BAD":
            return '{"status":"error","message":"bad symbol"}'
        return json.dumps({"values": [{"datetime": "2024-01-02", "close": "5"}]})

    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(Provider("primary", enabled=True, daily_limit=100, max_symbols_per_run=50, per_minute_limit=3), "bar_list", "2024-01-03", "2024-01-03 22:30:00", QUICK | {"windowSeconds": "6"}, transports={"fake": fake}, symbols_at_once=2)
    got = {r.symbol: (r.status, r.error) for r in collect.collect(spark, store, listed(spark, "FINE", "FLAKY", "DOWN", "BUSY", "BAD"), run).collect()}
    assert {s: x for s, (x, _) in got.items()} == {"FINE": "done", "FLAKY": "done", "DOWN": "failed", "BUSY": "done", "BAD": "failed"}
    assert "no route" in got["DOWN"][1] and got["BAD"][1] == "bad symbol"
    made = {p.name: [float(x) for x in p.read_text().split()] for p in calls.iterdir()}
    assert {s: len(x) for s, x in made.items()} == {"FINE": 1, "FLAKY": 2, "DOWN": 2, "BUSY": 2, "BAD": 1}
    times = sorted(t for x in made.values() for t in x)
    assert all(b - a > 5.99 for a, b in zip(times, times[3:]))  # never over three in six seconds, over all batches of the run
    kept = {r.key: r for r in store.bronze().collect()}
    assert "Rate limit" in kept["BUSY"].earlier and len(json.loads(kept["BUSY"].calls)) == 2 and kept["FINE"].earlier is None
    assert store.table("ohlcv").count() == 3


def test_a_run_that_breaks_off_keeps_what_it_did(spark, tmp_path, monkeypatch):
    def fake(kind, symbol, options):
        return json.dumps({"values": [{"datetime": "2024-01-02", "close": symbol[1:]}]})

    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(PRIMARY, "bar_list", "2024-01-03", "2024-01-03 22:30:00", QUICK, transports={"fake": fake}, symbols_at_once=2)
    symbols, some = listed(spark, "S1", "S2", "S3", "S4", "S5"), collect._collect_some

    def breaks(spark, store, run, seq, names, key):
        if "S3" in names:
            raise KeyboardInterrupt
        return some(spark, store, run, seq, names, key)

    monkeypatch.setattr(collect, "_collect_some", breaks)
    with pytest.raises(KeyboardInterrupt):
        collect.collect(spark, store, symbols, run)
    assert sorted(r.symbol for r in store.log().collect()) == ["S1", "S2"] and store.runs().count() == 0
    monkeypatch.setattr(collect, "_collect_some", some)
    assert sorted(r.symbol for r in collect.collect(spark, store, symbols, run).collect()) == ["S3", "S4", "S5"]
    assert sorted(r.close for r in store.table("ohlcv").collect()) == ["1", "2", "3", "4", "5"]


def test_a_break_between_archive_and_record(spark, tmp_path, monkeypatch):
    """What the run before archived keeps its number to itself, and nothing is counted twice."""
    def fake(kind, symbol, options):
        return json.dumps({"values": [{"datetime": "2024-01-02", "close": "1"}]})

    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(PRIMARY, "bar_list", "2024-01-03", "2024-01-03 22:30:00", QUICK, transports={"fake": fake}, clock=lambda: "2024-01-03 22:47:00")
    record = Store.record

    def breaks(self, events):
        raise KeyboardInterrupt

    monkeypatch.setattr(Store, "record", breaks)
    with pytest.raises(KeyboardInterrupt):
        collect.collect(spark, store, listed(spark, "S1", "S2"), run)
    monkeypatch.setattr(Store, "record", record)
    assert store.bronze().count() == 2 and store.log().count() == 0
    got = [tuple(r) for r in collect.collect(spark, store, listed(spark, "S1", "S2", "S1"), run).orderBy("symbol").collect()]
    assert got == [("S1", "done", 1, None), ("S2", "done", 1, None)]
    assert {r.seq for r in store.bronze().collect()} == {1, 2} and store.log().count() == 2
    assert [(r.seq, r.processed, r.started_at, r.finished_at) for r in store.runs().collect()] == [(2, 2, "2024-01-03 22:30:00", "2024-01-03 22:47:00")]


def test_listings_become_the_list_of_symbols(spark, tmp_path):
    from tidebook.sources import config

    def fake(kind, symbol, options):
        assert kind == "listing"
        return json.dumps({"data": [{"symbol": s} for s in ("zz", " aa", "0", "", None)] + [7]}) if symbol == "ONE" else '{"status":"error","code":401}'

    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(PRIMARY, "listing", "2024-01-03", "2024-01-03 22:30:00", QUICK, transports={"fake": fake})
    path = str(tmp_path / "symbols")
    assert [r.symbol for r in collect.listed_symbols(spark, store, ["ONE", "TWO"], run, path=path).orderBy("line").collect()] == ["0", "AA", "ZZ"]
    assert {r.symbol: (r.status, r.error) for r in store.log().collect()} == {"ONE": ("done", None), "TWO": ("failed", "401")}
    kept = config.lines(spark, path)
    assert [r.symbol for r in kept.orderBy("line").collect()] == ["0", "AA", "ZZ"]
    later = collect.Run(PRIMARY, "listing", "2024-01-04", "2024-01-04 22:30:00", QUICK, transports={"fake": fake})
    merged = collect.listed_symbols(spark, store, ["ONE"], later, existing=listed(spark, "mm", "zz"))
    assert [r.symbol for r in merged.orderBy("line").collect()] == ["MM", "ZZ", "0", "AA"]


def test_news_keep_the_days_asked_for(spark, tmp_path):
    from tidebook.operators import normalize

    def fake(kind, symbol, options):
        return json.dumps([{"id": 1, "datetime": 0, "headline": options["from"] + ".." + options["to"]}])

    store = Store(spark, str(tmp_path / "store"), buckets=4)
    run = collect.Run(PRIMARY, "news", "2024-01-10", "2024-01-10 22:30:00", QUICK, transports={"fake": fake})
    collect.collect(spark, store, listed(spark, "A"), run)
    assert store.table("news").first().headline == "2024-01-03..2024-01-10"
    kept = json.loads(normalize.news_envelopes(store.bronze()).first().envelope)
    assert (kept["symbol"], kept["from"], kept["to"], kept["items"][0]["id"]) == ("A", "2024-01-03", "2024-01-10", 1)


def test_http_asks_the_provider(monkeypatch):
    import io

    from tidebook.sources import rest

    asked = []
    monkeypatch.setattr(rest, "urlopen", lambda request, timeout: asked.append((request.full_url, timeout)) or io.BytesIO(b"{}"))
    monkeypatch.setenv("A_KEY", "secret")
    assert rest.http("macro", "CPI", {"base": "https://h/x", "keyenv": "A_KEY"}) == "{}"
    assert asked == [("https://h/x?series_id=CPI&api_key=secret&file_type=json&sort_order=asc", 30.0)]


def test_lock(tmp_path):
    with RunLock(tmp_path / "l"):
        with pytest.raises(LockHeld):
            RunLock(tmp_path / "l").__enter__()
    with RunLock(tmp_path / "l"):
        pass
