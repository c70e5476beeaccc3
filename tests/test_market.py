"""Small cases worked out by hand, and properties."""

import json
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidebook.functions import casts, schemas
from tidebook.operators import indicators, listing, normalize, planner, upsert, validate
from tidebook.sources import config, rest, scratch
from tidebook.sources.store import Store, files


def series(spark, closes, symbol="S"):
    rows = [(symbol, f"2020-{1 + k // 28:02d}-{1 + k % 28:02d}", c) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, date string, close double")


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "date").collect()]


def test_sma_needs_consecutive_values(spark):
    closes = [float(k) for k in range(1, 24)]
    closes[21] = None
    got = column(indicators.sma(series(spark, closes), (20,)), "sma_20")
    assert got[:19] == [None] * 19 and got[19] == 10.5 and got[20] == 11.5 and got[21:] == [None, None]


def test_ema_begins_with_the_mean(spark):
    got = column(indicators.recursive(series(spark, [1.0, 2.0, 3.0, 7.0]), (3,)), "ema_3")
    assert got == [None, None, 2.0, (7.0 - 2.0) * 0.5 + 2.0]


def test_rsi(spark):
    assert column(indicators.recursive(series(spark, [5.0] * 16)), "rsi_14") == [None] * 14 + [100.0, 100.0]
    assert column(indicators.recursive(series(spark, [50.0 - k for k in range(15)])), "rsi_14")[14] == 0.0
    short = column(indicators.recursive(series(spark, [1.0] * 10 + [None] + [1.0] * 14)), "rsi_14")
    assert short == [None] * 25


def test_macd_starts(spark):
    out = indicators.recursive(series(spark, [float(k % 7) for k in range(34)]))
    macd, signal = column(out, "macd_12_26"), column(out, "macd_signal_9")
    assert macd[24] is None and macd[25] is not None and signal[32] is None and signal[33] is not None


def test_nan_is_a_value(spark):
    closes = [1.0] * 5 + [math.nan] + [1.0] * 40
    out = indicators.recursive(indicators.sma(series(spark, closes), (20,)), (12,))
    sma, ema, rsi = (column(out, c) for c in ("sma_20", "ema_12", "rsi_14"))
    assert math.isnan(sma[24]) and sma[25] == 1.0 and math.isnan(ema[45])
    assert rsi[13] is None and math.isnan(rsi[40])


def test_symbols_dont_mix(spark):
    a, b = series(spark, [1.0, 2.0, 3.0], "A"), series(spark, [10.0, 20.0, 30.0], "B")
    assert column(indicators.recursive(a.unionByName(b), (3,)), "ema_3") == [None, None, 2.0, None, None, 20.0]


def plain_ema(values, p):
    out, seed, now = [], [], None
    for v in values:
        if v is None:
            seed, now = [], None
            out.append(None)
        elif now is None:
            seed.append(v)
            now = sum(seed) / p if len(seed) == p else None
            out.append(now)
        else:
            now = (v - now) * 2 / (p + 1) + now
            out.append(now)
    return out


@given(st.lists(st.one_of(st.none(), st.floats(1, 1000)), max_size=80))
@settings(max_examples=200, deadline=None)
def test_recursive_state_is_the_plain_loop(values):
    state = indicators.Recursive((5,), 14, 12, 26, 9)
    rows = [state.add(v) for v in values]
    macd = [None if a is None or b is None else a - b for a, b in zip(plain_ema(values, 12), plain_ema(values, 26))]
    for got, want in zip(rows, zip(plain_ema(values, 5), macd, plain_ema(macd, 9))):
        for g, w in zip((got[0], got[2], got[3]), want):
            assert (g is None) == (w is None) and (g is None or math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-9))


def test_number_text(spark):
    values = [100.0, 0.0, -1e-7, None, 1.0000025, 0.0000005, 12.5, math.nan, 1e20]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    got = [r[0] for r in df.orderBy("k").select(casts.number_text(F.col("v"))).collect()]
    assert got == ["" if v is None else f"{v:.6f}".rstrip("0").rstrip(".") for v in values]
    assert got[:4] == ["100", "0", "-0", ""]


def test_texts_of_many_numbers_share_a_python_worker(spark):
    df = spark.range(3).select(*[F.col("id").cast("double").alias(c) for c in "abc"])
    texts = df.select(*[F.coalesce(casts.number_text(F.col(c)), F.lit("")).alias(c) for c in "abc"])
    assert [tuple(r) for r in texts.collect()] == [(str(k),) * 3 for k in range(3)]
    assert texts._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


@pytest.mark.parametrize(("text", "value"), [("1", 1.0), (" 1.5 ", 1.5), ("1e3", 1000.0), ("5.", 5.0), ("+5", 5.0), (".5", 0.5), ("inf", math.inf), ("-Infinity", -math.inf), ("1d", None), ("1f", None), ("", None), (".", None), ("1,000", None), ("0x10", None), ("None", None), ("--1", None)])
def test_try_double(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(casts.try_double(F.col("t"))).first()[0] == value


def payloads(spark, *texts):
    return spark.createDataFrame([(f"k{k}", t if isinstance(t, str) else json.dumps(t), k) for k, t in enumerate(texts)], "key string, payload string, seq int")


def test_member_text(spark):
    item = {"open": None, "high": True, "low": 10.10, "close": 1e5, "volume": 123456789012, "datetime": "d"}
    r = normalize.bar_list(payloads(spark, {"values": [item]}), ["key"]).first()
    assert (r.open, r.high, r.low, r.close, r.volume) == tuple(str(item[c]) for c in ("open", "high", "low", "close", "volume"))
    item = {"open": 1e16, "high": 1.5e-7, "low": 0.0001, "close": -2e22, "volume": 123456789.125, "datetime": None}
    r = normalize.bar_list(payloads(spark, {"values": [item]}), ["key"]).first()
    assert (r.open, r.high, r.low, r.close, r.volume, r.date) == tuple(str(item[c]) for c in ("open", "high", "low", "close", "volume", "datetime"))


def test_news_times(spark):
    items = [{"id": 1, "datetime": 0}, {"id": 2, "datetime": "86400"}, {"id": 3, "datetime": 1.9}, {"id": 4, "datetime": "x"}, {"id": 5}, {"datetime": 5}, 7]
    got = {r.id: (r.datetime, r.date) for r in normalize.news(payloads(spark, items), ["key"]).collect()}
    assert got == {"1": ("1970-01-01T00:00:00Z", "1970-01-01"), "2": ("1970-01-02T00:00:00Z", "1970-01-02"), "3": ("1970-01-01T00:00:01Z", "1970-01-01"), "4": ("", ""), "5": ("", ""), "": ("1970-01-01T00:00:05Z", "1970-01-01")}


def test_no_rows_fail_but_for_news(spark):
    got = {r.key: (r.status, r.rows) for r in normalize.collect_results(payloads(spark, {"values": []}, {"values": [{"datetime": "d"}]}, "no json"), "bar_list", ["key"]).collect()}
    assert got == {"k0": ("failed", 0), "k1": ("done", 1), "k2": ("failed", 0)}
    assert normalize.collect_results(payloads(spark, []), "news", ["key"]).first().status == "done"


def test_upsert_last_of_a_batch_wins_and_empty_keys_go(spark):
    stored = spark.createDataFrame([("A", "d1", "old"), ("A", "d2", "stays")], "symbol string, date string, v string")
    incoming = spark.createDataFrame([("A", "d1", "x", 1), ("A", "d1", "y", 2), ("A", "", "z", 3), ("B", "d1", "w", 4)], "symbol string, date string, v string, seq int")
    once = upsert.upsert(stored, incoming, ["symbol", "date"], ["seq"])
    assert sorted(map(tuple, once.collect())) == [("A", "d1", "y"), ("A", "d2", "stays"), ("B", "d1", "w")]
    assert sorted(map(tuple, upsert.upsert(once, incoming, ["symbol", "date"], ["seq"]).collect())) == sorted(map(tuple, once.collect()))


@given(st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from(["d1", "d2", ""]), st.integers(0, 5)), max_size=12))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_upsert_is_a_dictionary(spark, writes):
    rows = [(s, d, str(v), k) for k, (s, d, v) in enumerate(writes)]
    want = {(s, d): v for s, d, v, _ in rows if d}
    empty = spark.createDataFrame([], "symbol string, date string, v string")
    got = upsert.upsert(empty, spark.createDataFrame(rows, "symbol string, date string, v string, seq int"), ["symbol", "date"], ["seq"])
    assert {(r.symbol, r.date): r.v for r in got.collect()} == want


def test_invalid_rows(spark):
    good = ("S", "d", "1", "2", "1", "1.5", "10")
    rows = [good, ("S", "hl", "1", "1", "2", "1", "1"), ("S", "vol", "1", "2", "1", "1", "-1"), ("S", "abc", "abc", "2", "1", "1", "1"), ("S", "null", "1", None, "1", "1", "1"), ("S", "nan", "nan", "2", "1", "1", "1")]
    df = spark.createDataFrame(rows, "symbol string, date string, open string, high string, low string, close string, volume string")
    assert {r.date for r in df.where(validate.invalid()).collect()} == {"hl", "vol", "abc", "null"}
    assert validate.issues(df.unionByName(df.where("date = 'd'"))).where("type = 'duplicate_date'").first()["count"] == 2


def test_work_selection(spark):
    symbols = spark.createDataFrame([(k, s) for k, s in enumerate("DNSFXG")], "line long, symbol string")
    log = spark.createDataFrame(
        [("p", 0, "D", "done", "2024-01-01 10:00:00", 1), ("p", 0, "S", "skipped_rate_limit", "2024-01-02 10:00:00", 2), ("p", 0, "F", "failed", "2024-01-02 10:00:00", 3),
         ("p", 0, "X", "done", "2024-01-02 09:00:00", 4), ("p", 0, "G", "done", "2024-01-02 08:00:00", 5), ("p", 0, "G", "failed", "2024-01-02 11:00:00", 6), ("q", 0, "N", "done", "2024-01-02 11:00:00", 7)],
        "provider string, key_index int, symbol string, status string, at string, seq long",
    ).withColumns({"at": F.col("at").cast("timestamp"), "rows": F.lit(1).cast("long"), "error": F.lit(None).cast("string")})
    statuses = planner.latest_status(log)
    pick = lambda **k: [r.symbol for r in planner.pending(symbols, statuses, "p", "2024-01-02", 10, **k).collect()]
    assert pick() == ["F", "N", "S", "D"]  # X and G succeeded today
    assert pick(force=True) == ["F", "G", "N", "S", "D", "X"]
    assert planner.done_today(symbols, statuses, "p", "2024-01-02", 1).first().progress_done == 1
    used = {(r.provider, str(r.utc_date)): r.calls_used for r in planner.usage(log).collect()}
    assert used[("p", "2024-01-02")] == 4 and used[("p", "2024-01-01")] == 1


def test_budget(spark):
    keys = spark.createDataFrame([("p", 0, True, 25, 5, True), ("p", 1, True, 25, 5, True), ("p", 2, False, 25, 5, True)], "provider string, key_index int, has_key boolean, daily_limit long, daily_reserve long, enabled boolean")
    used = spark.createDataFrame([("p", 0, "2024-01-02", 20), ("p", 1, "2024-01-01", 9)], "provider string, key_index int, utc_date string, calls_used long").withColumn("utc_date", F.col("utc_date").cast("date"))
    slots = planner.key_slots(keys, used, "2024-01-02")
    assert [(r.remaining, r.allowed) for r in slots.orderBy("key_index").collect()] == [(0, False), (20, True), (20, False)]
    assert tuple(planner.active_key(slots).first()) == ("p", 1, 20)


def test_calls_in_window_over_slices(spark):
    draw = random.Random(1)
    at = [draw.randint(0, 20_000) for _ in range(300)] + [3599, 3600, 3659, 3660]
    df = spark.createDataFrame([(k, "a", t) for k, t in enumerate(at)], "id int, key string, s long").withColumn("at", F.timestamp_seconds("s"))
    got = {r.id: r.calls_before for r in planner.calls_in_window(df, "key", "at").collect()}
    assert got == {k: sum(1 for u in at if 0 <= t - u < 60) for k, t in enumerate(at)}


def test_days_of_news(spark):
    asked = [(None, None, None), ("2024-01-01", "2024-01-02", 5), ("", "2024-01-09", 2), ("2024-02-01", None, None), ("x", None, None), (None, "2024-13-01", None)]
    got = planner.news_days(spark.createDataFrame(asked, "from_date string, to_date string, days_back int"), "2024-01-10").collect()
    assert [(r["first"], r["last"]) for r in got if r.in_order] == [("2024-01-03", "2024-01-10"), ("2024-01-01", "2024-01-02"), ("2024-01-07", "2024-01-09")]
    assert [r.in_order for r in got] == [True] * 3 + [False] * 3


def test_places_are_counted_over_stretches(spark):
    draw = random.Random(3)
    rows = [(p, f"s{k}", draw.randint(0, 40), draw.randint(0, 3)) for k in range(200) for p in ("p", "q")]
    got = planner.running_ranks(spark.createDataFrame(rows, "provider string, symbol string, line long, priority int"), stretch=8)
    want = {(r[0], r[1]): n for p in ("p", "q") for n, r in enumerate(sorted((r for r in rows if r[0] == p), key=lambda r: (r[3], r[2], r[1])), 1)}
    assert {(r.provider, r.symbol): r.n for r in got.collect()} == want


def test_calls_of_several_providers(spark):
    lists = spark.createDataFrame([(p, k, f"s{k}", 1) for p in ("p", "q", "r", "none") for k in range(6)], "provider string, line long, symbol string, priority int")
    slots = spark.createDataFrame([("p", 0, 2, True), ("p", 1, 9, False), ("p", 2, 1, True), ("q", 0, 50, True), ("r", 0, 0, False)], "provider string, key_index int, remaining long, allowed boolean")
    limits = spark.createDataFrame([("p", 10), ("q", 3), ("r", 10)], "provider string, max_symbols long")
    got = sorted((r.provider, r.n, r.symbol, r.key_index) for r in planner.allocate(lists, slots, limits).collect())
    assert got == [("p", 1, "s0", 0), ("p", 2, "s1", 0), ("p", 3, "s2", 2), ("p", 4, "s3", None), ("q", 1, "s0", 0), ("q", 2, "s1", 0), ("q", 3, "s2", 0), ("r", 1, "s0", None)]
    assert planner.allocate(lists.limit(0), slots, limits).count() == 0


def test_merge_symbols(spark):
    one = spark.createDataFrame([(0, " aapl"), (1, "MSFT"), (2, "")], "line long, symbol string")
    two = spark.createDataFrame([(0, "msft "), (1, "zz"), (2, "AAPL"), (3, "zz")], "line long, symbol string")
    assert [r.symbol for r in listing.merge_symbols(one, two).collect()] == ["AAPL", "MSFT", "ZZ"]


def test_lines_and_providers(spark, tmp_path):
    (tmp_path / "symbols.txt").write_text("# list\nAAPL\n\n  brk/b \nAAPL\r\n#x\n")
    got = config.lines(spark, str(tmp_path / "symbols.txt")).orderBy("line").collect()
    assert [r.symbol for r in got] == ["AAPL", "brk/b", "AAPL"]
    text = "# c\nprimary:\n  enabled: true\n  api_key_env: K\n  api_key_envs: A, B,A\n  daily_limit: 800\n  daily_reserve: 100\n  base_url: https://h/x\n  outputsize: compact\n"
    p = config.provider(text, "primary")
    assert (p.usable, p.key_envs(), p.enabled, p.base_url, p.outputsize) == (700, ["A", "B"], True, "https://h/x", "compact")
    assert config.Provider("x", api_key_env="K").key_envs() == ["K"]
    with pytest.raises(ValueError, match="primary"):
        config.provider(text, "other")
    with pytest.raises(ValueError):
        config.parse_providers("key: value\n")
    assert config.keys(spark, [p], {"B": "secret"}).orderBy("key_index").select("has_key").collect() == [(False,), (True,)]


class Clock:
    """Time that passes by sleeping, a little less than was asked for."""

    def __init__(self, now=1000.0, short=0.0):
        self.now, self.short, self.slept = now, short, []

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += max(seconds - self.short, 0.25)


def test_call_times():
    free = Clock()
    calls = rest.CallTimes(0, clock=lambda: free.now, sleep=free.sleep)
    for _ in range(5):
        calls.take()
    assert not free.slept and len(calls.times) == 5
    c = Clock(short=1.0)
    calls = rest.CallTimes(2, clock=lambda: c.now, sleep=c.sleep, times=[950.0, 990.0])  # those of an earlier read count
    for _ in range(4):
        calls.take()
    assert calls.times[2] >= 1010 and len(c.slept) > 3  # a sleep that was too short is followed by another
    assert all(b - a >= 60 for a, b in zip(calls.times, calls.times[2:]))


def test_retries():
    tries, slept = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 2:
            raise OSError("down")
        return "ok"

    calls = rest.CallTimes(0)
    assert rest.fetch(flaky, rest.schedule(2, 2.0), calls, sleep=slept.append) == "ok" and slept == [2.0] and len(calls.times) == 2
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        rest.fetch(lambda: 1 / 0, rest.schedule(2, 2.0), calls, sleep=slept.append)
    with pytest.raises(ValueError):
        rest.schedule(0, 1.0)
    said = '{"status":"error","message":"Rate limit reached"}'
    answers, paused = iter([said, '{"values":[]}']), []
    assert rest.asked_again(lambda: next(answers), paused.append) == ('{"values":[]}', said) and paused == [60]
    bad = '{"status":"error","message":"bad symbol"}'
    assert rest.asked_again(lambda: bad, paused.append) == (bad, None) and paused == [60]


def test_source_archive_and_store(spark, tmp_path):
    folder = tmp_path / "kept"
    folder.mkdir()
    (folder / "A.json").write_text(json.dumps({"values": [{"datetime": "2026-05-13", "open": "10.00", "high": "11.00", "low": "9.50", "close": "10.50", "volume": "12345"}]}))
    (folder / "B_C.json").write_text('{"status":"error","message":"bad symbol"}')
    rest.register(spark)
    read = spark.read.format("rest_payloads").option("provider", "primary").option("kind", "bar_list").option("folder", f"file://{folder}").option("symbols", json.dumps(["A", "B/C", "missing"])).load()
    got = {r.key: r for r in read.collect()}
    assert got["missing"].payload is None and "No such file" in got["missing"].error and got["A"].error is None
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    assert store.table("ohlcv").count() == 0 and store.log().count() == 0 and store.bronze().count() == 0
    store.archive(read.select("provider", "key", F.current_timestamp().alias("fetched_at"), "payload", F.lit(1).cast("long").alias("seq")))
    rows = normalize.bar_list(store.bronze(), ["key", "seq"]).withColumnRenamed("key", "symbol")
    for stamp in ("2026-05-14T00:00:00Z", "2026-05-15T00:00:00Z"):
        store.upsert("ohlcv", rows, stamp, ["seq", "date", "pos"])
        assert [tuple(r) for r in store.table("ohlcv").collect()] == [("A", "2026-05-13", "10.00", "11.00", "9.50", "10.50", "12345", stamp)]
    assert [tuple(r) for r in store.history("A").collect()] == [("2026-05-13", "10.00", "11.00", "9.50", "10.50", "12345")]
    store.upsert("indicators", indicators.indicator_rows(store.table("ohlcv")), "u", ["date"])
    r = store.table("indicators").first()
    assert (r.close, r.sma_20, r.macd_hist) == ("10.50", "", "")
    assert files(spark, str(folder)).count() == 2
    events = spark.createDataFrame([("p", 0, "A", "done", 1, None, 1)], "provider string, key_index int, symbol string, status string, rows long, error string, seq long").withColumn("at", F.current_timestamp())
    store.record(events)
    assert store.log().count() == 1


def test_addresses():
    assert rest.url("bar_list", "https://h/t", "A B", "k", {}) == "https://h/t?symbol=A+B&interval=1day&outputsize=5000&apikey=k"
    assert "file_type=json&sort_order=asc" in rest.url("macro", "https://h/t", "CPI", "k", {})


def test_stream(spark, tmp_path):
    from tidebook.streaming.ingest import stream_payloads

    inbox, store = tmp_path / "inbox", Store(spark, str(tmp_path / "store"), buckets=4)
    inbox.mkdir()

    def put(name, key, seq, close):
        payload = json.dumps({"values": [{"datetime": "2024-01-02", "close": close}, {"datetime": "2024-01-01", "close": "1"}]})
        (inbox / name).write_text(json.dumps({"key": key, "payload": payload, "seq": seq}) + "\n")

    def run():
        q = stream_payloads(spark, str(inbox), store, "bar_list", str(tmp_path / "checkpoint"), clock=lambda: "now")
        q.awaitTermination()
        return sorted((r.symbol, r.date, r.close) for r in store.table("ohlcv").collect())

    put("1.json", "A", 1, "5")
    assert run() == [("A", "2024-01-01", "1"), ("A", "2024-01-02", "5")]
    put("2.json", "A", 2, "6")
    put("3.json", "B", 3, "7")
    assert run() == [("A", "2024-01-01", "1"), ("A", "2024-01-02", "6"), ("B", "2024-01-01", "1"), ("B", "2024-01-02", "7")]
    assert run() == [("A", "2024-01-01", "1"), ("A", "2024-01-02", "6"), ("B", "2024-01-01", "1"), ("B", "2024-01-02", "7")]


def test_schemas():
    assert schemas.columns("news")[:2] == ["symbol", "id"] and schemas.columns("news")[-1] == "updated_at"


def test_a_merge_touches_its_buckets_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=8)
    rows, one = [(f"S{k}", "2024-01-01", str(k)) for k in range(40)], "symbol string, date string, close string"
    store.upsert("ohlcv", spark.createDataFrame(rows, one), "one", ["date"])
    assert store.table("ohlcv").count() == 40 and not (tmp_path / "store/ohlcv").exists()  # an upsert writes its batch and no more
    store.merge("ohlcv")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store/ohlcv").rglob("*.parquet")}
    assert len({p.parent for p in before}) == 8
    store.upsert("ohlcv", spark.createDataFrame([("S3", "2024-01-01", "x"), ("S3", "", "y")], one), "two", ["date"])
    for _ in range(2):  # with the batch beside the buckets, and merged
        found = {r.symbol: (r.close, r.updated_at) for r in store.table("ohlcv").collect()}
        assert found == {s: ("x", "two") if s == "S3" else (c, "one") for s, _, c in rows} and store.table("ohlcv").count() == 40
        assert [r.close for r in store.history("S7").collect()] == ["7"] and [r.close for r in store.history("S3").collect()] == ["x"] and store.history("none").count() == 0
        store.merge("ohlcv")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "store/ohlcv").rglob("*.parquet")}
    assert len({p.parent for p in before.items() ^ after.items() for p in [p[0]]}) == 1


def test_merges_and_batches_that_broke_off_are_made_good(spark, tmp_path, monkeypatch):
    store, one = Store(spark, str(tmp_path / "store"), buckets=4), "symbol string, date string, close string"
    closes = lambda: {r.symbol: r.close for r in store.table("ohlcv").collect()}
    store.upsert("ohlcv", spark.createDataFrame([("A", "d", "1")], one), "one", ["date"])
    store.merge("ohlcv")
    store.upsert("ohlcv", spark.createDataFrame([("A", "d", "2")], one), "two", ["date"])
    put = Store._put
    monkeypatch.setattr(Store, "_put", lambda self, name: None)
    monkeypatch.setattr(scratch, "delete", lambda spark, path: None)
    store.merge("ohlcv")  # staged, not put in its place, and the batch is still there
    monkeypatch.undo()
    assert Store._put is put and closes() == {"A": "2"}
    store.upsert("ohlcv", spark.createDataFrame([("A", "d", "4"), ("B", "d", "3")], one), "three", ["date"])
    (tmp_path / "store/_batches/ohlcv/batch=9").mkdir()  # a write that broke off has no mark
    assert closes() == {"A": "4", "B": "3"}
    store.merge("ohlcv")
    assert closes() == {"A": "4", "B": "3"} and not store._batch_numbers("ohlcv")


def test_members_are_judged_by_type(spark):
    texts = [("0", "0"), ("None", "None"), ("False", "False"), ("", None), (0, None), (False, None), (None, None), ([], None), ({}, None), ([1], "[1]"), (7, "7"), (0.0, None), (True, "True")]
    got = [r.error for r in normalize.payload_errors(payloads(spark, *({"message": m} for m, _ in texts)), "bar_list", ["seq"]).orderBy("seq").collect()]
    assert got == [want or "missing values" for _, want in texts]


def test_of_repeated_names_the_last_counts(spark):
    r = normalize.bar_list(payloads(spark, '{"values":[],"values":[{"datetime":"d","open":"1","open":"2"}]}'), ["key"]).first()
    assert (r.date, r.open) == ("d", "2")


def test_archive_names(spark):
    df = spark.createDataFrame([("BRK/B", "2024-01-02T03:04:05Z")], "s string, t string")
    assert df.select(casts.archive_name(F.col("s"), F.col("t"))).first()[0] == "BRK_B_20240102T030405Z.json"


def test_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    from tidebook.sources import scratch

    monkeypatch.setattr(scratch, "is_local", lambda s: False)
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default)))
