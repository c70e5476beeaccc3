"""A stream of bars, in batches of any size and with a restart in the middle, gives what the batch job gives."""

import json
import random

import pytest
from test_incremental import DAYS, alike, bars, frame, stored, whole

from tidebook.plans import refresh
from tidebook.sources.store import Store
from tidebook.streaming import live

pytestmark = pytest.mark.slow


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"symbol": s, "date": d, "open": "1", "high": "9", "low": "0", "close": c, "volume": "7", "seq": k}) for k, ((s, d), c) in enumerate(rows)]
    (folder / f"{name}.json").write_text("\n".join(lines))


def run(spark, folder, store, checkpoint, files, **options):
    source = spark.readStream.schema(live.BARS).option("maxFilesPerTrigger", files).json(str(folder))
    query = live.keep_indicators(source, store, str(checkpoint), "now", **options)
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("files", [1, 9])
def test_batches_of_any_size_and_a_restart(spark, tmp_path, files):
    days = DAYS[:60]
    rows, store, folder = sorted(bars(3, "AB", days).items(), key=lambda x: x[0][1]), Store(spark, str(tmp_path / "store"), buckets=2), tmp_path / "inbox"
    for k, (a, b) in enumerate(((0, 70), (70, 100))):
        part = rows[a:b]
        random.Random(k).shuffle(part)
        put(folder, f"f{k}", part)
    run(spark, folder, store, tmp_path / "checkpoint", files)
    # the stream ended and begins anew, with the state it had; then a correction, a day that was missing, and days behind them
    put(folder, "f8", rows[100:] + [(("A", "2022-02-01"), "1"), (("A", "2022-02-01"), "8"), (("C", DAYS[0]), "3"), (("C", ""), "4")])
    put(folder, "fa", [(("A", DAYS[30]), "55"), (("B", "2018-01-30"), "60"), (("A", "2022-02-02"), "9"), (("C", "2022-02-02"), "9")])
    run(spark, folder, store, tmp_path / "checkpoint", files)
    assert store.table("ohlcv").count() == len(rows) + 5
    alike(stored(store), whole(spark, store))


def test_states_that_expired_and_a_stream_begun_over_a_store(spark, tmp_path):
    store, folder = Store(spark, str(tmp_path / "store"), buckets=2), tmp_path / "inbox"
    refresh.upsert_bars(store, frame(spark, bars(5, "AB", DAYS[:60])), "t", ["date"])
    refresh.refresh(store, "t")
    put(folder, "f0", [(("A", DAYS[60]), "70"), (("B", DAYS[60]), "71")])
    run(spark, folder, store, tmp_path / "checkpoint", 1, ttl=1)  # begins from the store's states, which are gone a millisecond later
    alike(stored(store), whole(spark, store))
    put(folder, "f1", [(("A", DAYS[61]), "72")])
    run(spark, folder, store, tmp_path / "checkpoint", 1, ttl=1)
    alike(stored(store), whole(spark, store))
    assert store.table("ohlcv").count() == 123
