"""What a listener keeps of streams: runs that end, fail or go on, over restarts."""

import json

from tidebook.sources.store import Store
from tidebook.streaming import progress


def stream(spark, folder, checkpoint, fail=False, name=None):
    def each(batch, number):
        if fail and batch.count():
            raise ValueError("no more")
        batch.write.format("noop").mode("overwrite").save()

    source = spark.readStream.schema("a int").option("maxFilesPerTrigger", 1).json(str(folder)).writeStream.foreachBatch(each)
    source = source.queryName(name) if name else source
    query = source.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        assert fail
    return str(query.runId)


def put(folder, name, n):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"a": k}) for k in range(n)))


def test_runs_that_end_fail_and_go_on(spark, tmp_path):
    store, inbox = Store(spark, str(tmp_path / "store")), tmp_path / "inbox"
    assert progress.current(store).count() == 0
    log = progress.listen(spark, store, every=3)
    try:
        put(inbox, "a", 5), put(inbox, "b", 7)
        assert log.wait(stream(spark, inbox, tmp_path / "c1", name="first"))
        (row,) = progress.current(store).collect()
        assert (row["name"], row.runs, row.status, row.batches, row.rows, row.error) == ("first", 1, "ended", 2, 12, None)
        put(inbox, "c", 2)
        assert log.wait(stream(spark, inbox, tmp_path / "c1", fail=True, name="first"))
        (row,) = progress.current(store).collect()
        assert (row.runs, row.status, row.rows) == (2, "failed", 12) and "no more" in row.error
        assert log.wait(stream(spark, inbox, tmp_path / "c1", name="first"))
        (row,) = progress.current(store).collect()
        assert (row.runs, row.status, row.batches, row.rows, row.error) == (3, "ended", 3, 14, None)  # the batch that failed counts once
        assert log.wait(stream(spark, inbox, tmp_path / "c2"))
        assert sorted(r.runs for r in progress.current(store).collect()) == [1, 3] and log.errors == []
    finally:
        spark.streams.removeListener(log)
    stream(spark, inbox, tmp_path / "c3")
    assert progress.current(store).count() == 2  # nobody listened


def test_errors_in_writing_do_not_stop_the_stream(spark, tmp_path):
    store, inbox = Store(spark, str(tmp_path / "store")), tmp_path / "inbox"
    log = progress.listen(spark, store, every=1)
    try:
        put(inbox, "a", 4)
        (tmp_path / "store").write_text("a file where the folder should be")
        run = stream(spark, inbox, tmp_path / "c")
        assert log.wait(run) and log.errors and len(log.waiting) == 3
        (tmp_path / "store").unlink()
        assert log.wait(stream(spark, inbox, tmp_path / "c"))
        assert log.waiting == [] and [(r.runs, r.rows) for r in progress.current(store).collect()] == [(2, 4)]
    finally:
        spark.streams.removeListener(log)
