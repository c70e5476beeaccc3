"""Stored tables under a folder: keyed tables in buckets of their key, and append-only logs, all as plain Parquet.

A keyed table is partitioned by ``bucket``, a hash of its key. An upsert appends its batch and no more; readers take
a batch's rows over those of the buckets and of earlier batches. Now and then, and at the end of a run, batches are merged into the
buckets that they touch, by Spark's dynamic partition overwrite; others aren't read or written.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidebook.functions import schemas
from tidebook.operators import upsert as upserts
from tidebook.sources import scratch

#: Buckets of a keyed table, fixed once a store is written to: about a GB each, of some hundred GB.
BUCKETS = 256
#: Batches of a table that are kept beside its buckets before they are merged into them.
MERGE_AFTER = 16
#: Outcomes of a checked batch's rows, beside the faults that a check names.
STORED, NO_KEY = "stored", "no_key"
CHECKS = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("batch", T.IntegerType()), T.StructField("at", T.StringType()),
    *(T.StructField(c, T.LongType()) for c in ("stored", "duplicate_keys", NO_KEY, "faulty")),
])


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # tables with keys

    def _bucket(self, name: str) -> Column:
        """A symbol's rows lie together, but for news, of which a symbol may have any number."""
        key = schemas.KEYED[name][0]
        return F.pmod(F.xxhash64(*(key if name == "news" else key[:1])), F.lit(self.buckets)).cast("int")

    def _with_buckets(self, name: str) -> DataFrame:
        return self._read(f"{self.root}/{name}", T.StructType([*schemas.schema(name).fields, T.StructField("bucket", T.IntegerType())]))

    def _batch_paths(self, name: str) -> dict[int, str]:
        """Where batches that aren't merged are, by number. One whose write broke off has none of Spark's marks."""
        found = {}
        for kind in ("_batches", "_checked"):
            at = f"{self.root}/{kind}/{name}"
            for n in self._whole(at):
                path = f"{at}/batch={n}" + (f"/outcome={STORED}" if kind == "_checked" else "")
                if kind == "_batches" or scratch.exists(self.spark, path):  # of a checked batch that was merged only what is in quarantine is left
                    found[n] = path
        return dict(sorted(found.items()))

    def _batch_numbers(self, name: str) -> list[int]:
        return list(self._batch_paths(name))

    def _whole(self, at: str) -> list[int]:
        return [int(x.removeprefix("batch=")) for x in scratch.names(self.spark, at) if scratch.exists(self.spark, f"{at}/{x}/_SUCCESS")]

    def _next_batch(self, name: str) -> int:
        return 1 + max([0, *self._whole(f"{self.root}/_batches/{name}"), *self._whole(f"{self.root}/_checked/{name}")])

    def _batches(self, name: str) -> DataFrame | None:
        """Rows of the batches that aren't merged, the last of each key; None if there are none."""
        paths, kind = self._batch_paths(name), T.StructType([*self._with_buckets(name).schema.fields, T.StructField("batch", T.IntegerType())])
        parts = []
        for at in (f"{self.root}/_batches/{name}", f"{self.root}/_checked/{name}"):
            if some := [p for p in paths.values() if p.startswith(f"{at}/")]:
                parts.append(self.spark.read.schema(kind).option("basePath", at).parquet(*some).select(*kind.names))
        if not parts:
            return None
        rows = functools.reduce(DataFrame.unionByName, parts)
        if len(paths) > 1:
            rows = upserts.last_wins(rows, list(schemas.KEYED[name][0]), ["batch"])
        return rows.drop("batch")

    def _rows(self, name: str) -> DataFrame:
        """The rows with their buckets. Only batches and their keys are shuffled or broadcast, not what is in buckets, unless they are many."""
        base, batches = self._with_buckets(name), self._batches(name)
        if batches is None:
            return base
        new = batches.select(*[F.col(c).alias(f"__{c}") for c in schemas.KEYED[name][0]])
        same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in schemas.KEYED[name][0]])
        return base.join(new, same, "left_anti").unionByName(batches)

    def table(self, name: str) -> DataFrame:
        """The rows of a keyed table; none if it was never written."""
        return self._rows(name).drop("bucket")

    def history(self, symbol: str) -> DataFrame:
        """date, open, high, low, close, volume of a symbol, by date, nothing as the empty text. One bucket is read."""
        one = self._bucket("ohlcv")
        bucket = self.spark.range(1).select(F.lit(symbol).alias("symbol")).select(one).first()[0]
        rows = self._rows("ohlcv").where((F.col("bucket") == bucket) & (F.col("symbol") == symbol))
        return rows.orderBy("date").select(*[F.coalesce(c, F.lit("")).alias(c) for c in schemas.BAR])

    def news(self, symbol: str, first: str = "", last: str = "9999") -> DataFrame:
        """A symbol's news of some days, by time, then id, then address."""
        rows = self.table("news").where((F.col("symbol") == symbol) & F.col("date").between(first, last))
        return rows.orderBy("datetime", "id", "url")

    def _put(self, name: str) -> None:
        """Put staged buckets in the places of the old ones. Doing it again changes nothing, so a run that ended in between is made good."""
        staged = f"{self.root}/_staged/{name}"
        if scratch.exists(self.spark, f"{staged}/_SUCCESS"):
            rows = self._read(staged, self._with_buckets(name).schema)
            rows.repartition("bucket").sortWithinPartitions("bucket", *schemas.KEYED[name][0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.root}/{name}")
        scratch.delete(self.spark, staged)

    def upsert(self, name: str, incoming: DataFrame, now: str, order: list[str]) -> None:
        """Put ``incoming`` over the stored rows by key; of its rows with one key the last by ``order`` wins.

        The rows are written once, as a batch. One writer at a time (``lock``).
        """
        keys = list(schemas.KEYED[name][0])
        ordered = schemas.with_text(incoming.withColumn("updated_at", F.lit(now)), name, [F.col(c).alias(f"__order_{c}") for c in order])
        ordered = ordered.where(F.coalesce(F.col(keys[-1]), F.lit("")) != "")
        new = upserts.last_wins(ordered, keys, [f"__order_{c}" for c in order]).select(*schemas.columns(name), self._bucket(name).alias("bucket"))
        new.write.mode("overwrite").parquet(f"{self.root}/_batches/{name}/batch={self._next_batch(name)}")
        if len(self._batch_numbers(name)) >= MERGE_AFTER:
            self.merge(name)

    def upsert_checked(self, name: str, incoming: DataFrame, now: str, order: list[str], fault: Column) -> dict[str, int]:
        """``upsert`` of the rows without a ``fault`` (a text, null if there is none); the others go to ``quarantine``. What was counted, also kept in ``checks``.

        All in the one pass that writes the batch: nothing is scanned or shuffled for the counts. They are taken in
        the job's last stage, of which Spark counts each task once, however often it ran; so rows that are counted are those
        left of equal ones: ``stored``, ``duplicate_keys`` (keys that rows without a fault have twice or more) and, by fault, distinct faulty rows.
        A faulty row doesn't win over a good one of its key, stored or incoming. Of a key and a faulty row two at most leave a task.
        """
        keys, places = list(schemas.KEYED[name][0]), [f"__order_{c}" for c in order]
        texts = schemas.with_text(incoming.withColumn("updated_at", F.lit(now)), name, [F.col(c).alias(p) for c, p in zip(order, places, strict=True)])
        reason = F.when(F.coalesce(F.col(keys[-1]), F.lit("")) == "", F.lit(NO_KEY)).otherwise(fault)
        tagged = texts.withColumn("outcome", F.coalesce(reason, F.lit(STORED)))
        # faulty rows are told apart by all that they say, good ones by their key alone
        whole = F.when(F.col("outcome") != STORED, F.to_json(F.struct(*schemas.columns(name), *places), {"ignoreNullFields": "false"}))
        window = Window.partitionBy(*keys, "__whole").orderBy(*[F.desc_nulls_last(c) for c in places])
        two = tagged.withColumn("__whole", whole).withColumn("__place", F.row_number().over(window)).where("__place <= 2")
        first, good, seen = F.col("__place") == 1, F.col("outcome") == STORED, Observation()
        counts = [F.count_if(first & good).alias("stored"), F.count_if(~first & good).alias("duplicate_keys"), F.count_if(first & (F.col("outcome") == NO_KEY)).alias(NO_KEY), F.count_if(first & ~good & (F.col("outcome") != NO_KEY)).alias("faulty")]
        batch = self._next_batch(name)
        rows = two.observe(seen, *counts).where(first).select(*schemas.columns(name), self._bucket(name).alias("bucket"), "outcome")
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{self.root}/_checked/{name}/batch={batch}")
        found = {c: int(seen.get[c]) for c in ("stored", "duplicate_keys", NO_KEY, "faulty")}
        self.spark.createDataFrame([(name, batch, now, *found.values())], CHECKS).coalesce(1).write.mode("append").parquet(f"{self.root}/checks")
        if len(self._batch_numbers(name)) >= MERGE_AFTER:
            self.merge(name)
        return found

    def checks(self) -> DataFrame:
        """What was counted in each checked batch."""
        return self._read(f"{self.root}/checks", CHECKS)

    def quarantine(self, name: str) -> DataFrame:
        """Faulty rows of checked batches with ``outcome``, what is wrong, and ``batch``; they stay when batches are merged. Other files aren't read."""
        at = f"{self.root}/_checked/{name}"
        kind = T.StructType([*self._with_buckets(name).schema.fields, T.StructField("outcome", T.StringType()), T.StructField("batch", T.IntegerType())])
        whole = [f"{at}/batch={n}" for n in self._whole(at)]
        paths = [f"{p}/{x}" for p in whole for x in scratch.names(self.spark, p) if x.startswith("outcome=") and x != f"outcome={STORED}"]
        if not paths:
            return self.spark.createDataFrame([], kind).drop("bucket")
        return self.spark.read.schema(kind).option("basePath", at).parquet(*paths).drop("bucket")

    def merge(self, name: str) -> None:
        """Merge a table's batches into the buckets that they touch.

        The merged buckets are staged first, for Spark can't read what it overwrites. Batches go last, so that readers
        and a merge that is done again after a break find the same rows.
        """
        self._put(name)
        paths, batches = self._batch_paths(name), self._batches(name)
        if batches is None:
            return
        touched = [r[0] for r in batches.select("bucket").distinct().collect()]  # ``buckets`` at most
        self._rows(name).where(F.col("bucket").isin(touched)).write.mode("overwrite").parquet(f"{self.root}/_staged/{name}")
        self._put(name)
        for path in paths.values():  # the oldest first: what is still there after a break is newer than what is gone
            scratch.delete(self.spark, path)

    # logs

    def bronze(self) -> DataFrame:
        return self._read(f"{self.root}/bronze", schemas.BRONZE)

    def archive(self, payloads: DataFrame) -> None:
        """Keep payloads as they came, before anything is made of them, a folder for each provider's run."""
        columns = [F.col(c) if c in payloads.columns else F.lit(None).cast("string").alias(c) for c in schemas.BRONZE.names]
        payloads.select(*columns).write.mode("append").partitionBy("provider", "seq").parquet(f"{self.root}/bronze")

    def log(self) -> DataFrame:
        return self._read(f"{self.root}/fetch_log", schemas.FETCH_LOG)

    def record(self, events: DataFrame) -> None:
        events.select(*schemas.FETCH_LOG.names).write.mode("append").parquet(f"{self.root}/fetch_log")

    def runs(self) -> DataFrame:
        return self._read(f"{self.root}/runs", schemas.RUNS)

    def record_run(self, run: DataFrame) -> None:
        run.select(*schemas.RUNS.names).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    # documents

    def save(self, label: str, rows: DataFrame) -> str:
        """A report or summary as a JSON document under ``label``, in the place of the one before; where it is."""
        path = f"{self.root}/documents/{label}"
        rows.coalesce(1).write.mode("overwrite").json(path)
        return path


def files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """path and length of the files under a folder, at any depth; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length")


def dataset_files(spark: SparkSession, root: str, datasets: tuple[str, ...] = tuple(schemas.TABLES), pattern: str = "*.csv") -> DataFrame:
    """dataset and files of data that was kept as files, a folder for each; folders that aren't there have none."""
    out = spark.createDataFrame([(d, 0) for d in datasets], "dataset string, files bigint")
    for d in datasets:
        if scratch.exists(spark, f"{root}/{d}"):
            out = out.unionByName(files(spark, f"{root}/{d}", pattern).agg(F.count(F.lit(1)).alias("files")).select(F.lit(d).alias("dataset"), "files"))
    return out.groupBy("dataset").agg(F.sum("files").alias("files"))
