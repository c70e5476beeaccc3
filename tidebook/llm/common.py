"""Helpers shared by the operators on text corpora."""

from __future__ import annotations

from collections.abc import Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions.workers import ship
from tidebook.sources.scratch import delete, new_path, shared_dir

__all__ = [
    "WHITE_SPACE", "WORD_BREAK", "Memory", "discard", "free_name", "held_out", "id_hash", "join_counted", "materialize", "new_path", "only", "packed", "shared_dir", "ship", "text_key"
]

#: The six ASCII white-space characters that separate words: space, tab, LF, VT, FF, CR.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Spark's setting by which a query's shuffle files are deleted at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
#: A key with over one part in HOT_KEYS of a table's rows, and over HOT_ROWS of them, is hot; there are HOT_KEYS such keys at most.
HOT_KEYS = 1000
HOT_ROWS = 1000

_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialize(df: DataFrame, label: str, parts: int = 1) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the
    stages before the table. Shuffle files of the write go as soon as it is done, the
    table by ``discard`` or when the driver ends. Its shuffles have ``parts`` partitions at
    least, for what grows with the input more than the session's number allows for.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    wanted = {CLEAN_UP: "true", PARTITIONS: str(max(parts, int(spark.conf.get(PARTITIONS))))}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    back = spark.read.schema(df.schema).parquet(path)
    _written[back] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing is to be computed from any more."""
    for t in tables:
        if path := _written.pop(t, None):
            delete(t.sparkSession, path)


def id_hash(id_col: str = "doc_id") -> Column:
    """crc32 of an id's decimal text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def held_out(modulus: int, id_col: str = "doc_id") -> Column:
    """Whether crc32(id as text) mod ``modulus`` is 1; false for a null id."""
    return F.coalesce(F.pmod(id_hash(id_col), F.lit(modulus)) == 1, F.lit(False))


def packed(n_rows: int, rows_per_task: int) -> int:
    """The number of tasks that hold ``n_rows`` with at most about ``rows_per_task`` each."""
    return max(1, -(-n_rows // rows_per_task))


def text_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """With the id, what tells a row: rows alike in both are one document. Never null."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(text_col))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text", once: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (doc_id, text_key) names, with all their columns; ``once``: of repeated rows one."""
    named, text = free_name(docs, "__id"), free_name(docs, "__text")
    keys = kept.select(F.coalesce("doc_id", F.lit(-1)).alias(named), F.col("text_key").alias(text)).distinct()
    marked = docs.withColumns({named: F.coalesce(F.col(id_col), F.lit(-1)), text: text_key(id_col, text_col)})
    found = marked.join(keys, [named, text], "left_semi")
    return (found.dropDuplicates([named, text]) if once else found).drop(named, text)


def join_counted(left: DataFrame, right: DataFrame, key: str, right_key: str, n_col: str, total: int, null_safe: bool = False) -> DataFrame:
    """``left`` joined with ``right``, which has every ``right_key`` once, with the number of ``left``'s rows of that key in ``n_col``.

    Of ``left``'s ``total`` rows, those with a hot key stay where they are: ``right``'s rows of hot keys, HOT_KEYS at
    most, are broadcast. The others meet in a shuffle, and no key has more than its share there.
    """
    on = F.col(key).eqNullSafe(F.col(right_key)) if null_safe else F.col(key) == F.col(right_key)
    most = max(HOT_ROWS, total // HOT_KEYS)
    if total <= most:
        return left.join(right, on)
    hot, cold = F.broadcast(right.where(F.col(n_col) > most)), right.where(F.col(n_col) <= most)
    return left.join(hot, on).unionByName(left.join(hot.select(right_key), on, "left_anti").join(cold, on))


class Memory(dict):
    """What is known of words; once it takes more than about ``limit`` bytes, what the batch at hand doesn't have is forgotten.

    ``room()`` is asked before each batch with its words, so that those met again and again stay.
    """

    #: What an entry takes beside its word and its value's own bytes, about.
    ENTRY = 180

    def __init__(self, limit: int = 64 << 20):
        super().__init__()
        self.limit, self.size = limit, 0

    def new(self, words: Iterable) -> list:
        """Those of the words that aren't known. (A set's difference with this would go through all that is.)"""
        return [w for w in words if w not in self]

    def learn(self, word: bytes | str | tuple, value) -> None:
        self[word] = value
        self.size += len(word) + (len(value) if isinstance(value, (bytes, tuple)) else 0) + self.ENTRY

    def room(self, wanted: Iterable = ()) -> None:
        if self.size > self.limit:
            kept = {w: self[w] for w in wanted if w in self}
            self.clear()
            self.size = 0
            for w, value in kept.items():
                self.learn(w, value)
            if self.size > self.limit // 2:  # a batch of very many or very long words
                self.clear()
                self.size = 0
