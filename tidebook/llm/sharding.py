"""Sharding by proportional stratified interleaving, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Hash cells of one stratum, and cells of the fractional rank. Both only spread
#: the sorting over tasks; the result doesn't depend on them.
STRATUM_CELLS = 4096
RANK_CELLS = 16384


def interleave_shards(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "source",
    seed: int = 42,
) -> DataFrame:
    """Deal documents into ``n_shards`` shards that each have the corpus's mixture of strata.

    Rows of a stratum are shuffled by md5(seed:id:crc32 of the text) and ranked from 1 to n; a row's
    fractional rank is (rank - u) / n, with u between 0 and 1 drawn for each stratum by a hash of its name, so that
    strata of a row or two are spread over all shards as well. All rows are sorted by it, and the
    sequence is cut into ``n_shards`` runs. So shard sizes differ by one row at
    most, and a stratum's rows in any two shards by a few at most.

    Ranks are taken without bringing a stratum to one task: rows are ranked within
    hash cells of their stratum, and counts of the cells before are added. The
    global position is found likewise from cells of the fractional rank.

    Returns doc_id, stratum, size (UTF-8 bytes + 16), text_crc32, law ("rows"),
    shard, slot (gapless from 0), grown_shard (null: the law is not "key").

    Null text counts as empty, a null stratum is a stratum of its own, a null id
    takes part like any other. Rows equal in id and text are interchangeable and
    each get a place. An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.crc32(text).cast("string")).cast("binary")).alias("key"),
    ).withColumn("cell", F.conv(F.substring("key", 1, 3), 16, 10).cast("int") % STRATUM_CELLS)
    # never null, so that the window over cells and the join with their counts are dealt alike
    rows = rows.withColumn("named", F.when(F.col("stratum").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.col("stratum"))))

    in_order = Window.partitionBy("named").orderBy("cell")
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.col("named")).cast("binary")), 1, 8), 16, 10).cast("double")
    cells = (
        rows.groupBy("named", "cell").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy("named")))
        .select("named", "cell", "before", "total", ((drawn + 0.5) / float(1 << 32)).alias("u"))
    )
    in_cell = Window.partitionBy("named", "cell").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = (
        rows.withColumn("place", F.row_number().over(in_cell))
        .join(cells, ["named", "cell"])
        .withColumn("fraction", ((F.col("before") + F.col("place")).cast("double") - F.col("u")) / F.col("total").cast("double"))
        .withColumn("part", F.least(F.floor(F.col("fraction") * RANK_CELLS), F.lit(RANK_CELLS - 1)).cast("int"))
        .select("doc_id", "stratum", "size", "text_crc32", "fraction", "part")
    )
    ranked = materialize(ranked, "sharding-ranked")

    # at most RANK_CELLS rows, whatever the input
    parts = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    parts = parts.select(
        F.col("part").alias("p"),
        F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    in_part = Window.partitionBy("part").orderBy("fraction", "stratum", "doc_id", "text_crc32", "size")
    start = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return (
        ranked.withColumn("place", F.row_number().over(in_part))
        .join(F.broadcast(parts), F.col("part") == F.col("p"))
        .withColumn("at", F.col("before") + F.col("place") - 1)
        .withColumn("shard", F.expr(f"cast((at * {n_shards}) div total as int)"))
        .select(
            "doc_id", "stratum", "size", "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("at") - start).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
