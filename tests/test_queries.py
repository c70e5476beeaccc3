"""Every query that has SQL, against DuckDB on the smallest tables."""

import compare
import pytest

from tidebook.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare.rows_of_spark(QUERIES[name](spark, DATA)) == compare.rows_of_duckdb(ORACLES[name], DATA)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_try_double_of_odd_lines(spark, tmp_path):
    """Quantities with fractions, below zero and null, and part keys below zero and null."""
    for t in compare.TABLES:
        if t != "lineitem":
            (tmp_path / f"{t}.parquet").symlink_to(f"{DATA}/{t}.parquet")
    quantities, parts = [2.5, 3.5, 2.4, 2.6, -0.3, -2.5, 7.0, None], [*range(-12, 13), None]
    rows = [(k, k, part, k, q) for k, (part, q) in enumerate((p, q) for p in parts for q in quantities)]
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert compare.rows_of_spark(QUERIES["try_double"](spark, str(tmp_path))) == compare.rows_of_duckdb(ORACLES["try_double"], tmp_path)
