"""Changes with equal order: the first in the table wins, as ``arg_max`` keeps the first greatest row."""

import duckdb

from foliant import queries


def test_upsert_merge_keeps_the_first_of_equal_line_numbers(spark, tmp_path):
    """Tied lines in many row groups and partitions, null prices, orders without a change; one thread makes DuckDB's choice the first row."""
    c = duckdb.connect()
    c.execute("SET threads = 1")
    c.execute(f"COPY (SELECT i AS o_orderkey, i + 0.25 AS o_totalprice FROM range(500) r(i)) TO '{tmp_path}/orders.parquet'")
    line = "SELECT (i * 7919) % 600 AS l_orderkey, CAST(1 + i % 2 AS INTEGER) AS l_linenumber, CASE WHEN i % 11 = 0 THEN NULL ELSE CAST((i * 31) % 4001 AS DOUBLE) END AS l_extendedprice, CASE WHEN i % 5 = 0 THEN 'N' ELSE 'R' END AS l_returnflag FROM range(30000) r(i)"
    c.execute(f"COPY ({line}) TO '{tmp_path}/lineitem.parquet' (ROW_GROUP_SIZE 2048)")
    for name in ("orders", "lineitem"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = sorted(c.execute(queries.oracle_sql()["upsert_merge"]).fetchall())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = sorted(map(tuple, queries.queries()["upsert_merge"](spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == want
