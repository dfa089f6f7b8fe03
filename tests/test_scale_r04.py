"""Pieces of a packet that are dealt out together."""

import datetime

import pytest
from pyspark.sql import functions as F

from treeshred.plans import queries as Q
from treeshred.session import portions_of
from treeshred.sources import order_packets as O


@pytest.fixture
def orders(spark, tmp_path):
    day = datetime.datetime(1995, 3, 1)
    spark.createDataFrame([(k if k else None, k, "O", 1.5, day, "1-URGENT") for k in (*range(6), 5)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "c", "s")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k % 4 + 1, k, 1, k, 2.0, 3.0, 0.07, "A", "O", day) for k in range(9)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def shuffles_by_packet(df):
    """Exchanges above the union of the pieces."""
    above = df._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    return above.count("Exchange hashpartitioning(src") + above.count("Exchange hashpartitioning(packet_no")


def test_rows_of_packets_are_told_apart_without_a_shuffle(spark, orders, monkeypatch):
    monkeypatch.setattr("treeshred.session.PORTION", 1)  # more lines than orders: portions by the rows of either would differ
    rows = lambda together: Q.whole(spark, orders, together=together).cells().select("src", "packet_no", "path").distinct()
    assert shuffles_by_packet(rows(True)) == 0
    assert sorted(map(str, rows(True).collect())) == sorted(map(str, rows(False).collect()))


def test_both_parts_count_for_portions(spark, orders):
    assert portions_of(spark.range(40_000), spark.range(120_000)) == max(spark.sparkContext.defaultParallelism, 10)


def test_packets_keep_number_and_key(spark, orders):
    pieces = O.order_pieces(spark, orders, together=True)
    assert pieces.where(~F.col("number").eqNullSafe(F.col("packet_no"))).count() == 0
    assert pieces.count() == O.order_pieces(spark, orders).count()
