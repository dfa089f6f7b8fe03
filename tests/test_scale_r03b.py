"""Shuffles and numbering of the order packets, and typing of numbers."""

import datetime

import pytest
from pyspark.sql import functions as F

from treeshred.functions import values as V
from treeshred.operators import numbering
from treeshred.plans import queries as Q

GROUPS = [(k, b, i) for k in (1, 2, None) for b in (None, 0, 1) for i in range(4)] + [(3, 0, 0)]


@pytest.mark.parametrize("small", [0, 5, 100])
def test_small_and_large_groups_are_numbered_alike(spark, monkeypatch, small):
    monkeypatch.setattr(numbering, "SMALL_GROUP", small)
    rows = spark.createDataFrame(GROUPS, "k int, b int, i int")
    found = numbering.number_small(rows, "n", ["k"], ["b"], ["i"])
    assert found.schema["n"].dataType.simpleString() == "bigint"
    expected = sorted(numbering.number_within(rows, "n", ["k"], ["b"], ["i"]).collect(), key=str)
    assert sorted(found.collect(), key=str) == expected and len(expected) == len(GROUPS)


def test_rows_of_line_items_meet_without_another_shuffle(spark, tmp_path):
    day = datetime.datetime(1995, 3, 1)
    spark.createDataFrame([(k, k, "O", 1.5, day, "1-URGENT") for k in range(3)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, p, 1, n, 2.0, 10.5, 0.07, 0.0, "A", "O", day) for k in range(3) for n, p in ((1, 5), (2, 700))],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    wide = Q.QUERIES["shred_line_branch_rows"](spark, str(tmp_path))
    assert "hashpartitioning(packet_no" not in wide._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["_number"], r["_value"], r["line_price"]) for r in wide.collect()) == [
        (k, n, 10.5) for k in range(3) for n in (1, 2)]


def test_numbers_keep_their_digits(spark):
    texts = ["0", "-0.0", "7", "10000000", "9999999", "0.001", "0.0009", "1e-7", "-12.50", "123456789.25", "1e20", "NaN", "Infinity",
             "1,234.5", "1e999", "x", "9" * 299, " 5 ", None]
    row = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    found = [r[0] for r in row.select(V.plain_double(V.as_double(F.col("t")))).collect()]
    assert found == ["0", "0", "7", "10000000", "9999999", "0.001", "0.0009", "1.0E-7", "-12.5", "123456789.25", "1.0E20", "NaN", "Infinity",
                     "1234.5", None, None, "1.0E299", "5", None]


def test_kinds_follow_the_magnitude_of_unsigned_numbers(spark):
    texts = ["65535", "65536", "4294967295", "4294967296", "18446744073709551615", None]
    row = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    found = row.select(V.typed_kind(F.lit("u64"), F.lit("BASE_DEC"), F.col("t"))).collect()
    assert [r[0] for r in found] == [V.INT32, V.INT64, V.INT64, V.BIGINT20, V.BIGINT20, V.TEXT]
