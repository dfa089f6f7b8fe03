"""Merges of many texts under one key."""

import datetime
import time

from pyspark.sql import functions as F

from treeshred.operators import merge as M
from treeshred.plans import queries as Q


def plain_fold(texts):
    first = next((t for t in texts if t), "")
    out, seen = first, first == ""
    for t in texts:
        if t is None:
            continue
        if not seen:
            seen = t == first
        elif t.lower() != out.lower() and first:
            out += M.JOINER + t
    return out


def test_texts_are_folded_as_one_after_the_other(spark):
    groups = [
        ["a", "A", "b", "a / B", "a / b", "c", "a / b / c", "a / b / c / x"], ["long text here", "x", "", "X", "long text here / x / ", None, "y"],
        [None, " ", "k", "K", "k"], [None, None], ["", " "], ["İ", "i̇", "z", "İ / z", "q"], ["m", "a long one that comes late", "n", "m"],
    ]
    rows = [(k, i, t) for k, texts in enumerate(groups) for i, t in enumerate(texts)]
    found = M.merge_texts(spark.createDataFrame(rows, "k int, seq long, t string"), ["k"], "seq", ["t"]).collect()
    assert {r["k"]: r["t"] for r in found} == {k: plain_fold(texts) for k, texts in enumerate(groups)}


def test_a_key_of_many_texts_costs_what_its_texts_cost(spark):
    rows = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.concat(F.lit("text "), F.col("id") % 64).alias("t"))
    began = time.time()
    found = M.merge_texts(rows, ["k"], "seq", ["t"]).first()["t"]
    assert found == M.JOINER.join(f"text {i % 64}" for i in range(60_000))
    # One text after the other copies 18 GB.
    assert time.time() - began < 15


def test_packets_are_sorted_by_folder_before_they_are_made(spark, tmp_path):
    day = datetime.datetime(1995, 3, 1)
    spark.createDataFrame([(k, k, "O", 1.5, day.replace(year=1992 + k % 3) if k else None, "1-URGENT") for k in range(6)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "c", "s")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    written = spark.read.format("xml").option("rowTag", "packet").load(Q.written_captures(spark, str(tmp_path)))
    assert sorted((r["year"] or 0) for r in written.select("year").collect()) == [0, 1992, 1993, 1993, 1994, 1994]
    order = Q.year_packets(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().outputOrdering().mkString()
    assert order.startswith("year")
