"""Shapes of the table sink's steps that decide what a large run costs."""

from pyspark.sql import functions as F

from treeshred.operators import shred as S
from treeshred.operators.filters import FilterRules
from treeshred.operators.numbering import previous_within

CELLS = "cells array<struct<position:bigint,sub:int,column:string,esc:string,kind:string,text:string>>"


def test_layers_of_short_packets_are_linked_without_a_join(spark, tmp_path, capsys):
    rows = [("a", n, at, f"t{at}") for n in range(50) for at in range(n % 4 + 1)]
    spark.createDataFrame(rows, "src string, packet_no bigint, at int, table string").write.parquet(f"{tmp_path}/layers")
    chain = S.layer_chain(spark.read.parquet(f"{tmp_path}/layers"))
    chain.explain()
    assert "Join" not in capsys.readouterr().out
    found = {(r["_packet"], r["_layer"]): (r["_at"], r["_table"]) for r in chain.collect()}
    assert found == {(n, at): ((at - 1, f"t{at - 1}") if at else (None, None)) for _, n, at, _ in rows}


def test_long_packets_are_still_linked_slice_by_slice(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 4)
    rows = [("a" if n % 2 else "b", n, at, "deny" if at % 3 == 1 else f"t{at}") for n in range(6) for at in range(n, 5 * n + 1, 2)]
    rows += [("a", None, 1, "x"), (None, 3, 9, "y")]
    layers = spark.createDataFrame(rows, "src string, packet_no bigint, at int, table string")
    filters = FilterRules([{"action": "deny", "tableName": "deny"}])
    found = {(r["_src"], r["_packet"], r["_layer"]): (r["_at"], r["_table"]) for r in S.layer_chain(layers, filters).collect()}
    expected, last = {}, {}
    for src, n, at, table in rows:
        expected[src, n, at] = last.get((src, n), (None, None))
        if table != "deny":
            last[src, n] = at, table
    assert found == expected
    kept = F.when(F.col("table") != "deny", F.struct("at", "table"))
    whole = previous_within(layers.where("src is not null and packet_no is not null").withColumns({"s": F.floor(F.col("at") / 4), "k": kept}),
                            "b", ["src", "packet_no"], ["s"], "at", "k")
    assert {(r["src"], r["packet_no"], r["at"]): tuple(r["b"] or (None, None)) for r in whole.collect()}.items() <= expected.items()


def test_values_of_a_column_are_picked_once(spark, capsys):
    cells = [(1, 0, "a", "a", "int32", "1"), (2, 0, "a", "a", "int32", "2"), (3, 0, "b", "b", "int32", "3"),
             (4, S.LONE_BINARY, "c", "c", "bytes", "ff"), None, (5, 0, "A", "a", "int32", "9")]
    rows = S.resolve_columns(spark.createDataFrame([(1, [c for c in cells if c]), (2, [])], f"n int, {CELLS}"))
    rows.explain()
    # Once for the names of the columns, once for the name that wins.
    assert capsys.readouterr().out.count("array_distinct(") == 2
    assert [[tuple(c) for c in r["cols"]] for r in rows.orderBy("n").collect()] == [[("a", "int32", "9"), ("b", "int32", "3")], []]
