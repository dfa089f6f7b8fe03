"""Shapes of the shredding step that decide what a large run costs."""

from pyspark.sql import functions as F

from treeshred.functions import naming as N
from treeshred.operators import shred as S
from treeshred.operators.trees import explode_nodes
from treeshred.session import SETTINGS
from treeshred.sources import captures


def pieces_of(document, spark, body, depth=4):
    return captures.read_pieces(spark, document(body), depth=depth)


def test_stages_too_long_for_the_jvm_run_operator_by_operator():
    assert int(SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000


def test_nodes_of_other_tables_are_left_behind(spark, document):
    body = '<proto name="p">' + '<field name="x" show="1"/>' * 50 + '<field name="q"><field name="y" show="2"/></field></proto>'
    pieces = pieces_of(document, spark, body)
    wanted = explode_nodes(pieces, None, "p_q").where("protocol = 'p'")
    assert wanted.where("inside").select("name").toPandas()["name"].tolist() in (["q", "y"], ["y", "q"])
    assert wanted.count() < explode_nodes(pieces).where("protocol = 'p'").count() - 49


def test_read_names_only_the_levels_that_trees_reach(spark, document):
    shallow = captures.read_trees(spark, document('<proto name="p"><field name="x"><field name="y" show="1"/></field></proto>'))
    assert shallow.schema["proto"].dataType.simpleString().count("field:") == 2


def test_rejected_children_make_no_branch(spark, document):
    body = ('<proto name="p"><field name="a"><field name="b" size="zz" show="1"/></field>'
            '<field name="c"><field name="d" pos="zz" show="1"/><field name="e" size="1" show="1"/></field></proto>')
    rows = {r["name"]: r["branch"] for r in explode_nodes(pieces_of(document, spark, body)).where("protocol = 'p'").collect()}
    assert rows["a"] is False and rows["c"] is True and rows["p"] is True


def test_only_nameless_rows_are_numbered(spark, document):
    body = '<proto name="p"><field name="q"><field name="y" show="1"/></field>' + '<field show="v"/>' * 3 + "</proto>"
    from treeshred.plans.shredder import Shredder

    rows = Shredder(pieces_of(document, spark, body)).rows()
    found = S.resolve_columns(rows).where("table like 'p%'").select("table", F.inline("cols")).where("column = '_index'")
    assert sorted((r["table"], r["text"]) for r in found.collect()) == [("p__value", "0"), ("p__value", "1"), ("p__value", "2")]


def test_plain_names_are_normalised_as_others(spark):
    names = ["abc.d1", "Abc d", "a:b", "", "a\n", "é_x", None]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    assert [r[0] for r in rows.select(N.normalise(F.col("n"))).collect()] == ["abc.d1", "abc.d", "a", "", "a", "é.x", None]
