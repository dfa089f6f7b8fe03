"""Hand-made documents: edge cases of tree shapes, typing, rules and filters."""

import pytest
from pyspark.sql import functions as F

from treeshred.functions import naming as N, values as V
from treeshred.operators import quality as Q, shred as S
from treeshred.operators.filters import FilterRules
from treeshred.operators.trees import explode_nodes
from treeshred.plans.shredder import Shredder
from treeshred.sources import captures, rules as R


def fields(spark, *rows):
    return R.literal_rows(spark, list(rows), ["short_name", "cls", "base"])


def columns_of(job, table):
    rows = S.resolve_columns(job.rows(table)).select(F.inline("cols")).collect()
    return {r["column"]: (r["kind"], r["text"]) for r in rows}


def one(spark, document, body, *dictionary, **more):
    pieces = captures.read_pieces(spark, document(f'<proto name="p">{body}</proto>'), depth=4)
    return Shredder(pieces, fields(spark, *dictionary) if dictionary else None, **more)


def test_default_read_has_no_depth_limit(spark, document):
    body = "".join(f'<field name="f{i}" show="{i}">' for i in range(20)) + "</field>" * 20
    nodes = explode_nodes(captures.read_pieces(spark, document(f'<proto name="p">{body}</proto>')))
    assert nodes.where("protocol = 'p' and type = 'field'").count() == 20
    assert Q.node_rejects(nodes).count() == 0


def test_rule_files_of_a_folder_are_one_list(spark, tmp_path):
    for name, text in (("b.xml", "two"), ("a.xml", "one")):
        (tmp_path / name).write_text(f'<fixups><constant protocol="p" text="{text}" name="n"/></fixups>')
    standard, _, skipped = R.load_rename_file(spark, str(tmp_path))
    assert [r["text"] for r in standard] == ["one", "two"] and not skipped


def test_only_a_lone_binary_is_dropped(spark, document):
    raw = '<field name="x" show="raw" value="{}"/>'
    lone = one(spark, document, raw.format("0a") + '<field name="y" show="1"/>', ("x", "bytes", "BASE_NONE"))
    assert "x" not in columns_of(lone, "p")
    twice = one(spark, document, raw.format("0a") + raw.format("0b"), ("x", "bytes", "BASE_NONE"))
    assert columns_of(twice, "p")["x"] == (V.ARRAY, "{ 0a, 0b }")


def test_many_repeated_values_take_linear_time(spark, document):
    body = "".join(f'<field name="x" show="{i % 10}"/>' for i in range(60_000))
    kind, text = columns_of(one(spark, document, body), "p")["x"]
    assert kind == V.ARRAY and text.count(",") == 59_999


def nodes_by_path(nodes):
    rows = nodes.where("protocol = 'p'").collect()
    return {tuple(r["path"]): (r["name"], r["show"], r["table"], tuple(r["anc"]), r["branch"], r["reject"], tuple(r["order_path"])) for r in rows}


def test_deep_trees_are_read_a_few_levels_at_a_time(spark, document):
    levels = 13
    deep = "".join(f'<field name="n{i}" show="{i}"><field show="leaf {i}"/>' for i in range(levels)) + "</field>" * levels
    # Bad children on both sides of a border: they go with their subtree and don't make their parent a branch.
    edge = ('<field name="a"><field name="b"><field name="c" show="1"><field name="d" size="zz"><field name="e"/></field></field></field></field>'
            '<field name="a"><field name="b"><field name="c" show="2 &gt; &quot;1&quot;"><field name="d" show="&lt;x&gt;"><field name="e"/></field></field></field></field>')
    path = document(f'<proto name="p">{deep}{edge}</proto>', f'<proto name="p"><field name="flat" show="1"/>{deep}</proto>')
    whole = nodes_by_path(explode_nodes(captures.read_pieces(spark, path, depth=20)).where("packet_no = 0"))
    for depth in (1, 2, 3, 4):
        nodes = explode_nodes(captures.read_pieces(spark, path, depth=depth))
        assert nodes_by_path(nodes.where("packet_no = 0")) == whole
        assert nodes.where("packet_no = 1 and protocol = 'p'").count() == 2 + 2 * levels
    assert len(whole) == 1 + 2 * levels + 9 and sum(v[5] is not None for v in whole.values()) == 1


def test_one_bad_packet_is_one_reject(spark, tmp_path):
    good = '<packet>\n<proto name="geninfo"><field name="num" show="{}"/><field name="timestamp" show="Jan  2, 2011 03:04:05.0"/></proto><proto name="p"><field name="x" show="{}"/></proto></packet >'
    bad = ['<packet><proto name="p"><field name=x/></proto></packet>', '<packet><proto name="p"><field name="x" show="never closed"/></proto>',
           '<packet><proto name="p"></packet>', '<packet a="1"><proto name="p" size="zz"/></packet>']
    body = "".join(good.format(i, i) + broken for i, broken in enumerate(bad)) + good.format(9, 9)
    (tmp_path / "a.xml").write_text(f'<?xml version="1.0"?><packets note="&lt;packet"><pdml>{body}</pdml></packets>')
    (tmp_path / "b.xml").write_text("<pdml>" + good.format(1, "b") + '<packet/><packet><proto name="p">')
    trees = captures.read_trees(spark, str(tmp_path))
    rows = Shredder(captures.tree_pieces(trees)).table("p", {"x": V.TEXT}).collect()
    assert sorted((r["_number"], r["x"]) for r in rows) == [(0, "0"), (1, "1"), (1, "b"), (2, "2"), (3, "3"), (9, "9")]
    rejects = sorted((r["file"][-5:], r["position"], r["reason"]) for r in captures.packet_rejects(trees).collect())
    assert rejects == [("a.xml", i, "malformed packet") for i in (1, 3, 5)] + [("a.xml", 7, "bad size or position in a layer"), ("b.xml", 2, "malformed packet")]


def test_packets_are_told_apart_by_place_for_any_split(spark, tmp_path):
    packet = '<packet><proto name="geninfo"><field name="num" show="7"/><field name="timestamp" show="Jan  2, 2011 03:04:05.0"/></proto><proto name="p"><field name="x" show="{}"/></proto></packet>\n'
    for name in ("a.xml", "b.xml"):
        (tmp_path / name).write_text("<pdml>" + "".join(packet.format(i) for i in range(500)) + "</pdml>")
    want = None
    for size in ("128m", "7000", "901"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            rows = Shredder(captures.read_pieces(spark, str(tmp_path), depth=2)).table("p", {"x": V.TEXT}).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = sorted((r["_id"], r["x"]) for r in rows)
        want = want or got
        assert got == want and len({i for i, _ in got}) == 1000
    assert {i.split("/")[-2] for i, x in want if x == "499"} == {"499"}


def test_bad_size_drops_subtree_only(spark, document):
    body = '<field name="x" size="zz"><field name="y" show="1"/></field><field name="z" show="2" hide="yes"/>'
    job = one(spark, document, body)
    assert columns_of(job, "p") == {"z": (V.TEXT, "2")}
    assert [r["reason"] for r in Q.node_rejects(job.nodes()).collect()] == ["bad size or position"]


def test_bad_layer_rejects_packet(spark, document):
    path = document('<proto name="p" size="zz"><field name="x" show="1"/></proto>', '<proto name="q"><field name="x" show="1"/></proto>')
    trees = captures.read_trees(spark, path)
    assert [r["packet_no"] for r in captures.packets(trees).collect()] == [1]
    assert [r["position"] for r in captures.packet_rejects(trees).collect()] == [0]


def test_packet_without_info_is_kept(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<pdml><packet><proto name="p"><field name="x" show="1"/></proto></packet><packet/></pdml>')
    job = Shredder(captures.read_pieces(spark, str(tmp_path), depth=2))
    row = job.table("p", {"x": V.TEXT}).first()
    assert row["x"] == "1" and row["_number"] is None and row["_timestamp"] is None


def test_fallback_table(spark, document):
    body = ('<field name="a" show=""/><field name="b" value="v"/><field name="pq.click" show="CLICK" value="v2"/>'
            '<field name="d" show="s" value="v3"/><field name="e"/>')
    # An empty show is contained in every name, so a value wins over it; without a value it stays.
    assert columns_of(one(spark, document, body), "p") == {
        "a": (V.TEXT, ""), "b": (V.TEXT, "v"), "pq_click": (V.TEXT, "v2"), "d": (V.TEXT, "s")}


def test_time_and_zone(spark, document):
    path = document('<proto name="p"><field name="x" show="1"/></proto>')
    job = Shredder(captures.read_pieces(spark, path, depth=2, capture_tz="America/New_York"))
    assert str(job.table("p", {"x": V.TEXT}).first()["_timestamp"]) == "2011-01-02 08:04:05.123456"


@pytest.mark.parametrize("show,kind", [
    ("255", V.INT32), ("256", V.INT32), ("65535", V.INT32), ("65536", V.INT64), ("4294967295", V.INT64),
    ("4294967296", V.BIGINT20), ("18446744073709551615", V.BIGINT20), ("18446744073709551616", V.TEXT), ("-1", V.TEXT)])
def test_unsigned_edges(spark, show, kind):
    text = V.as_unsigned(F.lit(show))
    row = spark.range(1).select(text.alias("t"), V.typed_kind(F.lit("u64"), F.lit("BASE_DEC"), text).alias("k")).first()
    assert row["k"] == kind


def test_values_by_class(spark, document):
    body = "".join(f'<field name="{n}" show="{s}" value="{v}"/>' for n, s, v in [
        ("hex", "0x0012 (18)", ""), ("odd", "True", ""), ("flag", "1", ""), ("guid", "{0F0E0D0C-0B0A-0908-0706-050403020100}", ""),
        ("bad", "not a guid", "zz"), ("ip", "2001:DB8::1", ""), ("raw6", "host", "20010db8000000000000000000000001"),
        ("inf", "1e400", "q"), ("neg", "0xfffffffffffffffe", ""), ("oct", "12", "")])
    got = columns_of(one(spark, document, body, ("hex", "u16", "BASE_HEX"), ("odd", "bool", "BASE_NONE"), ("flag", "bool", "BASE_NONE"),
                         ("guid", "guid", "BASE_NONE"), ("bad", "guid", "BASE_NONE"), ("ip", "ip", "BASE_NONE"),
                         ("raw6", "ip", "BASE_NONE"), ("inf", "double", "BASE_NONE"), ("neg", "i64", "BASE_HEX"),
                         ("oct", "u32", "BASE_NONE")), "p")
    assert got == {
        "hex": (V.INT32, "18"), "odd": (V.TEXT, "True"), "flag": (V.BOOL, "1"),
        "guid": (V.GUID, "0f0e0d0c-0b0a-0908-0706-050403020100"), "bad": (V.TEXT, "not a guid"), "ip": (V.TEXT8, "2001:db8::1"),
        "raw6": (V.TEXT8, "2001:db8::1"), "inf": (V.TEXT, "1e400"), "neg": (V.INT32, "-2"), "oct": (V.TEXT, "12")}


def test_nameless_shapes(spark, document):
    body = ('<field show="one"/><field name="b" show="5"><field show="in b"/><field show="g"><field name="c" show="6"/></field></field>'
            '<field><field/></field><field><field name="c" show="7"/></field><field show="two"/><field/>')
    job = one(spark, document, body)
    rows = S.resolve_columns(job.rows()).where("packet_no = 0 and table <> 'geninfo'")
    got = sorted((r["table"], tuple(r["path"][1:]), tuple(sorted((c["column"], c["text"]) for c in r["cols"]))) for r in rows.collect())
    assert got == sorted([
        ("p", (), ()),
        ("p__value", (0,), (("_index", "0"), ("_value", "one"))), ("p__value", (4,), (("_index", "1"), ("_value", "two"))),
        ("p__value", (5,), (("_index", "2"),)),
        ("p_b", (1,), (("_value", "5"),)), ("p_b__value", (1, 0), (("_index", "0"), ("_value", "in b"))),
        ("p_b__group", (1, 1), (("_index", "0"), ("_value", "g"), ("c", "6"))),
        ("p__group", (2,), (("_index", "0"),)), ("p__group__value", (2, 0), (("_index", "0"),)),
        ("p__group", (3,), (("_index", "1"), ("c", "7")))])


def test_escape_collision_and_multi(spark, document):
    body = '<field name="a" show="1"/><field name="a.string" show="x"/><field name="m" show="1"/><field name="M" show="2"/>'
    assert columns_of(one(spark, document, body), "p") == {
        "a": (V.TEXT, "1"), "a_string": (V.TEXT, "x"), "m": (V.ARRAY, "{ 1, 2 }")}


def test_deny_middle(spark, document):
    path = document('<proto name="p"><field name="x" show="1"/><field name="p.mid" show="2"><field name="p.low"><field name="z" show="3"/></field></field></proto>')
    deny = FilterRules(tables=[{"action": "deny", "tableName": "^p_mid$"}])
    job = Shredder(captures.read_pieces(spark, path, depth=3), filters=deny)
    row = job.table("p_low", {"z": V.TEXT}, ["p"]).first()
    assert row["parent_p"] == row["_id"].rsplit("/", 1)[0] + "/1"
    assert job.rows("p_mid").count() == 0


def test_templates_last_match_and_parent_name(spark, document):
    body = '<field show="Name: type A, class IN"><field show="GET / HTTP/1.1"/></field><field show="SEQ/ACK analysis"><field name="k" show="1"/></field>'
    job = one(spark, document, body, rules=R.rename_rules(spark, None, R.BUILTIN_TEMPLATES))
    names = {r["show"] if r["name"] is None else r["name"] for r in job.nodes().where("protocol = 'p' and type = 'field'").collect()}
    assert names == {"p.namespec", "p.namespec.httpdata", "tcp.analysis", "k"}


def test_template_overlap(spark, document):
    both = [{"parentName": ".*", "name": "", "show": "^ab", "showname": ".*", "value": ".*", "nameFormat": "first", "valueFormat": "1"},
            {"parentName": ".*", "name": "", "show": "^abc", "showname": ".*", "value": ".*", "nameFormat": "second", "valueFormat": ""}]
    job = one(spark, document, '<field show="abc"/><field show="abd"/>', rules=R.rename_rules(spark, None, both))
    got = {(r["name"], r["show"]) for r in job.nodes().where("protocol = 'p' and type = 'field'").collect()}
    assert got == {("second", None), ("first", "1")}


def test_rule_and_filter_files(spark, tmp_path):
    (tmp_path / "r.xml").write_text(
        '<fixups><constant protocol="a,b" text="No Operation (NOP)"/><prefix protocol="a" text="Len" name="length"/>'
        '<template show="x" nameFormat="y"/><template nameFormat="y"/><odd/></fixups>')
    standard, templates, skipped = R.load_rename_file(spark, str(tmp_path / "r.xml"))
    rows = R.rename_rules(spark, standard, templates).standard.collect()
    assert {(r["class"], r["protocol"], r["text"], r["new_name"]) for r in rows} == {
        ("constant", "a", "No Operation (NOP)", "no.operation.nop"), ("constant", "b", "No Operation (NOP)", "no.operation.nop"),
        ("prefix", "a", "Len", "length")}
    assert len(templates) == 1 and len(skipped) == 2
    (tmp_path / "f.xml").write_text(
        '<filter><tables><deny tableName=".*"/><allow tableName="^eth.*$"/><allow/></tables>'
        '<columns><allow tableName=".*" columnName=".*"/></columns></filter>')
    rules, skipped = R.load_filter_file(spark, str(tmp_path / "f.xml"))
    assert [t["action"] for t in rules.tables] == ["deny", "allow"] and len(rules.columns) == 1 and len(skipped) == 1


def test_long_names(spark):
    row = spark.range(1).select(N.escape(F.lit("a" * 60 + "." * 10 + "b" * 60)).alias("n")).first()
    assert len(row["n"]) == 96 and row["n"] == "a" * 23 + "___" + "_" * 10 + "b" * 60


def test_recursive_scan(spark, document):
    document('<proto name="p"><field name="x" show="1"/></proto>', name="a.xml", folder="one/two")
    document('<proto name="p"><field name="x" show="2"/></proto>', name="b.pdml", folder="three")
    root = document('<proto name="p"><field name="x" show="3"/></proto>', name="c.txt")
    assert captures.listed_files(spark, root, "*.xml|*.pdml").count() == 2
    assert captures.scan_trees(spark, root, patterns="*.xml|*.pdml").count() == 2
    assert captures.scan_trees(spark, root).count() == 3
