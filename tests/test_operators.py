"""Properties of widening, numbering, merges, keys, sinks and streams."""

import itertools
import random

from pyspark.sql import functions as F

from treeshred.functions import values as V
from treeshred.operators import schema as C
from treeshred.operators.merge import merge_texts
from treeshred.operators.mining import corpus_of, mine, mined, read_corpus, write_rules, write_trace
from treeshred.operators.numbering import number_within, previous_within
from treeshred.plans.shredder import Shredder
from treeshred.sources import captures, dictionaries as D, rules as R
from treeshred.sources.tables import TableSink
from treeshred.streaming.ingest import start_ingest

KINDS = [V.INT32, V.INT64, V.BIGINT20, V.BOOL, V.FLOAT, V.TIME, V.GUID, V.TEXT, V.TEXT8]


def test_widening_is_order_free(spark):
    for a, b in itertools.product(KINDS, KINDS):
        assert C.merge_kind(a, b) == C.merge_kind(b, a)
        assert C.merge_kind(a, a) == a
    for a, b, c in itertools.product(KINDS, repeat=3):
        assert C.merge_kind(C.merge_kind(a, b), c) == C.merge_kind(a, C.merge_kind(b, c))
    sets = [list(s) for n in (1, 2, 3) for s in itertools.combinations(KINDS, n)]
    rows = spark.createDataFrame([(sorted(s),) for s in sets], "k array<string>").select("k", C.widened(F.col("k")).alias("w")).collect()
    for r in rows:
        want = r["k"][0]
        for k in r["k"][1:]:
            want = C.merge_kind(want, k)
        assert r["w"] == want


def test_numbering_matches_brute_force(spark):
    rnd = random.Random(1)
    data = [(rnd.choice("aab"), at, rnd.choice([None, at])) for at in rnd.sample(range(5000), 400)]
    df = spark.createDataFrame(data, "g string, at long, v long").withColumn("b", F.floor(F.col("at") / 37))
    numbered = {(r["g"], r["at"]): r["n"] for r in number_within(df, "n", ["g"], ["b"], ["at"]).collect()}
    before = {(r["g"], r["at"]): r["p"] for r in previous_within(df, "p", ["g"], ["b"], "at", "v").collect()}
    for g in "ab":
        last = None
        for n, (_, at, v) in enumerate(sorted((r for r in data if r[0] == g), key=lambda r: r[1]), 1):
            assert numbered[g, at] == n and before[g, at] == last
            last = v if v is not None else last


def test_merge_folds_in_order(spark):
    texts = ["", "A", "a", "B", "A", None, "A / B / A", "c"]
    df = spark.createDataFrame([("k", i, t) for i, t in enumerate(texts)], "k string, seq long, t string")
    assert merge_texts(df, ["k"], "seq", ["t"]).first()["t"] == "A / B / A / c"


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "p").write_text("Transmission\ttcp\ttcp\n\nOther\ttcp\tx\nTransfer\ttcp\ttcp\nshort only\t\n")
    (tmp_path / "f").write_text(
        "F\tEarly\te.x\tFT_UINT8\tLATE\tdesc\tBASE_DEC\t0x0\nP\tLate one\tLATE\nP\tAgain\tTCP\n"
        "F\tPort\ttcp.port\tFT_UINT16\ttcp\td\tBASE_DEC\t0x0\nF\tport\ttcp.port\tFT_UINT16\ttcp\te\tBASE_DEC\t0x0\n"
        "F\tPort\ttcp.port\tFT_STRING\ttcp\td\tBASE_DEC\t0x0\nX\tignored\nF\tL\tl.x\tFT_UINT8\tLATE\t\t\tm\tore\n")
    (tmp_path / "v").write_text("V\ttcp.port\t0x50\thttp\nV\ttcp.port\t80\tweb\nR\ttcp.port\t0\t1023\tknown\nV\tnone\t1\tx\nV\ttcp.port\tzz\tx\nT\tl.x\tyes\tno\n")
    d = D.read_dictionaries(spark, *(str(tmp_path / n) for n in "pfv"))
    assert {tuple(r) for r in d.protocols.select("short_name", "long_name", "filter_name").collect()} == {
        ("tcp", "Transmission / Transfer", "tcp"), ("LATE", "Late one", "late")}
    assert {tuple(r) for r in d.fields.select("short_name", "long_name", "description", "bitmask").collect()} == {
        ("tcp.port", "Port", "d / e", "0x0"), ("l.x", "L", "", "m\tore")}
    assert {tuple(r) for r in d.labels.select("field", "kind", "lo", "hi", "label", "false_label").collect()} == {
        ("tcp.port", "V", 80, 80, "http / web", None), ("tcp.port", "R", 0, 1023, "known", None), ("l.x", "T", None, None, "yes", "no")}
    got = sorted((r["stage"], r["position"], r["reason"]) for r in d.rejects.collect())
    assert got == [("fields", 1, "unknown protocol"), ("fields", 6, "type conflict"), ("protocols", 3, "filter name conflict"),
                   ("protocols", 5, "missing short name"), ("values", 4, "unknown field"), ("values", 5, "bad number")]


def test_sink_appends_widens_and_repeats(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_t LOCATION '{tmp_path}/db'")
    sink = TableSink(spark, "sink_t")
    from treeshred.sources.rules import literal_rows
    fields = literal_rows(spark, [("x", "u64", "BASE_DEC"), ("t", "bool", "BASE_NONE")], ["short_name", "cls", "base"])

    def run(body, name, batch):
        path = document(f'<proto name="p">{body}</proto>', name=name, folder=name)
        job = Shredder(captures.read_pieces(spark, f"{path}/{name}", depth=2), fields)
        sink.write(job.rows(), job.layers(), batch=batch)

    run('<field name="x" show="1"/><field name="t" show="1"/>', "one.xml", 1)
    run('<field name="x" show="70000"/><field name="t" show="soon"/><field name="y" show="new"/>', "two.xml", 2)
    run('<field name="x" show="70000"/><field name="t" show="soon"/><field name="y" show="new"/>', "two.xml", 2)
    rows = spark.table("sink_t.p").orderBy("x").select("x", "t", "y", "_sourcefileid").collect()
    assert [tuple(r) for r in rows] == [(1, "1", None, 1), (70000, "soon", "new", 2)]
    assert dict(spark.table("sink_t.p").dtypes)["x"] == "bigint"
    assert spark.table("sink_t.sourcefile").count() == 2


def forget_done(spark, database):
    """Leave the log as a run that stopped before its last line."""
    log = f"{database}._ingest_log"
    started = spark.table(log).where("state = 'started'").collect()
    spark.sql(f"DROP TABLE {log}")
    spark.createDataFrame(started, "ingest string, batch bigint, state string").write.saveAsTable(log)


def test_interrupted_batch_adds_nothing_twice(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_r LOCATION '{tmp_path}/db'")
    sink = TableSink(spark, "sink_r")
    body = '<proto name="p"><field name="x" show="1"/></proto>'
    jobs = [Shredder(captures.read_pieces(spark, document(*[body] * n, folder=str(n)) + f"/{n}", depth=2)) for n in (1, 2)]
    sink.write(jobs[0].rows(), jobs[0].layers())
    before = spark.table("sink_r.p").first()
    sink.write(jobs[1].rows().where("number = 1"), jobs[1].layers(), batch=7)  # what the lost run had written
    forget_done(spark, "sink_r")
    sink.write(jobs[1].rows(), jobs[1].layers(), batch=7)
    rows = spark.table("sink_r.p").collect()
    assert len(rows) == 3 == len({r._id for r in rows}) and before in rows
    for _ in range(2):  # without a number every write adds its rows
        sink.write(jobs[0].rows(), jobs[0].layers())
    assert spark.table("sink_r.p").count() == 5


def test_readers_see_whole_versions_while_a_table_widens(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_v LOCATION '{tmp_path}/db'")
    fields = R.literal_rows(spark, [("x", "u64", "BASE_DEC"), ("t", "bool", "BASE_NONE")], ["short_name", "cls", "base"])
    seen = []

    class Watched(TableSink):
        def _publish(self, table, version, columns):
            if table == "p" and version > 1:
                seen.append([tuple(r) for r in spark.table("sink_v.p").select("x", "t").collect()])
            super()._publish(table, version, columns)
            if table == "p" and version > 1:
                seen.append([tuple(r) for r in spark.table("sink_v.p").select("x", "t").collect()])

    def job(x, t):
        path = document(f'<proto name="p"><field name="x" show="{x}"/><field name="t" show="{t}"/></proto>', folder=f"{x}-{t}")
        return Shredder(captures.read_pieces(spark, f"{path}/{x}-{t}", depth=2), fields)

    sink = Watched(spark, "sink_v")
    jobs = [job(1, 1), job(70000, 1), job(2, "soon")]
    sink.write(jobs[0].rows(), jobs[0].layers(), batch=0)
    old = spark.table("sink_v.p")
    sink.write(jobs[1].rows(), jobs[1].layers(), batch=1)
    assert [tuple(r) for r in old.select("x", "t").collect()] == [(1, True)]  # a plan made before still reads its version
    sink.write(jobs[2].rows(), jobs[2].layers(), batch=2)
    assert seen[:2] == [[(1, True)]] * 2
    assert sorted(seen[2]) == [(1, True), (70000, True)] and sorted(seen[3]) == [(1, "1"), (70000, "1")]
    assert sorted(map(tuple, spark.table("sink_v.p").select("x", "t").collect())) == [(1, "1"), (2, "soon"), (70000, "1")]
    assert {t.name for t in spark.catalog.listTables("sink_v") if t.name.startswith("p__v")} == {"p__v2", "p__v3"}


def test_columns_added_by_a_lost_run_are_taken(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_c LOCATION '{tmp_path}/db'")
    sink = TableSink(spark, "sink_c")
    jobs = []
    for n, extra in (("a", ""), ("b", '<field name="y" show="new"/>')):
        path = document(f'<proto name="p"><field name="x" show="{n}"/>{extra}</proto>', folder=n)
        jobs.append(Shredder(captures.read_pieces(spark, f"{path}/{n}", depth=2)))
    sink.write(jobs[0].rows(), jobs[0].layers(), batch=1)
    spark.sql("ALTER TABLE sink_c.p__v1 ADD COLUMNS (y string)")
    assert "y" not in spark.table("sink_c.p").columns
    sink.write(jobs[1].rows(), jobs[1].layers(), batch=2)
    assert sorted(map(tuple, spark.table("sink_c.p").select("x", "y").collect()), key=str) == [("a", None), ("b", "new")]


def test_plain_tables_are_taken_over(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_o LOCATION '{tmp_path}/db'")
    spark.sql("CREATE TABLE sink_o.p USING parquet AS SELECT 'old' AS _id, 5 AS x")
    fields = R.literal_rows(spark, [("x", "u64", "BASE_DEC")], ["short_name", "cls", "base"])
    job = Shredder(captures.read_pieces(spark, document('<proto name="p"><field name="x" show="70000"/></proto>'), depth=2), fields)
    sink = TableSink(spark, "sink_o")
    for _ in range(2):
        sink.write(job.rows(), job.layers(), batch=3)
    assert sorted(r.x for r in spark.table("sink_o.p").collect()) == [5, 70000]
    assert [tuple(r) for r in spark.table("sink_o.p__v0").collect()] == [("old", 5)]


def test_stream_equals_batch(spark, document, tmp_path):
    for i in range(3):
        root = document(f'<proto name="p"><field name="x" show="{i}"/><field show="n"/></proto>', name=f"f{i}.xml", folder="in")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stream_t LOCATION '{tmp_path}/db'")
    sink = TableSink(spark, "stream_t")
    start_ingest(spark, f"{root}/in", sink, f"{tmp_path}/progress", depth=2, files_per_batch=2).awaitTermination()
    want = Shredder(captures.read_pieces(spark, f"{root}/in", depth=2)).table("p", {"x": V.TEXT}).select("_id", "x").collect()
    assert sorted(map(tuple, spark.table("stream_t.p").select("_id", "x").collect())) == sorted(map(tuple, want))
    assert spark.table("stream_t.p__value").count() == 3


def test_streams_into_one_database_are_told_apart(spark, document, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stream_u LOCATION '{tmp_path}/db'")
    sink = TableSink(spark, "stream_u")
    deep = "".join(f'<field name="f{i}" show="{i}">' for i in range(5)) + "</field>" * 5
    for folder, body in (("one", '<field name="x" show="1"/>'), ("two", '<field name="x" show="2"/>' + deep)):
        root = document(f'<proto name="p">{body}</proto>', name="f.xml", folder=folder)
        (tmp_path / folder / "bad.xml").write_text('<pdml><packet><proto name="geninfo"><field name="num" show="no"/></proto></packet></pdml>')
        for _ in range(2):
            start_ingest(spark, f"{root}/{folder}", sink, f"{tmp_path}/progress-{folder}", depth=2).awaitTermination()
    assert sorted(r.x for r in spark.table("stream_u.p").select("x").collect()) == ["1", "2"]
    assert any("f4" in spark.table(f"stream_u.{t.name}").columns for t in spark.catalog.listTables("stream_u"))
    rejects = spark.table("stream_u._rejects").collect()
    assert len(rejects) == 2 and len({r.ingest for r in rejects}) == 2 and {r.stage for r in rejects} == {"packets"}


def test_long_comments_do_not_overflow(spark):
    text = f'proto_register_protocol("Long", /* {"x" * 200_000} */ "S", /* c **/ "foo");'
    corpus = corpus_of(spark.createDataFrame([("/s/epan/dissectors/packet-foo.c", text)], "path string, text string"))
    assert {r.protocol for r in mined(corpus)[0].collect()} == {"foo"}


def test_mining(spark, tmp_path):
    files = [("/s/epan/dissectors/packet-foo.c",
              '#include "foo.h"\n#define SHORT "foo\\"x"\nproto_register_protocol("Long", "S", /* c */ SHORT);\n'
              'proto_tree_add_text(t, v, 0, 1, "Plain text", x);proto_tree_add_text(t, v, 0, 1, "Len: %u", x);\n'
              'proto_tree_add_text(t, v, 0, 1, "A: %u B: %u", x);proto_tree_add_text(t, v, 0, 1, "%u left", x);'),
             ("/s/epan/dissectors/foo.h", 'proto_tree_add_text(t, v, 0, 1, "From header", x);'),
             ("/s/epan/dissectors/packet-bar.c", 'proto_tree_add_text(t, v, 0, 1, "Plain text", x);'),
             ("/s/epan/dissectors/other.c", 'proto_tree_add_text(t, v, 0, 1, "Nobody", x);')]
    rules, trace = mined(corpus_of(spark.createDataFrame(files, "path string, text string")))
    got = {(r["kind"], r["protocol"], r["text"]) for r in rules.where("kind <> 'speculative'").collect()}
    assert got == {("constant", 'foo\\"x', "From header"), ("constant", 'foo\\"x', "Plain text"), ("prefix", 'foo\\"x', "Len"),
                   ("constant", "bar", "Plain text")}
    outcomes = {(r["text"], r["outcome"]) for r in trace.collect()}
    assert ("A: %u B: %u", "Failed - Multiple colons") in outcomes
    assert ("%u left", "Failed - No colon before first percent") in outcomes
    assert ("Plain text", "Speculative") in outcomes
    write_rules(rules, str(tmp_path / "rules"))
    back = spark.read.format("xml").option("rowTag", "prefix").load(str(tmp_path / "rules" / "prefix")).collect()
    assert [(r["_protocol"], r["_text"]) for r in back] == [('foo\\"x', "Len")]


def test_mining_of_files(spark, tmp_path):
    """A corpus on disk: a header of many sources, names that can't be told, files outside the two sub-trees."""
    source = '#include "all.h"\nproto_register_protocol("L", "S", {name});\nproto_tree_add_text(t, v, 0, 1, "Own, \\"text\\" {n}", x);\n'
    files = {f"epan/dissectors/packet-s{i}.c": source.format(name=name, n=i)
             for i, name in enumerate(("NAME", "NAME", '"two"', "LOST", "LATE"))}
    files["epan/dissectors/all.h"] = ('#define NAME "first"\n#define NAME "last"\nstatic char LATE[] = "late";\n'
                                      'proto_tree_add_text(t, v, 0, 1, "Shared", x); proto_tree_add_text(t, v, 0, 1, "Shared", x);\n')
    files["epan/dissectors/packet-s4.c"] += '#define LATE "own"\n'
    files["plugins/deep/er/lost.c"] = 'proto_register_protocol("L", "S", LOST);\nproto_tree_add_text(t, v, 0, 1, "Nobody", x);\n'
    files["other/packet-no.c"] = 'proto_register_protocol("L", "S", "no");\nproto_tree_add_text(t, v, 0, 1, "Outside", x);\n'
    files["plugins/notes.txt"] = 'proto_register_protocol("L", "S", "txt");\n'
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    out = mine(read_corpus(spark, str(tmp_path)))
    rules = out.rules.where("kind = 'constant'").collect()
    shared = {r.protocol: r.seq.source[-4:] for r in rules if r.text == "Shared"}
    assert shared == {"last": "s0.c", "two": "s2.c", "s3": "s3.c", "own": "s4.c"}
    assert {r.protocol for r in rules if r.text.startswith("Own, ")} == {"last", "two", "s3", "own"} and len(rules) == 9
    assert {(r.file.split("/")[-1], r.reason) for r in out.rejects.collect()} == {
        (n, "unable to parse protocol name") for n in ("packet-s3.c", "lost.c")}
    write_trace(out.trace, str(tmp_path / "trace"))
    back = spark.read.options(header="true", escape='"').csv(str(tmp_path / "trace")).where("outcome = 'Constant'").collect()
    assert sorted((r.file.split("/")[-1], r.text, r.n) for r in back) == sorted(
        [("all.h", "Shared", "5")] * 2 + [(f"packet-s{i}.c", f'Own, \\"text\\" {i}', "1") for i in range(5)])
