"""Registered queries against their SQL, the pipeline stages on odd tables, and plans that must hold no Python."""

import collections
import hashlib
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd_rows import DOCS, ROWS
from treeshred.llm import mixing, queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    table = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        table.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    expected = table.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, DIR).toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    columns = sorted(got.columns)
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    assert order(got).equals(order(expected.astype(got.dtypes.to_dict())))


def test_pipeline(spark):
    source = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = corpus_pipeline.run(spark, DIR)
    assert rows.columns == ["doc_id", "ids", "n_tokens", "restored"] and rows.where("NOT restored").count() == 0
    assert 0 < rows.select("doc_id").distinct().count() <= source.count()


@pytest.mark.parametrize("step", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_tables(spark, step):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("n", F.lit(1))
    out = step(spark, docs, DIR)
    assert out.count() > 0
    if step is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns
    assert step(spark, docs.where("false"), DIR).count() == 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op7_licenses", "op10_mixing"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_language_query(spark):
    rows = queries.QUERIES["op1_language"](spark, "/root/testdata/sf0.01").collect()
    source = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(source)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == source[r.doc_id].lang for r in rows if r.held_out and len((source[r.doc_id].text or "").split()) >= 20]
    assert len(right) > 100 and sum(right) >= 0.95 * len(right)


def test_quality_query_agrees_with_labels(spark):
    found = queries.QUERIES["op6_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    same = [r.kept == bool(r.quality) for r in found.join(labels, "doc_id").collect()]
    assert len(same) > 300 and sum(same) >= 0.98 * len(same)


def base_spans(text):
    """The base kinds by Python's own regular expressions."""
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I, lambda m: len(m[2]) >= 8),
             ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 32)]
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, rule, flags, fits) in enumerate(kinds)
             for m in re.finditer(rule, text, flags | re.A) if fits(m)]
    return [s for *_, s in sorted(found)]


def test_secrets_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_secrets"](spark, DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        counts = collections.Counter(s.split(":")[0] for s in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_stages_keep_the_rows_of_brute_force(spark):
    """Exact and near dedup and the mix, each on what its predecessor keeps, against plain Python and SQL."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    exact = stages["exact dedup"](spark, docs, DIR)
    newest = {}
    for r in docs.collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        newest[text] = max(r.doc_id, newest.get(text, r.doc_id))
    assert ids(exact) == sorted(newest.values())
    near = stages["near dedup"](spark, exact, DIR)
    sets = {}
    for text, i in newest.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert ids(near) == sorted(i for i in sets if find(i) == i)
    table = duckdb.connect()
    table.register("documents", near.toPandas())
    expected = {r[0]: r[1] // r[2] for r in table.execute(f"SELECT doc_id, taken, size FROM ({mixing.OP10_SQL}) WHERE size > 0").fetchall()}
    mixed = collections.Counter(r.doc_id for r in stages["mix sources"](spark, near, DIR).where("text rlike '\\\\S'").collect())
    assert mixed == {i: n for i, n in expected.items() if n}
