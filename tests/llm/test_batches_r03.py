"""Rows with whole texts that are in Python at a time."""

import pyarrow as pa

import corpus_pipeline as P
from treeshred.llm import bpe, common


def test_texts_come_as_strings_a_few_at_a_time():
    texts = [None if i % 7 == 0 else f"t{i}" for i in range(3 * common.TEXT_ROWS + 5)]
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert list(common.each_text(whole)) == list(common.each_text(whole.slice(0))) == texts
    assert list(common.each_text(whole.slice(0, 0))) == []


def test_tokens_are_made_of_few_rows_at_a_time(monkeypatch):
    class Encoder:
        def ids(self, texts):
            return pa.array(range(len(texts))).to_numpy(), pa.array(range(len(texts) + 1)).to_numpy()

    monkeypatch.setattr(bpe, "load", lambda file, packed: (None, Encoder()))
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": ["x"] * 1000})
    parts = [part for part, *_ in bpe._encoded(iter([whole]), None, b"")]
    assert max(p.num_rows for p in parts) <= common.TEXT_ROWS
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(1000))


def test_batches_of_the_pipeline_are_small(spark, tmp_path, monkeypatch):
    spark.range(5000).selectExpr("id AS doc_id", "'a' AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(session, docs, sf_dir):
        def count(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

        return docs.coalesce(1).mapInArrow(count, "n long")

    monkeypatch.setattr(P, "STAGES", [("sizes", sizes), ("same", lambda session, docs, sf_dir: docs)])
    found = [r[0] for r in P.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 5000 and max(found) <= 2000 and spark.conf.get(name) == before
