"""Line deduplication against brute force on odd and made-up tables."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from odd_rows import DOCS, ROWS
from treeshred.llm import line_dedup


def brute(rows, min_chars=10, min_docs=2):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = collections.defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            ids = held[key(line)]
            first = min((i for i in ids if i is not None), default=None)
            if len(key(line)) < min_chars or len(ids) < min_docs or doc_id == first:
                keep.append(line)
        out.append((doc_id, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def result(docs, **options):
    found = line_dedup.drop_lines(docs, **options)
    return sorted(map(tuple, found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()), key=str)


def made():
    pick = random.Random(3)
    lines = ["a common line of text", "  A Common LINE of text\t", "short", "nine char", "ten  chars", "日本語日本語日本語日", "日本語日本語日本語", "",
             " ", "É accented line", "é accented line", "x " * 8, " " + "x " * 8, "line\r", "carriage return\r"]
    return [(i if i % 11 else None, "\n".join(pick.choices([*lines, f"only in {i}"], k=pick.randint(0, 12))), None, None)
            for i in range(200)]


@pytest.mark.parametrize("options", [{}, {"min_chars": 4, "min_docs": 3}, {"min_docs": 1}])
def test_equals_brute_force(spark, options):
    rows = ROWS + made() + made()[:20]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    for c in ("th", "places", "key", "kept"):
        docs = docs.withColumn(c, F.lit("mine"))
    assert result(docs, **options) == brute(rows, **options)


def test_empty_table_and_frequent_line(spark):
    assert line_dedup.drop_lines(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, f"the same line everywhere\nline number {i}\nthe same line everywhere", None, None) for i in range(500)]
    found = line_dedup.drop_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert {(r.n_dropped, r.kept == f"line number {r.doc_id}") for r in found if r.doc_id} == {(2, True)}
    assert [r.n_dropped for r in found if r.doc_id == 0] == [0]


def test_whole_long_text(spark):
    rows = [(1, "\n".join(f"long text line {i}" for i in range(50_000)), None, None), (2, "long text line 49999\nother", None, None)]
    assert result(spark.createDataFrame(rows, DOCS)) == brute(rows)
