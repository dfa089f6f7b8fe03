"""Source divergence: brute force, several rounds and blocks, odd tables; perfect hashes."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd_rows import DOCS, ROWS
from treeshred.llm import divergence, perfect_hash


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source in rows]
    spread = collections.Counter((lang, t) for lang, _, found in docs for t in set(found))
    kept = collections.defaultdict(set)
    for (lang, t), n in spread.items():
        if n >= min_docs:
            kept[lang].add(t)
    counts, whole = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, found in docs:
        counts[lang, source].update(t for t in found if t in kept[lang])
        whole[lang].update(t for t in found if t in kept[lang])

    def share(counter, lang, t):
        return 1 + 10**9 * (counter[t] + 5) // (sum(counter.values()) + 5 * len(kept[lang]))

    out = []
    for (lang, source), mine in counts.items():
        pairs = [(-sum(abs(share(mine, lang, t) - share(other, lang, t)) for t in kept[lang]), name.encode(), name)
                 for (at, name), other in counts.items() if at == lang and name != source]
        words = [(share(whole[lang], lang, t) - share(mine, lang, t), t.encode(), t) for t in kept[lang] if mine[t]]
        words = [w for w in words if w[0] < 0]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
            out += [(lang, source, part, name, -value, k + 1) for k, (value, _, name) in enumerate(found)]
    return sorted(out)


def made(n=400):
    words = [f"{a}{b}" for a in ("Ba", "ce", "dí", "Fo", "日", "gu") for b in ("n", "ré", "X", "t", "zz")]
    pick = np.random.default_rng(7)
    return [(i, " 1,".join(words[int(k)] for k in pick.zipf(1.3, 30) % len(words)) if i % 9 else None,
             (None, "en", "de", "xx")[i % 4], None if i % 7 == 0 else f"s{i % 7}" if i % 3 else "hot") for i in range(n)]


@pytest.mark.parametrize("min_docs, top", [(30, 5), (1, 50), (10_000, 50)])
def test_equals_brute_force(spark, min_docs, top):
    rows = made() + ROWS
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("n", F.lit("mine")).withColumn("shard", F.lit(1))
    got = sorted(map(tuple, divergence.source_divergence(docs, min_docs, top).collect()))
    assert got == brute(rows, min_docs, top) and got


def test_rounds_and_blocks_change_nothing(spark, monkeypatch):
    rows = made()
    for name, value in (("ROUND_BYTES", 60), ("KEYS_PER_SHARD", 4), ("SOURCES_PER_BLOCK", 2), ("SALTS", 2)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted(map(tuple, divergence.source_divergence(docs, 5, 9).collect())) == brute(rows, 5, 9)


def test_empty_table(spark):
    assert divergence.source_divergence(spark.createDataFrame([], DOCS)).count() == 0


def test_whole_texts_in_slices(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 7)
    text = "One two-three FOUR5six, sevenéight nine " * 5
    assert [t.decode() for some in divergence.terms(text) for t in some] == ["one", "two", "three", "four", "six", "sevenéight", "nine"] * 5


@pytest.mark.parametrize("below", [10**6, 1 << 60])
def test_shares_are_exact(below):
    counts = np.array([0, 1, 17, below // 3, below - 10], np.int64)
    assert divergence.shares(counts, below, 2).tolist() == [1 + 10**9 * (int(c) + 5) // (below + 10) for c in counts]


@pytest.mark.parametrize("n", [1, 2, 5, 3000])
def test_perfect_hash(n):
    keys = [f"key{i}".encode() for i in range(n)]
    shift, slots = perfect_hash.build(*perfect_hash.digests(keys))
    assert sorted(slots) == list(range(n))
    order = [None] * n
    for key, slot in zip(keys, slots):
        order[slot] = key
    table = perfect_hash.Shards(1, [(0, n, shift, pa.array(order, pa.large_binary()))])
    assert table.find(keys).tolist() == slots.tolist()
    assert (table.find([f"other{i}".encode() for i in range(500)]) == -1).all()
