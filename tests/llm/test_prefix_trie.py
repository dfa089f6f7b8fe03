"""Prefix trie of conversations: brute force with many and few shards, odd tables."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from treeshred.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv_id].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + mine[h:])
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for node, held in members.items():
        below = [x for x in members if x[:len(node)] == node]
        parents = {x[:-1] for x in members if x}
        ends = ",".join(map(str, sorted(c for c in held if paths[c] == node)))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held),
                    sum(len(x) == len(node) + 1 for x in below), sum(x not in parents for x in below),
                    sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=300, ids=range(-150, 700)):
    pick = random.Random(seed)
    rows, texts = [], ["", "a", "bé", "日本", "x" * 40]
    for c in pick.sample(list(ids), n):
        for turn in range(pick.randint(0, 9) if c % 5 else 7):
            # Five equal conversations of six, so that some have copies.
            same = pick.random() < 0.8
            rows.append((c, turn, ("user", "assistant")[turn % 2], "same" if same else pick.choice(texts)))
    return rows


@pytest.mark.parametrize("shards", ["1", "3", "40"])
def test_equals_brute_force(spark, shards):
    rows = made(1) + [(7000, None, None, None), (7000, 3, "user", None), (7000, 3, "user", None), (7000, 3, "", "b"), (None, 1, "user", "x"),
                      (9223372036854775807, 1, "user", "same"), (8001, 0, None, "z")]
    turns = spark.createDataFrame(rows, TURNS).repartition(4).withColumn("shard", F.lit("mine")).withColumn("digests", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        got = sorted(map(tuple, prefix_trie.prefix_trie(turns).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(rows)


def test_copies_spread_over_shards_keep_one_list(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 16)
    rows = [(c, t, "user", f"t{t}") for c in range(400) for t in range(8)] + [(c, 0, "user", "only") for c in range(400, 420)]
    got = sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == brute(rows)


def test_cut_splitters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 2)
    rows = made(5)
    got = sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_one_long_conversation(spark):
    rows = [(1, t, "user", "x" * (t % 3)) for t in range(5000)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()
    assert len(found) == 5001 - (zlib.crc32(b"1") % 6) and max(r.depth for r in found) == len(found) - 1
    assert all(r.n_leaves == 1 and r.saved_tokens == 0 and r.conv_id == 1 for r in found)
