"""Prefix trie of conversations: sorted shards finish their own nodes, a broadcast skeleton holds those that shards share."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.session import stage

HEADS_EVERY = 100
MAX_HEAD = 5
# Bytes of a turn's digest.
STEP = 16
# Shards, and turns of a splitter, at most: together they bound the skeleton, which is broadcast.
MAX_SHARDS = 2000
SPLITTER_TURNS = 256
SAMPLE_PER_SHARD = 20
PIECE_CHARS = 1 << 16
OUT_ROWS = 4096

NODE, PARTIAL, PIECE = 0, 1, 2
_OUT = ("kind int, skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, shard int, seq long, ids string")
_KINDS = [pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.string(), pa.int32(), pa.int64(), pa.string()]
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
NO_ENDS = hashlib.sha256().hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, digests, sizes: every conversation behind the head that its hundred shares, as turn digests and text lengths.

    Turns stand in order of turn, null first; equal turns in order of their digest. Of the conversation numbered
    conv_id - conv_id % 100 the first crc32(conv_id) % 6 turns come first, then its own turns after as many.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, STEP)
    turns = conversations.where(F.col("`conv_id`").isNotNull()).select(
        F.col("`conv_id`").cast("long").alias("conv_id"), F.struct(
            F.col("`turn`").isNotNull().alias("known"), F.col("`turn`").cast("long").alias("turn"), digest.alias("digest"),
            F.length(text).alias("size")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    own = stage(own.select("conv_id", F.col("t.digest").alias("digests"), F.col("t.size").alias("sizes")), "trie-own")
    heads = own.where(F.col("conv_id") % HEADS_EVERY == 0).select(
        F.col("conv_id").alias("head"), F.slice("digests", 1, MAX_HEAD).alias("h_digests"), F.slice("sizes", 1, MAX_HEAD).alias("h_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("int")
    rest = F.greatest(F.size("digests") - F.col("h"), F.lit(0))

    def joined(head: str, mine: str):
        first = F.when(F.col(head).isNotNull(), F.slice(head, F.lit(1), F.col("h"))).otherwise(F.slice(mine, 1, 0))
        return F.concat(first, F.slice(mine, F.col("h") + 1, rest)).alias(mine)

    return (own.join(heads, F.col("conv_id") - F.col("conv_id") % HEADS_EVERY == F.col("head"), "left").withColumn("h", h)
            .select("conv_id", joined("h_digests", "digests"), joined("h_sizes", "sizes")))


class Skeleton:
    """Splitters of the sorted paths, and the trie of their prefixes: every node that two shards may share, the root first."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            at = 0
            for i in range(0, len(path), STEP):
                key = (at, path[i:i + STEP])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.child[key]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Up to ``shards`` - 1 places that cut the order of (path, conv_id) about evenly, from a bounded sample.

    The sample, SAMPLE_PER_SHARD rows a shard and SPLITTER_TURNS turns a row, only balances shards: any splitters give the same
    result. As the id is part of a splitter, copies of one conversation are spread, too.
    """
    few = (paths.select("conv_id", F.slice("digests", 1, SPLITTER_TURNS).alias("digests"), F.xxhash64("conv_id").alias("o"))
           .orderBy("o", "conv_id").limit(SAMPLE_PER_SHARD * shards).collect())
    found = sorted((b"".join(map(bytes, r.digests)), r.conv_id) for r in few)
    return sorted({found[k * len(found) // shards] for k in range(1, shards)}) if found else []


class _Open:
    """A node on the path of the row at hand, with what its members have added so far."""

    __slots__ = ("skeleton", "size", "first", "n_convs", "n_children", "n_leaves", "saved", "ends", "pending")

    def __init__(self, skeleton: int, size: int):
        self.skeleton, self.size, self.first = skeleton, size, None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.ends, self.pending = None, []


class _Walk:
    """One sorted shard: opens and closes nodes, and puts out rows of three kinds (see ``_OUT``)."""

    def __init__(self, skeleton: Skeleton, shard: int, out: list[tuple]):
        self.skeleton, self.shard, self.out = skeleton, shard, out
        self.path, self.stack = b"", [_Open(0, 0)]

    def add(self, path: bytes, sizes: list[int], conv_id: int) -> None:
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same:same + STEP] == self.path[same:same + STEP]:
            same += STEP
        self.close_to(same // STEP)
        for i in range(same, len(path), STEP):
            above = self.stack[-1].skeleton
            self.stack.append(_Open(self.skeleton.child.get((above, path[i:i + STEP]), -1) if above >= 0 else -1, sizes[i // STEP]))
        self.path = path
        last = self.stack[-1]
        last.n_convs += 1
        last.first = conv_id if last.first is None else min(last.first, conv_id)
        if last.skeleton < 0:
            # Members that end here come in order of their ids.
            last.ends = last.ends or hashlib.sha256()
            last.ends.update(f"{',' if last.n_convs > 1 else ''}{conv_id}".encode())
        else:
            last.pending.append(str(conv_id))
            if len(last.pending) * 8 >= PIECE_CHARS:
                self.piece(last)

    def piece(self, node: _Open) -> None:
        ids = ",".join(node.pending)
        self.out.append((PIECE, node.skeleton, *[None] * 8, self.shard, len(self.out) + (node.n_convs << 20), ids))
        node.pending = []

    def close_to(self, depth: int) -> None:
        while len(self.stack) - 1 > depth:
            self.close()

    def close(self) -> None:
        node, above = self.stack.pop(), self.stack[-1] if self.stack else None
        depth = len(self.stack)
        if above is not None:
            above.n_convs += node.n_convs
            above.first = node.first if above.first is None else min(above.first, node.first)
        if node.skeleton >= 0:
            if node.pending:
                self.piece(node)
            self.out.append((PARTIAL, node.skeleton, node.first, node.size, None, node.n_convs, node.n_children, node.n_leaves,
                             node.saved, *[None] * 4))
            return
        leaves = node.n_leaves if node.n_children else 1
        saved = node.saved + (node.n_convs - 1) * node.size
        above.n_children += 1
        above.n_leaves += leaves
        above.saved += saved
        self.out += [(*r[:4], node.first, *r[5:]) for r in node.pending]
        row = (NODE, None, node.first, depth, None, node.n_convs, node.n_children, leaves, saved,
               node.ends.hexdigest() if node.ends else NO_ENDS, None, None, None)
        if above.skeleton < 0:
            # Its row waits for the smallest member of the node above.
            above.pending.append(row)
        else:
            self.out.append((row[0], above.skeleton, *row[2:]))


def walk_shards(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of skeleton nodes and pieces of their end lists, shard by shard."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            whole = [b"".join(d) for d in batch.column(1).to_pylist()]
            shard = [shared.value.shard(p, c) for p, c in zip(whole, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(whole, pa.binary()), batch.column(0), batch.column(2)],
                                             names=["shard", "path", "conv_id", "sizes"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, out = None, []
        for batch in batches:
            for shard, path, conv_id, sizes in zip(*[c.to_pylist() for c in batch.columns]):
                if walk is None or walk.shard != shard:
                    if walk is not None:
                        walk.close_to(-1)
                    walk = _Walk(shared.value, shard, out)
                walk.add(path, sizes, conv_id)
                if len(out) >= OUT_ROWS:
                    yield _rows(out)
                    out.clear()
        if walk is not None:
            walk.close_to(-1)
        if out:
            yield _rows(out)

    placed_rows = paths.mapInArrow(placed, "shard int, path binary, conv_id long, sizes array<int>")
    return (placed_rows.repartitionById(len(skeleton.splitters) + 1, F.col("shard"))
            .sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walked, _OUT))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], names=_NAMES)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's end list, whose sorted pieces stream by."""
    last, sha = None, None
    for batch in batches:
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != last:
                if last is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([sha.hexdigest()])], names=["skeleton", "ends"])
                last, sha = node, hashlib.sha256()
                sha.update(ids.encode())
            else:
                sha.update(f",{ids}".encode())
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([sha.hexdigest()])], names=["skeleton", "ends"])


def _roll_up(skeleton: Skeleton, partials: list) -> list[tuple]:
    """Skeleton nodes from their reduced aggregates: children are numbered after their parents, so one pass upward adds them up."""
    by_id = {r.skeleton: r for r in partials}
    n = len(skeleton.parent)
    children, leaves, saved = ([0] * n for _ in range(3))
    rows = []
    for k in range(n - 1, -1, -1):
        if k not in by_id:
            continue
        r, up = by_id[k], skeleton.parent[k]
        children[k] += r.n_children
        leaves[k] = leaves[k] + r.n_leaves if children[k] else 1
        saved[k] += r.saved + (r.n_convs - 1) * r.size
        rows.append((k, r.first, skeleton.depth[k], by_id[up].first if up >= 0 else None, r.n_convs, children[k], leaves[k], saved[k]))
        if up >= 0:
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    return rows


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A turn is its role and whole text, null as empty; conversations are rebuilt as ``rebuilt`` says. A node is a distinct sequence of
    first turns, its members the conversations that start with it; the root, without turns, has all. Rows without conv_id are left out. Repeated
    rows are turns of their own. An empty table gives an empty result; extra columns are dropped.

    Paths of turn digests (128 bits a turn) are sorted into shards between sampled splitters. A node that lies in two shards is a prefix of a
    splitter: the trie of splitter prefixes is the skeleton, at most MAX_SHARDS * SPLITTER_TURNS + 1 nodes, and is broadcast. Every
    other node lies in one shard and is finished there, in one pass that holds the path of one conversation. Of skeleton nodes each
    shard gives partial aggregates, which are reduced to one row a node and then added up along the
    skeleton. Lists of member ids that end at a skeleton node come in pieces and stream through one digest each. A conversation is
    one row of digests, some 20 bytes a turn; its texts are not moved.
    """
    spark = conversations.sparkSession
    paths = stage(rebuilt(conversations), "trie-paths")
    shards = max(1, min(MAX_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    skeleton = Skeleton(splitters(paths, shards))
    walked = stage(walk_shards(paths, skeleton), "trie-walked")
    partials = (walked.where(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("first"), F.max("depth").alias("size"),
        *[F.sum(c).alias(a) for c, a in (("n_convs", "n_convs"), ("n_children", "n_children"), ("n_leaves", "n_leaves"), ("saved_tokens", "saved"))]))
    # One row for each skeleton node.
    rows = _roll_up(skeleton, partials.collect())
    top = spark.createDataFrame(rows, "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                      "n_leaves long, saved_tokens long")
    pieces = (walked.where(F.col("kind") == PIECE).select("skeleton", "shard", "seq", "ids").repartition("skeleton")
              .sortWithinPartitions("skeleton", "shard", "seq").select("skeleton", "ids"))
    ends = pieces.mapInArrow(_hashed, "skeleton int, ends string")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = top.join(ends, F.col("node") == F.col("skeleton"), "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    firsts = F.broadcast(top.select(F.col("node").alias("skeleton"), F.col("conv_id").alias("above")))
    own = (walked.where(F.col("kind") == NODE).join(firsts, "skeleton", "left")
           .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")))
    return own.select(*out).unionAll(shared.select(*out))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# CRC-32 of the decimal id: the reflected polynomial 3988292384, eight steps a byte.
OP12_SQL = """
WITH turns AS (
  SELECT conv_id, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) AS i, g
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '')
        || coalesce(text, '')), 1, 32) AS g FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''),
           lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce([1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[],
           lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
joined AS (
  SELECT c.conv_id, 0 AS part, t.i, t.g, t.n FROM convs AS c JOIN turns AS t ON t.conv_id = c.head AND t.i <= c.h
  UNION ALL SELECT c.conv_id, 1, t.i, t.g, t.n FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.i > c.h),
member AS (
  SELECT conv_id, row_number() OVER w AS depth, n, string_agg(g, '') OVER w AS k FROM joined
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
node AS (SELECT k, depth, substr(k, 1, 32 * (depth::BIGINT - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n
         FROM member GROUP BY k, depth),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY up),
below AS (SELECT m.k, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((node.n_convs - 1) * node.n)::BIGINT AS saved
          FROM node LEFT JOIN kids ON kids.k = node.k JOIN member AS m ON m.conv_id = node.conv_id AND m.depth <= node.depth GROUP BY m.k),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
         FROM (SELECT conv_id, k FROM member QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY k)
SELECT node.conv_id, node.depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children, below.n_leaves,
       below.saved AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node JOIN below ON below.k = node.k LEFT JOIN kids ON kids.k = node.k LEFT JOIN ends ON ends.k = node.k
LEFT JOIN node AS p ON p.k = node.up AND node.depth > 0
"""
