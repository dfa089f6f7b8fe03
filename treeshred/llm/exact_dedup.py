"""Exact deduplication by deterministic block naming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import each_text, fold, plain, read_documents, without_marked
from treeshred.session import stage

BLOCK_BYTES = 512
OUT_ROWS = 4096

_BLOCKS = "doc_id long, k1 long, k2 long, pos long, sha binary, item binary"
_NAMED = "doc_id long, k1 long, k2 long, pos long, n long, sha binary, part int, local long, edge binary, runs long"


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Normalise whole texts and cut them into fixed-size blocks."""
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int64()),
                        ("sha", pa.binary()), ("item", pa.binary())])
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        for doc_id, text in zip(ids, each_text(batch)):
            data = fold(text)
            sha = hashlib.sha256(data).digest()
            k1, k2 = np.frombuffer(sha[:16], "<i8").tolist()
            for pos in range(max(1, -(-len(data) // block_bytes))):
                rows.append((doc_id, k1, k2, pos, None if pos else sha, data[pos * block_bytes:(pos + 1) * block_bytes]))
            if len(rows) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal items in one sorted partition; its first and last row carry the item and the runs so far."""
    part = TaskContext.get().partitionId()
    keep = ["doc_id", "k1", "k2", "pos", "n", "sha"]
    last, run, held = None, -1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        item = batch.column(batch.schema.get_field_index("item"))
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(item.slice(1), item.slice(0, len(item) - 1)).to_numpy(zero_copy_only=False)
        first = run < 0
        new[0] = first or item[0].as_py() != last
        local = run + np.cumsum(new, dtype=np.int64)
        run, last = int(local[-1]), item[-1].as_py()
        if held is not None:
            yield _out(held, keep, part, None)
        held = (batch, local, item[0].as_py() if first else None)
    if held is not None:
        yield _out(held, keep, part, (last, run + 1))


def _out(held, keep: list[str], part: int, end) -> pa.RecordBatch:
    batch, local, first = held
    n = batch.num_rows
    edge, runs = [None] * n, [None] * n
    if first is not None:
        edge[0], runs[0] = first, 1
    if end is not None:
        # A partition of one row has one edge, which is first and last.
        edge[-1], runs[-1] = end
    return pa.RecordBatch.from_arrays(
        [*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(np.full(n, part, np.int32)),
         pa.array(local), pa.array(edge, pa.binary()), pa.array(runs, pa.int64())],
        names=[*keep, "part", "local", "edge", "runs"])


def _named(items: DataFrame, label: str) -> DataFrame:
    """Replace ``item`` by its rank among all distinct items, ``name``, from 0.

    One range shuffle sorts the items; document and position are part of
    the sort key, so that an item that fills a third of all rows is spread over
    partitions. Each partition numbers its runs of equal items and writes them.
    What the driver sees is the first and last item of each partition: two
    rows per shuffle partition, however many items there are. From these follow the number of runs
    before a partition and whether its first run goes on from the one before.
    """
    spark = items.sparkSession
    sort = ["item", "doc_id", "k1", "k2", "pos"]
    rows = stage(items.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(_number, _NAMED), label)
    edges = rows.where("edge IS NOT NULL").select("part", "local", "edge", "runs").collect()
    shifts, offset, before = [], 0, None
    by_part: dict[int, list] = {}
    for row in edges:
        by_part.setdefault(row.part, []).append(row)
    for part in sorted(by_part):
        ends = sorted(by_part[part], key=lambda r: r.local)
        goes_on = before is not None and bytes(ends[0].edge) == before
        offset -= goes_on
        shifts.append((part, offset))
        offset, before = offset + max(r.local for r in ends) + 1, bytes(ends[-1].edge)
    # One row per shuffle partition.
    table = spark.createDataFrame(shifts, "part int, shift long")
    return rows.join(F.broadcast(table), "part").withColumn("name", F.col("local") + F.col("shift")).select(
        "doc_id", "k1", "k2", "pos", "n", "sha", "name")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n (equal rows with this id), sha, and its identity ``level``, ``name``.

    Texts are lower-cased A-Z only, null counts as empty, and cut into blocks
    of ``block_bytes`` UTF-8 bytes. Distinct blocks are sorted and named by
    their rank; then adjacent names (a last one without partner is paired with none) are
    named again, until every document has one name left. A document of level
    L has between 2^(L-1) and 2^L blocks, and within a level equal names mean
    equal texts: no two texts share an identity. Levels follow the
    logarithm of the longest text; each has half the rows of the one before.

    Rows of a document are kept together by its id and 128 bits of a digest;
    so repeated and null ids do no harm. Repeated rows of one id and text are
    counted in ``n``. An empty table gives an empty result.
    """
    cut = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = cut.mapInArrow(lambda b: _cut(b, block_bytes), _BLOCKS).withColumn("n", F.lit(1).cast("long"))
    level, done, names = 0, [], _named(blocks, "dedup-0")
    key = ["doc_id", "k1", "k2"]
    while True:
        pair = names.groupBy(*key, F.floor(F.col("pos") / 2).alias("half")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"),
            F.sum(F.when(F.col("pos") % 2 == 0, F.col("n"))).alias("n"), F.max("sha").alias("sha"),
        )
        pairs = stage(pair, f"dedup-pairs-{level}")
        # A document of one name: its first pair has no right half.
        whole = (F.col("half") == 0) & F.col("right").isNull()
        done.append(pairs.where(whole).select("doc_id", "n", "sha", F.lit(level).alias("level"), F.col("left").alias("name")))
        rest = pairs.where(~whole)
        if rest.isEmpty():
            break
        level += 1
        items = rest.select(*key, F.col("half").alias("pos"), "sha", "n", F.concat(
            F.unhex(F.lpad(F.hex("left"), 16, "0")),
            F.unhex(F.lpad(F.hex(F.coalesce("right", F.lit(-1))), 16, "0"))).alias("item"))
        names = _named(items, f"dedup-{level}")
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays, of repeated rows of that id
    one. A group without any id keeps one row. See ``identities`` for nulls,
    empty and very long texts, repeated rows and empty tables.
    """
    named = stage(identities(docs, block_bytes), "dedup-names")
    groups = stage(named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")),
                   "dedup-groups")
    rows = named.join(groups, ["level", "name"]).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, that of the largest doc_id, columns unchanged.

    Block names decide on narrow rows which (doc_id, digest) go; the rows themselves are joined once with these
    (``without_marked``). Repeated rows of one id and text are reduced to the one whose columns have the largest digest. Extra
    columns of any name are kept.
    """
    named = stage(identities(docs), "copies-names")
    groups = named.groupBy(F.col("level").alias("g_level"), F.col("name").alias("g_name")).agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("size")).where("size > 1")
    marks = (named.join(groups, (F.col("level") == F.col("g_level")) & (F.col("name") == F.col("g_name")))
             .select("doc_id", F.col("sha").alias("th"), F.col("n").alias("times"), (~F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("goes"))
             .where("goes OR times > 1"))
    fold_ascii = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return without_marked(docs, F.unhex(F.sha2(fold_ascii, 256)), stage(marks, "copies-marks"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_documents(spark, sf_dir))


OP4_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
