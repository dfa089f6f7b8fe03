"""MinHash near-duplicates by an inverted join over signature coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import checked_broadcast, each_text, fold, plain, read_documents, rows_per_batch, text_column, without_marked
from treeshred.llm.components import components
from treeshred.session import stage

WORDS = 5
PERCENT = 80
# A coordinate is the smallest hashes under HASHES functions together. Unrelated texts, which share some common shingles,
# hardly ever agree in one, and texts that share half of theirs agree in one of 64. A pair of
# similarity 0.8 agrees in 17 on average, in fewer than 3 once in a million times.
COORDINATES = 64
HASHES = 6
MATCHES = 3
MAX_CACHED_WORDS = 100_000
# Leader rounds go on while the pairs still open outnumber the classes by this factor and the last round settled half of them.
OPEN_PER_CLASS = 2
MAX_LEADER_ROUNDS = 6
# Sizes of sets that meet under one shingle lie within one such step.
SIZE_STEP = 1.02
# Rows with two texts that go to Python at a time.
TEXT_PAIRS = 256

_SKETCH = "doc_id long, th long, n long, h1 long, h2 long, sig array<long>"
_MULTIPLY = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 31, COORDINATES * HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = np.random.Generator(np.random.PCG64(80)).integers(0, 1 << 32, COORDINATES * HASHES).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str | None, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a whole text; a text of fewer words is one shingle, one without words none."""
    found = fold(text).split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array(list(map(known.__getitem__, found)), np.uint64)
    take = min(words, len(found))
    value = np.full(len(found) - take + 1, take, np.uint64)
    for i in range(take):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - take + 1 + i])
    return np.unique(value)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Coordinates of a set: smallest hashes, HASHES of them mixed into one value, the coordinate in its low bits.

    So values of two coordinates never meet.
    """
    low = np.full(COORDINATES * HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 256):
        hashed = short[at:at + 256, None] * _MULTIPLY
        hashed += _ADD
        np.minimum(low, hashed.min(axis=0), out=low)
    value = np.zeros(COORDINATES, np.uint64)
    for part in low.reshape(HASHES, COORDINATES).astype(np.uint64):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(1))
    return (value & ~np.uint64(COORDINATES - 1)) | np.arange(COORDINATES, dtype=np.uint64)


def _sketches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    known = _WordHashes()
    for batch in batches:
        n, h1, h2, sigs = [], [], [], []
        for text in each_text(batch):
            if len(known) > MAX_CACHED_WORDS:
                known.clear()
            shingles = shingle_hashes(text, words, known)
            n.append(len(shingles))
            h1.append(_mixed(shingles + np.uint64(1)).sum(dtype=np.uint64))
            h2.append(_mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            sigs.append(signature(shingles).view(np.int64) if len(shingles) else None)
        full = [s for s in sigs if s is not None]
        ends = np.cumsum([0 if s is None else COORDINATES for s in sigs])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                         pa.array(np.concatenate(full) if full else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
             pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)), lists],
            names=["doc_id", "th", "n", "h1", "h2", "sig"])
    pa.default_memory_pool().release_unused()


def _small_enough(percent: int):
    """Sets whose sizes differ too much can't be similar."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def prefixes(classes: DataFrame) -> DataFrame:
    """rid, n, reach, values: a class's coordinate values that other classes have too, rarest first, as far as pairs need them.

    Two signatures that agree in MATCHES coordinates share one of their
    COORDINATES - MATCHES + 1 rarest values. Values
    of one class alone are its rarest and link nothing; they only fill places. The long
    lists of common values are so never merged.
    """
    values = classes.select("rid", F.explode("sig").alias("value"))
    common = stage(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-common")
    held = values.join(common, "value").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"))
    # At most COORDINATES entries a list.
    places = COORDINATES - MATCHES + 1 - (COORDINATES - F.size("held"))
    found = (held.where(places > 0)
             .select("rid", F.aggregate("held", F.lit(0).cast("long"), lambda s, x: s + x["df"]).alias("reach"),
                     F.transform(F.slice("held", 1, places), lambda x: x["value"]).alias("values")))
    return found.join(classes.select("rid", "n"), "rid")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, label: str) -> DataFrame:
    """Pairs (a, b) whose signatures agree often enough and whose full shingle sets are similar."""
    side = [classes.select(F.col("rid").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab"]
    close = stage(pairs.join(side[0], "a").join(side[1], "b")
                  .where(F.size(F.array_intersect("sig_a", "sig_b")) >= MATCHES).select("a", "b"), f"{label}-close")
    wanted = close.select(F.col("a").alias("rid")).unionAll(close.select(F.col("b").alias("rid"))).distinct()
    wanted = stage(classes.join(wanted, "rid", "left_semi").select("rid", "rep"), f"{label}-wanted")
    # Texts are fetched for these classes alone.
    texts = stage(_representatives(wanted, docs).groupBy("rid").agg(F.first("text").alias("text")), f"{label}-texts")
    both = (close.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, frozenset()
        for batch in batches:
            keep = []
            for one, other in zip(text_column(batch, "text_a"), text_column(batch, "text_b")):
                if other != last:
                    last, held = other, shingles(other, words)
                mine = shingles(one, words)
                shared = len(mine & held)
                keep.append(100 * shared >= percent * (len(mine) + len(held) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    with rows_per_batch(close.sparkSession, TEXT_PAIRS):
        return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(similar, "a long, b long"), f"{label}-links")


def shingles(text: str | None, words: int) -> frozenset:
    """The exact shingle set of a text."""
    found = fold(text).split()
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(*[found[i:] for i in range(words)]))


def _labelled(postings: DataFrame, links: DataFrame, label: str) -> DataFrame:
    roots = components(links, label)
    return (postings.drop("comp").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
            .withColumn("comp", F.coalesce("root", "rid")).drop("root"))


def _representatives(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """rid, text: the text of each class's representative, once for each row that repeats it.

    ``classes`` is a written table.
    """
    return (docs.join(checked_broadcast(classes), F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("th") == F.col("rep.th")))
            .select("rid", "text"))


def _rare_pairs(members: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (rid, comp) in different components that meet in a shingle rare enough for similar sets.

    Shingles are ordered by the number of members that hold them. If the first one that two sets share stands at places i and j, at
    most n_a - i and n_b - j are shared, and similar sets share percent / (100 + percent) of both sizes: so each place has a largest
    partner, which falls along the set, and common shingles at its end have none. A set is posted under its own size for partners
    as large or larger, and under the sizes of smaller ones that its place allows, sizes in steps of SIZE_STEP. In a large group of texts that
    each differ from one original by more than the threshold allows, only the differences are posted, so the group doesn't meet as a
    whole. The condition is exact: no similar pair is left out.
    """
    members = stage(members.join(classes.select("rid", "n", "rep"), "rid"), "near-members-open")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), each_text(batch)):
                if len(known) > MAX_CACHED_WORDS:
                    known.clear()
                found = shingle_hashes(text, words, known).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), rid, np.int64)), pa.array(found)], names=["rid", "h"])

    texts = _representatives(members.select("rid", "rep"), docs)
    rows = stage(texts.mapInArrow(exploded, "rid long, h long"), "near-open-shingles")
    common = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # One list of a set's own shingles; a set, as rows may repeat.
    held = (rows.join(common, "h").groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("df", "h"))).alias("held"))
            .join(members.select("rid", "n", "comp"), "rid"))
    least = F.ceil(F.col("n") * percent / 100)
    alone = F.col("n") - F.size("held")
    places = F.greatest(F.col("n") - least + 1 - alone, F.lit(0)).cast("int")
    posted = (held.select("rid", "n", "comp", alone.alias("alone"), least.alias("least"), F.posexplode(F.slice("held", F.lit(1), places)).alias("at", "x"))
              .withColumn("most", F.floor((F.col("n") - F.col("alone") - F.col("at")) * (100 + percent) / percent) - F.col("n"))
              .where("most >= least").withColumn("h", F.col("x.h")))
    posted = stage(posted.select("rid", "n", "comp", "h", "least", "most"), "near-open-postings")

    def size_class(n) -> Column:
        return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / math.log(SIZE_STEP)).cast("int")

    names = ("rid", "n", "comp", "most")
    own = posted.where("most >= n").select("h", size_class(F.col("n")).alias("size"), *[F.col(c).alias(f"{c}_a") for c in names])
    larger = posted.select("h", F.explode(F.sequence(size_class(F.col("least")), size_class(F.least("most", "n")))).alias("size"),
                           *[F.col(c).alias(f"{c}_b") for c in names])
    return (own.join(larger, ["h", "size"])
            .where((F.col("comp_a") != F.col("comp_b")) & (F.col("n_a") <= F.col("most_b")) & (F.col("n_b") <= F.col("most_a"))
                   & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("rid_a") < F.col("rid_b")))))
            .select(F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b")))


def _open_pairs(postings: DataFrame) -> DataFrame:
    """value, n_open: pairs of different components under each coordinate value that has any."""
    sizes = postings.groupBy("value", "comp").agg(F.count(F.lit(1)).alias("m"))
    return (sizes.groupBy("value").agg(F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("same"))
            .withColumn("n_open", (F.col("all") * F.col("all") - F.col("same")) / 2)
            .where("n_open > 0").select("value", "n_open"))


def class_links(classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: links between classes that connect all that are similar, without all pairs of a large group.

    Leader rounds compare each class under a coordinate value with one other, so their pairs are at
    most the postings. Then the classes that share a value with one of another component are compared with each other, as far as their
    rarest shingles let them be similar (``_rare_pairs``): a pair within one component could only repeat what is known. So no link between
    components is lost.
    """
    held = stage(prefixes(classes), "near-prefixes")
    postings = held.select("rid", "n", "reach", F.explode("values").alias("value")).withColumn("comp", F.col("rid"))
    found, tested, n_classes, before = [], None, classes.count(), 0
    for step in range(MAX_LEADER_ROUNDS):
        # The first leader is the class that shares most with others, later ones are any.
        order = F.col("reach") if step == 0 else F.xxhash64("rid", "value", F.lit(step))
        postings = stage(postings, f"near-postings-{step}")
        open_pairs = stage(_open_pairs(postings), f"near-open-{step}")
        if open_pairs.isEmpty():
            break
        total = open_pairs.agg(F.sum("n_open")).first()[0]
        if step and (total <= OPEN_PER_CLASS * n_classes or 2 * total > before):
            break
        before = total
        live = postings.join(open_pairs.select("value"), "value", "left_semi")
        leaders = stage(live.groupBy("value").agg(F.max(F.struct(order.alias("o"), "rid", "n", "comp")).alias("top")),
                        f"near-leaders-{step}")
        pairs = (live.join(leaders, "value").where(F.col("comp") != F.col("top.comp"))
                 .select(F.col("rid").alias("a"), F.col("top.rid").alias("b"), F.col("n").alias("n_a"), F.col("top.n").alias("n_b"))
                 .where(_small_enough(percent)).select("a", "b"))
        pairs = stage(pairs.distinct(), f"near-pairs-{step}")
        found.append(_verify(pairs, classes, docs, words, percent, f"near-{step}"))
        tested = pairs if tested is None else tested.unionAll(pairs)
        postings = _labelled(postings, _all(found), f"near-components-{step}")
    else:
        postings = stage(postings, "near-postings")
        open_pairs = stage(_open_pairs(postings), "near-open")
    if tested is None or open_pairs.isEmpty():
        return _all(found) if found else classes.select(F.col("rid").alias("a"), F.col("rid").alias("b")).where("false")
    members = postings.join(open_pairs.select("value"), "value", "left_semi").select("rid", "comp").distinct()
    pairs = stage(_rare_pairs(members, classes, docs, words, percent).distinct(), "near-open-pairs")
    known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = pairs.join(known, ["a", "b"], "left_anti")
    return _all([*found, _verify(pairs, classes, docs, words, percent, "near-rest")])


def _all(found: list[DataFrame]) -> DataFrame:
    out = found[0]
    for part in found[1:]:
        out = out.unionAll(part)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, th (a digest of its text), n_shingles, component_id, winner.

    A-Z is lower-cased; a document's set are its distinct shingles of ``words`` words, or its
    whole word sequence if it has fewer. Documents are linked if their sets have a similarity of
    ``percent`` or more. ``component_id`` is the smallest doc_id reachable over links, itself
    included; ``winner`` is (doc_id, th) of one document of the component, the one that would stay.

    Documents of equal sets are one class first, so copies never make pairs. Every class is posted under
    (coordinate, value) of its MinHash signature, only under its rarest values (``prefixes``). Classes that
    meet there and agree in MATCHES of COORDINATES are compared by their full sets.

    Texts without words, and null texts, have no set, link with nothing and are components of their own.
    Null ids take part; they are never a component's id unless it has no other. Repeated rows are in one component. An
    empty table gives an empty result. Extra columns are dropped.
    """
    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "text")
    sketched = stage(rows.mapInArrow(lambda b: _sketches(b, words), _SKETCH), "near-sketches")
    grouped = sketched.where("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "th")).alias("any_rep"), F.min("doc_id").alias("min_id"), F.min("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("id_rep"), F.first("sig").alias("sig"))
    # Written once, so that the row numbers stay what they are.
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("rid"), "h1", "h2", "min_id", "n", "sig",
                                   F.coalesce("id_rep", "any_rep").alias("rep")), "near-classes")
    roots = components(class_links(classes, rows, words, percent), "near-components")
    member = (classes.select("rid", "h1", "h2", "min_id", "rep").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
              .withColumn("root", F.coalesce("root", "rid")))
    member = stage(member, "near-members")
    first = F.min(F.struct(F.col("rep.doc_id").isNull().alias("none"), F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th")))
    named = stage(member.groupBy("root").agg(F.min("min_id").alias("component_id"), first.alias("w")), "near-named")
    named = stage(member.join(named, "root").select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), "component_id",
                                                    F.struct("w.doc_id", "w.th").alias("winner")), "near-of-class")
    joined = sketched.join(named, (F.col("h1") == F.col("m1")) & (F.col("h2") == F.col("m2")) & (F.col("n") > 0), "left")
    alone = F.col("n") == 0
    return joined.select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.struct("doc_id", "th")).otherwise(F.col("winner")).alias("winner"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: one document of each component stays, columns unchanged.

    It is the component's smallest doc_id; where that id has several texts the one with the smallest digest,
    and of rows that repeat both the one whose columns have the largest digest. Texts without words stay. Only keys of rows that go are joined. Extra columns of any
    name are kept, as the row is packed in one column.
    """
    found = near_duplicates(docs, words, percent).groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("times"), F.first("winner").alias("w"))
    goes = ~(F.col("doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("th") == F.col("w.th")))
    marks = stage(found.select("doc_id", "th", "times", goes.alias("goes")).where("goes OR times > 1"), "near-marks")
    return without_marked(docs, F.coalesce(F.xxhash64("text"), F.lit(0)), marks)


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates on two-word shingles."""
    found = near_duplicates(read_documents(spark, sf_dir), words=2)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP8_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
item AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
link AS (SELECT a.r AS a, b.r AS b FROM item AS a JOIN item AS b ON a.x = b.x AND a.r <> b.r
         AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
         GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach AS (SELECT r, r AS root FROM sets UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.r),
part AS (SELECT reach.r, min(sets.doc_id) AS component_id FROM reach JOIN sets ON sets.r = reach.root GROUP BY reach.r)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM sets JOIN part USING (r)
"""
