"""Source divergence audit: term shares of each source against the other sources of its language, by a perfect-hash recount."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeshred.llm.common import chunks, plain, read_documents
from treeshred.llm.perfect_hash import Shards, build, digests, shard_of
from treeshred.session import stage

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
# Expected keys of a shard: a slot fits two bytes with much room.
KEYS_PER_SHARD = 4096
# Shards that are broadcast at a time; a larger vocabulary takes several passes.
ROUND_BYTES = 32 << 20
# Distinct terms, and dense slots of all groups, that a task holds before it hands them on.
HELD_TERMS = 200_000
HELD_SLOTS = 4 << 20
SLICE_BYTES = 1 << 20
# Parts that a hot group's partial counts are first added up in.
SALTS = 16
# Sources that are compared with each other in one go.
SOURCES_PER_BLOCK = 128

# Letters are A-Z, a-z and all that is not ASCII; A-Z are lower-cased, other ASCII bytes become blanks.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_CELLS = "lang string, shard int, source string, salt int, slots binary, counts binary"


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, a slice at a time; slices end between terms."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    at = 0
    while len(data) - at > SLICE_BYTES:
        end = data.find(b" ", at + SLICE_BYTES)
        if end < 0:
            break
        yield data[at:end].split()
        at = end
    yield data[at:].split()


def _named(docs: DataFrame) -> DataFrame:
    return plain(docs, "lang", "source", "text").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                                          for c in ("lang", "source", "text")])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each (lang, term), added up as far as HELD_TERMS allow."""
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, seen in held.items():
            names = list(seen)
            for at in range(0, len(names), 1 << 16):
                some = names[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()),
                                                  pa.array([seen[t] for t in some], pa.int64())], names=["lang", "term", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update({t for some in terms(text) for t in some})
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from out()
    yield from out()


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term: terms in at least ``min_docs`` documents of the language, counted exactly over all of them."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def hash_shards(kept: DataFrame) -> DataFrame:
    """One row per shard of a language's terms: lang, n_shards, shard, n_keys, shift (displacements), keys in slot order."""
    sizes = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_SHARD).cast("int").alias("n_shards"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, second = digests(batch.column(1).to_pylist())
                shard = shard_of(second, batch.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())],
                                                 names=["lang", "term", "n_shards", "shard"])

    def built(table: pa.Table) -> pa.Table:
        keys = table.column("term").to_pylist()
        shift, slots = build(*digests(keys))
        in_order = [b""] * len(keys)
        for key, slot in zip(keys, slots):
            in_order[slot] = key
        return pa.table({**{c: table.column(c).slice(0, 1) for c in ("lang", "n_shards", "shard")},
                         "n_keys": pa.array([len(keys)], pa.int32()), "shift": pa.array([shift.tobytes()], pa.binary()),
                         "keys": pa.array([in_order], pa.list_(pa.binary()))})

    rows = kept.join(sizes, "lang").select("lang", "term", "n_shards").mapInArrow(
        placed, "lang string, term binary, n_shards int, shard int")
    # A shard has KEYS_PER_SHARD keys on average, whatever the vocabulary.
    return rows.groupBy("lang", "shard").applyInArrow(
        built, "lang string, n_shards int, shard int, n_keys int, shift binary, keys array<binary>")


def _rounds(index: DataFrame) -> Iterator[list[tuple[str, int]]]:
    """Shards in groups of at most ROUND_BYTES; to the driver comes one row of two numbers for each shard."""
    n_bytes = F.length("shift") + F.aggregate("keys", F.lit(0), lambda s, k: s + F.length(k) + 8)
    held, total = [], 0
    for lang, shard, size in index.select("lang", "shard", n_bytes.alias("size")).orderBy("lang", "shard").collect():
        if held and total + size > ROUND_BYTES:
            yield held
            held, total = [], 0
        held.append((lang, shard))
        total += size
    if held:
        yield held


def _recount(docs: DataFrame, index: DataFrame, chosen: list[tuple[str, int]]) -> DataFrame:
    """Second pass: occurrences of the chosen shards' terms in each (lang, source), partial sums of tasks."""
    spark = docs.sparkSession
    first, last = chosen[0], chosen[-1]
    at = F.struct("lang", "shard")
    low, high = (F.struct(F.lit(x).alias("lang"), F.lit(y).alias("shard")) for x, y in (first, last))
    tables: dict[str, tuple[int, list]] = {}
    for r in index.where((at >= low) & (at <= high)).orderBy("lang", "shard").toLocalIterator():
        tables.setdefault(r.lang, (r.n_shards, []))[1].append(
            (r.shard, r.n_keys, np.frombuffer(r.shift, np.int32), pa.array(list(map(bytes, r["keys"])), pa.large_binary())))
    shared = spark.sparkContext.broadcast({lang: Shards(n, rows) for lang, (n, rows) in tables.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        dense: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            langs, sources, texts = (batch.column(i).to_pylist() for i in range(3))
            for start, end in chunks(texts, SLICE_BYTES):
                seen: dict[tuple[str, str], Counter] = {}
                for i in range(start, end):
                    if langs[i] in shared.value:
                        counter = seen.setdefault((langs[i], sources[i]), Counter())
                        for some in terms(texts[i]):
                            counter.update(some)
                for group, counter in seen.items():
                    shards = shared.value[group[0]]
                    slots = shards.find(list(counter))
                    held = slots >= 0
                    if group not in dense:
                        if (1 + len(dense)) * shards.starts[-1] > HELD_SLOTS:
                            yield from _handed_on(dense, shared.value, salt)
                            dense = {}
                        dense[group] = np.zeros(shards.starts[-1], np.int64)
                    # Terms are distinct, and so are their slots.
                    dense[group][slots[held]] += np.fromiter(counter.values(), np.int64, len(counter))[held]
        yield from _handed_on(dense, shared.value, salt)

    return docs.mapInArrow(run, _CELLS)


def _handed_on(dense: dict, tables: dict[str, Shards], salt: int) -> Iterator[pa.RecordBatch]:
    """Dense counts as rows of (group, shard): slots with a count, two bytes each, and their counts, eight bytes each."""
    for (lang, source), counts in dense.items():
        shards = tables[lang]
        rows = []
        for k, shard in enumerate(shards.shards):
            part = counts[shards.starts[k]:shards.starts[k + 1]]
            slots = np.flatnonzero(part)
            if len(slots):
                rows.append((lang, int(shard), source, salt, slots.astype("<u2").tobytes(), part[slots].astype("<i8").tobytes()))
        if rows:
            yield _cells(rows)


def _cells(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "shard": pa.int32(), "source": pa.string(), "salt": pa.int32(), "slots": pa.binary(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def _summed(cells: DataFrame, *key: str) -> DataFrame:
    """One row for each key: counts added up slot by slot. Rows stream past one dense shard, so a hot key takes no memory."""
    names = ["lang", "shard", "source", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, dense = None, np.zeros(1 << 16, np.int64)

        def done() -> pa.RecordBatch:
            slots = np.flatnonzero(dense)
            return _cells([(*last, slots.astype("<u2").tobytes(), dense[slots].astype("<i8").tobytes())])

        for batch in batches:
            for *group, slots, counts in zip(*[c.to_pylist() for c in batch.columns]):
                if group != last:
                    if last is not None:
                        yield done()
                        dense[:] = 0
                    last = group
                # The slots of a row are distinct.
                dense[np.frombuffer(slots, "<u2")] += np.frombuffer(counts, "<i8")
        if last is not None:
            yield done()

    blank = {"source": F.lit(""), "salt": F.lit(0)}
    rows = cells.select(*[F.col(c) if c in key else blank[c].alias(c) for c in names], "slots", "counts")
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, _CELLS)


def _total(counts: bytes) -> int:
    return int(np.frombuffer(counts, "<i8").sum())


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exactly: three digits of the quotient at a time."""
    below = total + PRIOR * kept
    kind = np.int64 if below < 1 << 53 else object
    rest, out = (counts + PRIOR).astype(kind), np.zeros(len(counts), kind)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return (out + 1).astype(np.int64)


def _dense(n_keys: int, slots: bytes | None, counts: bytes | None) -> np.ndarray:
    out = np.zeros(n_keys, np.int64)
    if slots:
        out[np.frombuffer(slots, "<u2")] = np.frombuffer(counts, "<i8")
    return out


def recount(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shards of kept terms; their exact counts by (lang, shard, source); groups with their totals and kept terms.

    Groups are all (lang, source) of the table, with or without terms: lang, source, total, kept.
    """
    index = stage(hash_shards(stage(vocabulary(docs, min_docs), "divergence-terms")), "divergence-shards")
    parts = [stage(_recount(docs, index, chosen), f"divergence-cells-{k}") for k, chosen in enumerate(_rounds(index))]
    cells = parts[0] if parts else docs.sparkSession.createDataFrame([], _CELLS)
    for part in parts[1:]:
        cells = cells.unionAll(part)
    counts = stage(_summed(_summed(cells, "lang", "shard", "source", "salt"), "lang", "shard", "source"), "divergence-counts")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [_total(c) for c in batch.column(2).to_pylist()], pa.int64())], names=["lang", "source", "n"])

    found = (counts.select("lang", "source", "counts").mapInArrow(totals, "lang string, source string, n long")
             .groupBy("lang", "source").agg(F.sum("n").alias("total")))
    kept = index.groupBy("lang").agg(F.sum("n_keys").alias("kept"))
    groups = (docs.select("lang", "source").distinct().join(found, ["lang", "source"], "left").join(kept, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept")]))
    return index, counts, stage(groups, "divergence-groups")


def _pairs(index: DataFrame, counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: summed distance of each two sources of a language.

    Sources fall into blocks; two blocks meet over one shard at a time, as two dense
    tables of shares, and the sums over shards are added up at the end. A language without kept terms has one empty shard.
    """
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCES_PER_BLOCK).cast("int").alias("n_blocks"))
    shards = index.select("lang", "shard", "n_keys").unionAll(
        groups.where("kept = 0").select("lang", F.lit(-1).alias("shard"), F.lit(0).alias("n_keys")).distinct())
    held = counts.select(*[F.col(c).alias(f"c_{c}") for c in ("lang", "shard", "source")], "slots", "counts")
    rows = (groups.join(blocks, "lang").join(shards, "lang").withColumn("block", F.expr("cast(pmod(xxhash64(source), n_blocks) as int)"))
            .join(held, (F.col("lang") == F.col("c_lang")) & (F.col("shard") == F.col("c_shard")) & (F.col("source") == F.col("c_source")), "left")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
            .select("lang", "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "source", "n_keys", "total", "kept", "slots", "counts"))

    def compare(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda r: (r["block"], r["source"]))
        lang, low, high = (held[0][c] for c in ("lang", "low", "high"))
        p = np.array([shares(_dense(r["n_keys"], r["slots"], r["counts"]), r["total"], r["kept"]) for r in held]
                     ).reshape(len(held), -1)
        side = np.array([r["block"] for r in held])
        one, two, sums = [], [], []
        for i in range(len(held)):
            # Within a block each two once; of two blocks one of either.
            others = np.arange(i + 1, len(held)) if low == high else np.flatnonzero(side > side[i])
            if len(others):
                one += [held[i]["source"]] * len(others)
                two += [held[j]["source"] for j in others]
                sums += np.abs(p[others] - p[i]).sum(axis=1).tolist()
        return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "source": pa.array(one, pa.string()),
                         "item": pa.array(two, pa.string()), "value": pa.array(sums, pa.int64())})

    found = (rows.groupBy("lang", "shard", "low", "high").applyInArrow(compare, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    found = stage(found, "divergence-pairs")
    return found.unionAll(found.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def _terms(index: DataFrame, counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value: terms that a source uses more than its language does, the first ``top`` of each shard."""
    whole = _summed(counts, "lang", "shard").select("lang", "shard", F.col("slots").alias("l_slots"), F.col("counts").alias("l_counts"))
    whole = stage(whole, "divergence-languages")
    language = groups.groupBy("lang").agg(F.sum("total").alias("l_total"))
    rows = (counts.drop("salt").join(groups, ["lang", "source"]).join(language, "lang")
            .join(whole, ["lang", "shard"]).join(index.select("lang", "shard", "n_keys", "keys"), ["lang", "shard"])
            .select("lang", "source", "n_keys", "kept", "total", "slots", "counts", "l_total", "l_slots", "l_counts", "keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lang, source, n_keys, kept, total, slots, counts, l_total, l_slots, l_counts = (
                    batch.column(c)[k].as_py() for c in range(10))
                mine, all_of = _dense(n_keys, slots, counts), _dense(n_keys, l_slots, l_counts)
                more = shares(mine, total, kept) - shares(all_of, l_total, kept)
                at = np.flatnonzero((mine > 0) & (more > 0))
                if len(at) > top:
                    # All that tie with the last one stay in.
                    at = at[more[at] >= np.partition(more[at], len(at) - top)[len(at) - top]]
                if len(at):
                    names = batch.column(10)[k].values.take(pa.array(at)).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([source] * len(at), pa.string()),
                                                      names, pa.array(more[at], pa.int64())], names=["lang", "source", "item", "value"])

    return rows.mapInArrow(run, "lang string, source string, item string, value long")


def _ranked() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language lie apart, and by which terms.

    Null text, lang and source count as ''. Terms are runs of letters (A-Z, a-z and all that is not ASCII), A-Z lower-cased, in whole texts.
    A language keeps the terms in at least ``min_docs`` of its documents (rows: repeated rows are documents of their own). Each (lang, source)
    and each language gives each kept term a smoothed share in billionths (``shares``); all arithmetic is on integers.
    Part ``pair`` has for each source every other source of its language and the summed distance of shares, 0 where no term
    is kept; part ``term`` the ``top`` terms by which the source lies above its language. Ranks go by value downward, then item by UTF-8.

    First pass: document counts of all terms, filtered exactly. The kept terms become minimal perfect hashes, a
    shard of some 4,096 terms each, with stored keys that verify every hit. Second pass: the shards are broadcast, at most ROUND_BYTES at a
    time (a larger vocabulary takes more passes), and each task increments dense slots of each group. Tasks hand on their sums packed
    by shard; those of one group are added up in salted parts first. An empty table gives an empty result; a
    group without terms, or whose language keeps none, has its pairs. Extra columns are dropped.
    """
    index, counts, groups = recount(_named(docs), min_docs)
    pairs = _pairs(index, counts, groups).withColumn("part", F.lit("pair")).withColumn("rank", _ranked())
    found = _terms(index, counts, groups, top).withColumn("part", F.lit("term")).withColumn("rank", _ranked())
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*out).unionAll(found.where(F.col("rank") <= top).select(*out))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_documents(spark, sf_dir))


OP11_SQL = rf"""
WITH occ AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents)),
kept AS (SELECT lang, t FROM occ GROUP BY lang, t HAVING count(DISTINCT r) >= {MIN_DOCS}),
vocab AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, t, count(*) AS c FROM occ JOIN kept USING (lang, t) GROUP BY lang, source, t),
grp AS (SELECT lang, source, coalesce((SELECT sum(c) FROM cnt WHERE cnt.lang = d.lang AND cnt.source = d.source), 0)::BIGINT AS n
        FROM (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents) AS d),
p AS (SELECT g.lang, g.source, k.t, coalesce(c, 0) AS c,
             1 + ({SCALE} * (coalesce(c, 0) + {PRIOR})) // (n + {PRIOR} * v) AS p
      FROM grp AS g JOIN kept AS k USING (lang) JOIN vocab USING (lang) LEFT JOIN cnt USING (lang, source, t)),
q AS (SELECT lang, t, 1 + ({SCALE} * (sum(c)::BIGINT + {PRIOR})) // (sum(sum(c)) OVER (PARTITION BY lang)::BIGINT + {PRIOR} * any_value(v)) AS q
      FROM cnt JOIN vocab USING (lang) GROUP BY lang, t),
gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
        FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source),
words AS (SELECT p.lang, p.source, 'term' AS part, p.t AS item, (p.p - q.q)::BIGINT AS value
          FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE p.c > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM words))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
