"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeshred.llm.common import checked_broadcast, plain, read_documents, word_count
from treeshred.session import stage

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
# A (source, size) group above this many rows is ranked in slices, by leading hex digits of the order key.
ROWS_PER_SLICE = 512
MAX_SLICE_DIGITS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Words that the mix takes from each source: one row per source with ``target``.

    ``sizes`` has one row per source: source, source_size. Sources in code
    point order, null last, get the weights in turn. A source can give at most
    ``max_repeat`` times its size; what a source can't give is shared again by
    weight. The fixed point needs no loop: sort the sources by cap per weight;
    those below the water level take their cap and the rest share what is left.
    No sources, or no words at all, give targets of 0.
    """
    # One row per source from here on, not one per document.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cap = F.col("source_size") * max_repeat
    ranked = (sizes
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                 ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
              .withColumn("per_weight", cap / F.col("weight")))
    filled = Window.orderBy("per_weight", "weight", F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # After the first source that stays under its cap none reaches its own and levels only fall: the largest such level.
    leveled = ranked.withColumn("level", level)
    water = F.max(F.when(F.col("level") <= F.col("per_weight"), F.col("level"))).over(everything)
    return leveled.withColumn("water", water).select(
        "source", "source_size",
        F.least(cap.cast("double"), F.coalesce(F.col("water"), F.lit(float("inf"))) * F.col("weight")).alias("target"))


def measure(docs: DataFrame) -> DataFrame:
    """Add what the mix needs to know of a document: ``mix_size``, its words, and ``mix_key``, its place in the order.

    The key is a digest of the id, or of the text where the id is null.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    return docs.withColumns({"mix_size": word_count(F.col("text")), "mix_key": F.md5(name)})


def with_copies(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add source_size, target and ``copies``, the times the mix takes each document of ``measure(docs)``.

    Every document of a source is expected target / source_size times.
    Documents stand in order of size, then key; the expected copies are
    prefix-summed along that order within the source, one offset per source (from
    a digest of its name) is added, and a document is emitted once per
    integer boundary that its interval crosses. As neighbours in the order
    have nearly the same size, the taken words miss a target by about the
    largest document. Nothing is random at run time: reruns agree.

    The expected copies are equal within a source, so the prefix sum is rank times rate.
    The rank has two levels: rows of smaller sizes are counted in a table with
    one row per (source, size), and a size that holds more than ROWS_PER_SLICE
    rows is ranked in slices by leading digits of the key. So neither a hot source nor a hot size
    meets in one task, and no rank depends on the slices.

    A null text has size 0; null is a source of its own, the last; repeated
    rows are documents of their own; rows with equal ids and sizes are interchangeable.
    A source without words is taken 0 times. An empty table gives an empty result.
    """
    sizes = measured.groupBy("source", "mix_size").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes, "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("mix_size")).alias("source_size"))
    targets = source_targets(totals, weights, max_repeat)
    smaller = Window.partitionBy("source").orderBy("mix_size").rowsBetween(Window.unboundedPreceding, -1)
    digits = F.least(F.lit(MAX_SLICE_DIGITS), F.ceil(F.log(16.0, F.col("n") / ROWS_PER_SLICE))).cast("int")
    placed = stage(
        sizes.withColumn("n_smaller", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
        .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
        .select(F.col("source").alias("p_source"), F.col("mix_size").alias("p_size"), "n_smaller", "source_size", "target",
                F.when(F.col("n") > ROWS_PER_SLICE, digits).otherwise(F.lit(0)).alias("digits")), "mix-placed")
    rows = (measured.join(placed, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("mix_size") == F.col("p_size")))
            .drop("p_source", "p_size")
            .withColumn("mix_slice", F.expr("substring(mix_key, 1, digits)")))
    cut = rows.where("digits > 0").groupBy("source", "mix_size", "mix_slice").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source", "mix_size").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = stage(cut.select(F.col("source").alias("c_source"), F.col("mix_size").alias("c_size"),
                           F.col("mix_slice").alias("c_slice"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_earlier")),
                "mix-slices")
    rows = rows.join(cut, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("mix_size") == F.col("c_size"))
                     & (F.col("mix_slice") == F.col("c_slice")), "left")
    here = Window.partitionBy("source", "mix_size", "mix_slice").orderBy("mix_key", "doc_id")
    rank = F.col("n_smaller") + F.coalesce("n_earlier", F.lit(0)) + F.col("mix_rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    digest = F.md5(F.concat(F.lit("source:"), F.coalesce("source", F.lit(""))))
    offset = F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536
    return (rows.withColumn("mix_rank", F.row_number().over(here))
            .withColumn("copies", F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset))
            .drop("c_source", "c_size", "c_slice", "n_earlier", "n_smaller", "digits", "mix_slice", "mix_rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it, columns unchanged.

    Narrow rows (id, source, size, digest) are ranked; the rows themselves are joined once with the copies of theirs. Rows
    that repeat id, source and text share their copies: each gets as many, and the one whose columns have the largest digest what
    is left. Copies are rows like their original, in no special place. Extra columns of any name are kept.
    """
    names = ["doc_id", "source", "mix_text"]
    packed = docs.select("doc_id", "source", F.xxhash64("text").alias("mix_text"), "text",
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"))
    narrow = stage(measure(packed).select(*names, "mix_size", "mix_key"), "mix-narrow")
    taken = with_copies(narrow, weights, max_repeat).groupBy(*names).agg(
        F.count(F.lit(1)).alias("mix_times"), F.sum("copies").alias("mix_copies"))
    taken = stage(taken.select(*[F.col(c).alias(f"t_{c}") for c in names], "mix_times", "mix_copies"), "mix-taken")
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    once, again = taken.where("mix_times = 1 AND mix_copies > 0"), taken.where("mix_times > 1 AND mix_copies > 0")
    rows = packed.select(*names, "mix_row")
    out = _repeated(rows.join(checked_broadcast(once), same), F.col("mix_copies"))
    if again.isEmpty():
        return out
    shared = rows.join(checked_broadcast(again), same)
    rest = shared.groupBy(*names).agg(F.max_by("mix_row", F.xxhash64(F.to_json("mix_row"))).alias("mix_row"),
                                      F.first(F.col("mix_copies") % F.col("mix_times")).alias("mix_rest"))
    return (out.unionAll(_repeated(shared, F.floor(F.col("mix_copies") / F.col("mix_times"))))
            .unionAll(_repeated(rest, F.col("mix_rest"))))


def _repeated(rows: DataFrame, times: Column) -> DataFrame:
    return (rows.withColumn("mix_n", times.cast("int")).where("mix_n > 0")
            .select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_n"))).alias("mix_copy")).select("mix_row.*"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its size and its source's, the source's target, and the words the mix takes of it."""
    docs = measure(plain(read_documents(spark, sf_dir), "doc_id", "source", "text"))
    rows = with_copies(stage(docs.select("doc_id", "source", "mix_size", "mix_key"), "mix-rows"))
    return rows.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target",
                       (F.col("copies") * F.col("mix_size")).alias("taken"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
lev AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0)) * 1.0::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM src
  WINDOW f AS (ORDER BY 3.0::DOUBLE * source_size / w, w, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size,
           coalesce(max(CASE WHEN level <= 3.0::DOUBLE * source_size / w THEN level END) OVER (), 'inf'::DOUBLE) * w) AS target,
         CAST('0x' || substr(md5('source:' || coalesce(source, '')), 1, 4) AS INTEGER) / 65536.0::DOUBLE AS u
  FROM lev),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS r,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.k, s.doc_id NULLS FIRST) AS n
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(r * n + u) - floor(r * (n - 1) + u) AS BIGINT) * size AS taken
FROM ranked
"""
