"""Tab-separated dictionaries: protocols, fields, labels."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import values as V
from ..operators.merge import accepted_p_lines, merge_fields, merge_labels, merge_protocols
from ..operators.numbering import number_within
from ..session import stage


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as (file, line_no, line), numbered per file in file order.

    Numbering goes by file block, so a large file is never read by one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("_at"))
    return number_within(lines, "line_no", ["file"], ["_block"], ["_at"]).drop("_block", "_at")


def bounded_split(line: Column, n: int) -> list[Column]:
    """At most ``n`` tab parts; the last keeps further tabs, missing parts are '',
    and a line that ends with a separator leaves null for what follows it (A6)."""
    parts = F.split(line, "\t", n)
    size = F.size(parts)
    open_end = (size > 1) & (F.element_at(parts, -1) == "")
    out = []
    for i in range(n):
        part = F.get(parts, F.lit(i))
        out.append(F.when((size - 1 == i) & open_end, F.lit(None).cast("string"))
                   .when(size > i, part).when(open_end, F.lit(None).cast("string")).otherwise(F.lit("")))
    return out


def _split_as(lines: DataFrame, names: list[str]) -> DataFrame:
    parts = bounded_split(F.col("line"), len(names))
    return lines.select("file", "line_no", F.col("line_no").alias("seq"),
                        *[p.alias(n) for p, n in zip(parts, names) if n != "_"])


def protocol_lines(lines: DataFrame) -> DataFrame:
    return _split_as(lines.where("line <> ''"), ["long_name", "short_name", "filter_name"])


def field_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``F`` lines and ``P`` lines; other first letters are ignored (A4)."""
    first = F.substring("line", 1, 1)
    f = _split_as(lines.where(first == "F"),
                  ["_", "long_name", "short_name", "tag", "protocol", "description", "base", "bitmask"])
    p = _split_as(lines.where(first == "P"), ["_", "long_name", "short_name"])
    return f, p.withColumn("filter_name", F.lower("short_name"))


def label_lines(lines: DataFrame) -> DataFrame:
    """``V``, ``R`` and ``T`` lines with numbers decimal or hex."""
    first = F.substring("line", 1, 1)
    v = _split_as(lines.where(first == "V"), ["kind", "field", "lo", "label"]).withColumn("hi", F.col("lo"))
    r = _split_as(lines.where(first == "R"), ["kind", "field", "lo", "hi", "label"])
    t = _split_as(lines.where(first == "T"), ["kind", "field", "label", "false_label"])
    number = lambda c: V.as_literal(F.col(c)).alias(c)
    none = F.lit(None)
    shape = lambda d, lo, hi, fl: d.select(
        "file", "line_no", "seq", F.substring("kind", 1, 1).alias("kind"),
        "field", lo, hi, "label", fl)
    return (shape(v, number("lo"), number("hi"), none.cast("string").alias("false_label"))
            .unionByName(shape(r, number("lo"), number("hi"), none.cast("string").alias("false_label")))
            .unionByName(shape(t, none.cast("bigint").alias("lo"), none.cast("bigint").alias("hi"),
                               F.col("false_label"))))


@dataclass
class Dictionaries:
    protocols: DataFrame
    fields: DataFrame
    labels: DataFrame
    rejects: DataFrame


def build_dictionaries(protocols: DataFrame, fields: DataFrame, labels: DataFrame) -> Dictionaries:
    """Three line frames to merged dictionaries; bad lines are reported and skipped (H1)."""
    base, bad_base = merge_protocols(protocol_lines(protocols))
    base = stage(base, "protocols")
    f, p = field_lines(fields)
    nameless = p.where(F.col("short_name").isNull())
    taken = stage(accepted_p_lines(p.where(F.col("short_name").isNotNull()), base), "protocol-extra")
    extra, bad_extra = merge_protocols(taken)
    every = base.unionByName(extra)
    since = base.select("short_name", F.lit(0).cast("bigint").alias("seq")).unionByName(
        taken.select("short_name", "seq"))
    merged, bad_fields = merge_fields(f, since)
    merged = stage(merged, "fields")
    texts, bad_labels = merge_labels(label_lines(labels), merged)
    missing = nameless.select(F.lit("fields").alias("stage"), "file", F.col("line_no").alias("position"),
                              F.lit("missing short name").alias("reason"), F.lit("warning").alias("severity"))
    rejects = reduce(DataFrame.unionByName, [bad_base, bad_extra, missing, bad_fields, bad_labels])
    return Dictionaries(every, merged, texts, rejects)


def read_dictionaries(spark: SparkSession, protocols: str, fields: str, labels: str) -> Dictionaries:
    """Read, merge and stage the three files, so that later joins see their exact sizes."""
    d = build_dictionaries(text_lines(spark, protocols), text_lines(spark, fields), text_lines(spark, labels))
    return Dictionaries(stage(d.protocols, "protocols"), d.fields, stage(d.labels, "labels"),
                        stage(d.rejects, "dictionary-rejects"))
