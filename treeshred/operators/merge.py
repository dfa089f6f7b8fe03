"""Ordered merges of dictionary entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import naming as N, values as V
from ..session import stage

JOINER = " / "


def differs(a: Column, b: Column) -> Column:
    return F.lower(a) != F.lower(b)


def merge_texts(df: DataFrame, keys: list[str], seq: str, columns: list[str]) -> DataFrame:
    """One row per key; each text column is folded in ``seq`` order.

    The first non-blank text stands; a later text that differs from the text
    merged so far is appended. Repeats of the first text ahead of the first
    different one are dropped map-side, so the list folded per key is no
    longer than the text it produces. Once the merged text is longer than
    every text in the list none of them can equal it, so the rest is
    appended at once: the work of a key follows the size of its texts.
    """
    at = F.col(seq)
    firsts = df.groupBy(*keys).agg(*[
        F.min(F.when(~N.is_blank(F.col(c)), F.struct(at.alias("at"), F.col(c).alias("t")))).alias(f"_f_{c}")
        for c in columns])
    known = df.join(firsts, keys)
    changed = known.groupBy(*keys).agg(*[
        F.min(F.when((at > F.col(f"_f_{c}.at")) & differs(F.col(c), F.col(f"_f_{c}.t")), at)).alias(f"_d_{c}")
        for c in columns])
    later = lambda c: F.col(c).isNotNull() & (at >= F.col(f"_d_{c}"))
    lists = known.join(changed, keys).groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.when(later(c), F.struct(at.alias("at"), F.col(c).alias("t"))))).alias(f"_l_{c}")
        for c in columns], *[F.first(f"_f_{c}.t").alias(f"_s_{c}") for c in columns],
        *[F.max(F.when(later(c), F.length(F.lower(c)))).alias(f"_m_{c}") for c in columns])

    def fold(c: str) -> Column:
        """struct(text, n): the text merged from the first ``n`` of the list, up to where it is longer than any of them."""
        start = F.struct(F.coalesce(F.col(f"_s_{c}"), F.lit("")).alias("text"), F.lit(0).alias("n"))
        return F.aggregate(f"_l_{c}", start, lambda acc, x: F.when(
            F.length(acc["text"]) > F.col(f"_m_{c}"), acc).otherwise(F.struct(
                F.when(differs(x["t"], acc["text"]), F.concat(acc["text"], F.lit(JOINER), x["t"])).otherwise(acc["text"]).alias("text"),
                (acc["n"] + 1).alias("n"))))

    def joined(c: str) -> Column:
        rest = F.slice(f"_l_{c}", F.col(f"_b_{c}.n") + 1, F.size(f"_l_{c}"))
        return F.array_join(F.concat(F.array(f"_b_{c}.text"), F.transform(rest, lambda x: x["t"])), JOINER)

    begun = lists.select("*", *[fold(c).alias(f"_b_{c}") for c in columns])
    return begun.select(*keys, *[joined(c).alias(c) for c in columns])


def reject_rows(df: DataFrame, stage: str, reason: Column) -> DataFrame:
    return df.where(reason.isNotNull()).select(
        F.lit(stage).alias("stage"), "file", F.col("line_no").alias("position"), reason.alias("reason"),
        F.lit("warning").alias("severity"))


def merge_protocols(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Protocol lines (file, line_no, seq, long_name, short_name, filter_name) to protocols and rejects."""
    filters = entries.where(F.col("short_name").isNotNull()).groupBy("short_name").agg(
        F.min(F.when(~N.is_blank(F.col("filter_name")), F.struct("seq", "filter_name"))).alias("_own"))
    checked = entries.join(filters, "short_name", "left")
    reason = (F.when(F.col("short_name").isNull(), F.lit("missing short name"))
              .when(~N.is_blank(F.col("filter_name")) & differs(F.col("filter_name"), F.col("_own.filter_name")),
                    F.lit("filter name conflict")))
    checked = checked.withColumn("_reason", reason)
    checked = stage(checked, "protocol-lines")
    good = checked.where(F.col("_reason").isNull())
    merged = merge_texts(good, ["short_name"], "seq", ["long_name"])
    protocols = merged.join(filters, "short_name").select(
        "short_name", "long_name", F.coalesce("_own.filter_name", F.lit("")).alias("filter_name"))
    return protocols, reject_rows(checked, "protocols", F.col("_reason"))


def accepted_p_lines(p_lines: DataFrame, protocols: DataFrame) -> DataFrame:
    """Protocol lines of the field file that count: the lower-cased name must not be a key yet (A4)."""
    known = protocols.select(F.col("short_name").alias("_key")).distinct()
    lowered = p_lines.withColumn("_low", F.lower("short_name")).join(known, F.col("_low") == F.col("_key"), "left_anti")
    first_low = lowered.where(F.col("short_name") == F.col("_low")).groupBy(F.col("_low").alias("_k")).agg(
        F.min("seq").alias("_first"))
    return (lowered.join(first_low, F.col("_low") == F.col("_k"), "left")
            .where(F.col("_first").isNull() | (F.col("seq") <= F.col("_first")))
            .drop("_low", "_k", "_first"))


def merge_fields(entries: DataFrame, known_from: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Field lines to merged fields and rejects.

    ``known_from``: short_name, seq at which a protocol becomes known. Checked
    lines are staged: the merge below reads them several times.
    """
    typed = entries.withColumn("cls", V.class_of_tag(F.col("tag")))
    known = known_from.groupBy(F.col("short_name").alias("_p")).agg(F.min("seq").alias("_since"))
    checked = typed.join(known, F.col("protocol") == F.col("_p"), "left")
    early = (F.when(F.col("short_name").isNull() | F.col("tag").isNull(), F.lit("incomplete line"))
             .when(F.col("_since").isNull() | (F.col("_since") > F.col("seq")), F.lit("unknown protocol"))
             .when(F.col("cls").isNull(), F.lit("unknown type")))
    checked = checked.withColumn("_early", early)
    owner = checked.where(F.col("_early").isNull()).groupBy(F.col("short_name").alias("_n")).agg(
        F.min(F.struct("seq", "protocol", "cls")).alias("_own"))
    checked = checked.join(owner, F.col("short_name") == F.col("_n"), "left").withColumn(
        "_reason", F.coalesce(
            "_early", F.when(F.col("protocol") != F.col("_own.protocol"), F.lit("protocol conflict"))
            .when(F.col("cls") != F.col("_own.cls"), F.lit("type conflict"))))
    checked = stage(checked, "field-lines")
    good = checked.where(F.col("_reason").isNull())
    texts = merge_texts(good, ["short_name"], "seq", ["long_name", "description", "base", "bitmask"])
    fields = texts.join(owner, F.col("short_name") == F.col("_n")).select(
        "short_name", F.col("_own.protocol").alias("protocol"), F.col("_own.cls").alias("cls"),
        "long_name", "description", "base", "bitmask")
    return fields, reject_rows(checked, "fields", F.col("_reason"))


def merge_labels(entries: DataFrame, fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label lines (field, kind, lo, hi, label, false_label) to merged labels and rejects."""
    known = fields.select(F.col("short_name").alias("_f")).distinct()
    checked = entries.join(known, F.col("field") == F.col("_f"), "left").withColumn("_reason", (
        F.when((F.col("kind") != "T") & (F.col("lo").isNull() | F.col("hi").isNull()), F.lit("bad number"))
        .when(F.col("_f").isNull(), F.lit("unknown field"))))
    checked = stage(checked, "label-lines")
    # Null-safe key for the true/false kind, which has no bounds.
    good = checked.where(F.col("_reason").isNull()).withColumn(
        "_bounds", F.concat_ws("..", F.col("lo").cast("string"), F.col("hi").cast("string")))
    keys = ["field", "kind", "_bounds"]
    order = good.groupBy(*keys).agg(F.min("seq").alias("ordinal"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    texts = merge_texts(good, keys, "seq", ["label", "false_label"])
    labels = order.join(texts, keys).select(
        "field", "kind", "lo", "hi", "label",
        F.when(F.col("kind") == "T", F.col("false_label")).alias("false_label"), "ordinal")
    return labels, reject_rows(checked, "values", F.col("_reason"))
