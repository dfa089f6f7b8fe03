"""Typed values and labels of nodes (2.C, D7, D8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import naming as N, values as V


def type_nodes(nodes: DataFrame, fields: DataFrame | None, capture_tz: str = "UTC") -> DataFrame:
    """Add ``kind``, ``text`` and ``cls`` by the field dictionary.

    ``fields``: short_name, cls, base. One left join on the renamed name, then
    one projection; whether it is a broadcast join follows the dictionary size.
    """
    if fields is None:
        nodes = nodes.withColumns({"cls": F.lit(None).cast("string"), "base": F.lit(None).cast("string")})
    else:
        dictionary = fields.select(F.col("short_name").alias("_short"), "cls", "base")
        # The name, if there is one. A function of higher order ends the generated code: what makes the nodes and what
        # types them would together be too long for the JVM to compile.
        named = F.get(F.filter(F.array("name"), lambda x: x != ""), F.lit(0))
        nodes = nodes.withColumn("_name", F.when(F.col("type") == "field", named)).join(
            dictionary, F.col("_name") == F.col("_short"), "left").drop("_short", "_name")
    name, show, value = F.col("name"), F.col("show"), F.col("value")
    parsed = nodes.withColumns(V.parsed_numbers(F.col("cls"), F.col("base"), show)).withColumn(
        "parsed", V.typed_text(F.col("cls"), F.col("base"), show, value, F.col("_i"), F.col("_d"), capture_tz))
    text = (F.when(N.is_blank(name), show)
            .when(F.col("type") == "field", F.coalesce(F.col("parsed"), V.fallback_text(name, show, value))))
    return parsed.select(
        *[c for c in parsed.columns if c not in ("parsed", "base", "_i", "_d")],
        V.typed_kind(F.col("cls"), F.col("base"), F.col("parsed")).alias("kind"), text.alias("text"),
        F.col("parsed").isNotNull().alias("typed"), F.col("_i").alias("number_value"),
    )


@dataclass
class Labels:
    """Label dictionary split by how it is probed. Every frame is a relation, none is collected."""

    exact: DataFrame | None    # field, v, ordinal, label
    ranges: DataFrame | None   # field, level, bin, hits array<struct<ordinal,lo,hi,label>>
    levels: list[int]          # distinct range levels, at most 64
    flags: DataFrame | None    # field, label, false_label


def prepare_labels(labels: DataFrame) -> Labels:
    """Index labels: exact values by equality, ranges by power-of-two bins.

    A range of width up to 2^level falls in at most two bins of that level, so
    a lookup is one equi-join per level present instead of a scan of all the
    labels of a field.
    """
    exact = labels.where("kind = 'V'").select("field", F.col("lo").alias("v"), "ordinal", "label")
    span = F.try_subtract("hi", "lo")
    level = F.when(span.isNull(), 63).when(span == 0, 0).otherwise(F.length(F.bin(span)))
    ranged = labels.where("kind = 'R' and lo <= hi").withColumn("level", F.least(level, F.lit(63)))
    levels = [r[0] for r in ranged.select("level").distinct().orderBy("level").collect()]
    shifted = lambda c: F.expr(f"shiftright({c}, level)")
    bins = ranged.select("field", "level", "ordinal", "lo", "hi", "label",
                         F.explode(F.array_distinct(F.array(shifted("lo"), shifted("hi")))).alias("bin"))
    ranges = bins.groupBy("field", "level", "bin").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "lo", "hi", "label"))).alias("hits"))
    flags = labels.where("kind = 'T'").select("field", "label", "false_label")
    return Labels(exact, ranges if levels else None, levels, flags)


def label_values(df: DataFrame, labels: Labels | None) -> DataFrame:
    """Add ``label`` for typed values: the first label in dictionary order that holds the value."""
    if labels is None:
        return df.withColumn("label", F.lit(None).cast("string"))
    is_bool = F.col("typed") & (F.col("kind") == V.BOOL)
    other = F.when(F.col("typed") & ~F.col("kind").isin(V.BOOL, V.BYTES, V.TIME) & (F.col("cls") != "span"),
                   V.as_signed(F.col("text")))
    number = F.when(F.col("number_value").isNotNull(), F.col("number_value")).otherwise(other)
    base = df.columns
    df = df.withColumns({"_v": number, "_flag": F.when(is_bool, F.col("name"))})
    found = []
    if labels.exact is not None:
        side = labels.exact.select(F.col("field").alias("_ef"), F.col("v").alias("_ev"),
                                   F.struct("ordinal", "label").alias("_exact"))
        df = df.join(side, (F.col("name") == F.col("_ef")) & (F.col("_v") == F.col("_ev")), "left")
        found.append(F.col("_exact"))
    for level in labels.levels:
        side = labels.ranges.where(F.col("level") == level).select(
            F.col("field").alias(f"_rf{level}"), F.col("bin").alias(f"_rb{level}"),
            F.col("hits").alias(f"_rh{level}"))
        df = df.join(side, (F.col("name") == F.col(f"_rf{level}"))
                     & (F.shiftright("_v", level) == F.col(f"_rb{level}")), "left")
        inside = F.filter(F.col(f"_rh{level}"), lambda h: (h["lo"] <= F.col("_v")) & (F.col("_v") <= h["hi"]))
        first = F.get(inside, F.lit(0))
        found.append(F.when(first.isNotNull(), F.struct(first["ordinal"].alias("ordinal"), first["label"].alias("label"))))
    label = F.lit(None).cast("string")
    if found:
        winner = F.least(*found) if len(found) > 1 else found[0]
        label = winner["label"]
    if labels.flags is not None:
        side = labels.flags.select(F.col("field").alias("_ff"), F.col("label").alias("_ft"),
                                   F.col("false_label").alias("_fn"))
        df = df.join(side, F.col("_flag") == F.col("_ff"), "left")
        label = F.when(is_bool, F.when(F.col("text") == "1", F.col("_ft")).otherwise(F.col("_fn"))).otherwise(label)
    return df.select(*base, label.alias("label"))
