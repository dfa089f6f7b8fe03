"""Rename rules applied to nodes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import naming as N, regex as R


@dataclass
class RenameRules:
    """Standard rules are a relation (they may be many), templates a short ordered list."""

    standard: DataFrame | None = None  # class, protocol, text, new_name (unique per class/protocol/text)
    templates: list[dict] = field(default_factory=list)


def rename_nodes(df: DataFrame, rules: RenameRules, top: bool) -> DataFrame:
    """Rewrite ``n_name, n_show, n_showname, n_value`` of the fresh rows."""
    if rules.standard is not None and not top:
        df = standard_rename(df, rules.standard)
    else:
        df = df.withColumn("n_hit", F.lit(False))
    return template_rename(df, rules.templates)


def standard_rename(df: DataFrame, standard: DataFrame) -> DataFrame:
    """Constant rule first, then prefix rule; only for nameless nodes with a text."""
    open_text = F.when(N.is_blank(F.col("n_name")) & ~N.is_blank(F.col("n_show")), F.col("n_show"))
    colon = F.instr(open_text, ":")
    df = df.withColumns({"n_text": open_text,
                         "n_prefix": F.when(colon > 1, F.substring_index(open_text, ":", 1))})
    for cls, key in (("constant", "n_text"), ("prefix", "n_prefix")):
        side = standard.where(F.col("class") == cls).select(
            F.col("protocol").alias(f"_{cls}_protocol"), F.col("text").alias(f"_{cls}_text"),
            F.col("new_name").alias(f"_{cls}_name"))
        df = df.join(side, (F.col("protocol") == F.col(f"_{cls}_protocol"))
                     & (F.col(key) == F.col(f"_{cls}_text")), "left")
    constant = F.col("_constant_name").isNotNull()
    prefix = ~constant & F.col("_prefix_name").isNotNull()
    rest = F.regexp_replace(F.substring(F.col("n_show"), F.instr(F.col("n_show"), ":") + 1, F.lit(2147483647)),
                            r"^\s+", "")
    text = F.when(constant, F.lit("")).when(prefix, rest)
    return df.select(
        *[c for c in df.columns if not c.startswith(("_constant", "_prefix"))
          and c not in ("n_name", "n_show", "n_showname", "n_value", "n_text", "n_prefix")],
        F.coalesce("_constant_name", "_prefix_name", "n_name").alias("n_name"),
        F.when(constant | prefix, text).otherwise(F.col("n_show")).alias("n_show"),
        F.when(constant | prefix, F.col("n_show")).otherwise(F.col("n_showname")).alias("n_showname"),
        F.when(constant | prefix, text).otherwise(F.col("n_value")).alias("n_value"),
        (constant | prefix).alias("n_hit"),
    )


def template_text(form: str | None, keys: list[tuple[str, Column]], as_name: bool) -> Column:
    """Fill ``$(key)`` slots in order; an empty form gives null."""
    if not form:
        return F.lit(None).cast("string")
    out = F.lit(form)
    # Until a slot of the form itself is filled there is nothing to fill; a filled text may bring slots of later keys.
    first = next((i for i, (key, _) in enumerate(keys) if f"$({key})" in form), len(keys))
    for key, value in keys[first:]:
        out = F.replace(out, F.lit(f"$({key})"), F.coalesce(value, F.lit("")))
    return N.template_name(out) if as_name else out


ANCHORS = ("show", "showname", "value", "name", "parentName")


def anchor(rule: dict) -> tuple[str, str] | None:
    """Field and text that a node must hold for a template to fit it: the longest that its patterns tell."""
    told = [(key, R.required_literal(rule.get(key))) for key in ANCHORS]
    told = [(key, text) for key, text in told if text]
    return max(told, key=lambda t: len(t[1])) if told else None


def template_choice(templates: list[dict], fields: dict[str, Column]) -> Column:
    """Name and value by the last template that fits, as one flat CASE: the last template comes first."""
    chosen = F.lit(None).cast("struct<name:string,value:string>")
    cases = None
    for rule in reversed(templates):
        hit, keys = F.col("fresh"), []
        held = anchor(rule)
        if held:
            hit = hit & F.contains(F.coalesce(fields[held[0]], F.lit("")), F.lit(held[1]))
        for key, column in fields.items():
            hit = hit & R.matches(rule.get(key), column)
            keys += R.captures(rule.get(key), column)
        parent = fields["parentName"]
        keys += [("parentName", parent),
                 ("parentNamePrefix", F.when(N.is_blank(parent), F.lit("")).otherwise(F.concat(parent, F.lit(".")))),
                 *[(k, fields[k]) for k in ("name", "show", "showname", "value")]]
        made = F.struct(template_text(rule.get("nameFormat"), keys, True).alias("name"),
                        template_text(rule.get("valueFormat"), keys, False).alias("value"))
        cases = F.when(hit, made) if cases is None else cases.when(hit, made)
    return chosen if cases is None else cases.otherwise(chosen)


def template_rename(df: DataFrame, templates: list[dict]) -> DataFrame:
    """The last template that fits a node counts.

    Most templates name a text that a node must hold. One pattern over all these texts tells the nodes that need
    a look at such templates; the others meet only those that name no text.
    """
    fields = {"parentName": F.col("p_name"), "name": F.col("n_name"), "show": F.col("n_show"),
              "showname": F.col("n_showname"), "value": F.col("n_value")}
    anchors = [held for rule in templates if (held := anchor(rule))]
    possible = F.lit(False)
    for key in ANCHORS:
        texts = [text for field_, text in anchors if field_ == key]
        if texts:
            possible = possible | F.coalesce(fields[key], F.lit("")).rlike(R.any_of(texts))
    chosen = template_choice([rule for rule in templates if not anchor(rule)], fields)
    if anchors:
        chosen = F.when(F.col("fresh") & possible, template_choice(templates, fields)).otherwise(chosen)
    df = df.withColumn("n_t", chosen)
    templated = F.col("n_t.name").isNotNull() | F.col("n_t.value").isNotNull()
    hit = templated | F.col("n_hit")
    value = F.when(templated, F.col("n_t.value")).otherwise(F.col("n_value"))
    return df.select(
        *[c for c in df.columns if c not in ("n_name", "n_show", "n_showname", "n_value", "n_t", "n_hit")],
        F.when(templated, F.col("n_t.name")).otherwise(F.col("n_name")).alias("n_name"),
        F.when(hit, value).otherwise(F.col("n_show")).alias("n_show"),
        F.when(hit, value).otherwise(F.col("n_showname")).alias("n_showname"),
        value.alias("n_value"),
    )
