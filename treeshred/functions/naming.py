"""Name normalisation, name joins and identifier escaping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LETTER_OR_DIGIT = r"\p{L}\p{Nd}"
ASTRAL = r"[\x{10000}-\x{10FFFF}]"  # never counted as letters or digits
MAX_IDENTIFIER = 96
HEAD, TAIL = 23, 70
SEPARATOR = "\u0001"


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def normalise(name: Column) -> Column:
    """Lower-case letters and digits, separators to dots, text after ':' cut, rest dropped."""
    head = F.translate(F.substring_index(name, ":", 1), " _-", "...")
    changed = F.lower(F.regexp_replace(head, rf"[^{LETTER_OR_DIGIT}.]|{ASTRAL}", ""))
    return F.when(name.rlike("^[a-z0-9.]*\\z"), name).otherwise(changed)


def rule_name(text: Column) -> Column:
    """Name derived from rule text: separator runs become one dot, ends trimmed."""
    dotted = F.regexp_replace(F.translate(text, " _-", "..."), rf"[^{LETTER_OR_DIGIT}.]|{ASTRAL}", "")
    return F.lower(F.regexp_replace(F.regexp_replace(dotted, r"\.+", "."), r"^\.|\.$", ""))


def template_name(text: Column) -> Column:
    """Name made by a template: every other run becomes one dot, a trailing run is cut."""
    dotted = F.regexp_replace(text, rf"(?:[^{LETTER_OR_DIGIT}]|{ASTRAL})+", ".")
    return F.lower(F.regexp_replace(dotted, r"\.$", ""))


def combine(prefix: Column, suffix: Column) -> Column:
    """Join two dotted names, dropping the longest tail of ``prefix`` that heads ``suffix``."""
    marked = F.concat(prefix, F.lit(SEPARATOR), suffix)
    tail = rf"(?iu)(^|\.)([^{SEPARATOR}]*){SEPARATOR}(\2(?:\.|$))"
    joined = F.replace(F.regexp_replace(marked, tail, "$1$3"), F.lit(SEPARATOR), F.lit("."))
    return F.when(is_blank(prefix), suffix).when(is_blank(suffix), prefix).otherwise(joined)


def group_name(parent_local: Column) -> Column:
    return F.when(is_blank(parent_local), F.lit("_group")).otherwise(
        F.concat(parent_local, F.lit("._group"))
    )


def escape(name: Column) -> Column:
    """Identifier form: other characters to '_', over-long names cut in the middle."""
    return _shorten(F.regexp_replace(F.regexp_replace(name, ASTRAL, "__"), rf"[^{LETTER_OR_DIGIT}]", "_"))


def escape_normal(name: Column) -> Column:
    """``escape`` for names built by ``normalise``, ``combine`` and ``group_name``: only dots can occur."""
    return _shorten(F.replace(name, F.lit("."), F.lit("_")))


def _shorten(flat: Column) -> Column:
    cut = F.concat(F.substring(flat, 1, HEAD), F.lit("___"), F.substring(flat, -TAIL, TAIL))
    return F.when(F.length(flat) > MAX_IDENTIFIER, cut).otherwise(flat)
