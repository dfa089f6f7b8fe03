"""Rename and filter rules from XML or Python lists."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import naming as N
from ..operators.filters import FilterRules
from ..operators.rename import RenameRules
from ..session import stage

TEMPLATE_KEYS = ("parentName", "name", "show", "showname", "value")

# Table patterns allowed by the "Basic" preset after denying all.
BASIC_TABLES = [
    "^geninfo$", "^arp.*$", "^eth.*$", "^ip.*$", "^tcp.*$", "^udp.*$", "^icmp.*$", "^dns.*$", "^http.*$",
    "^media.*$", "^image.*$", "^ftp.*$", "^tftp.*$", "^smtp.*$", "^pop.*$", "^imap.*$", "^imf.*$", "^ssl.*$",
    "^ssh.*$", "^telnet.*$", "^x11.*$", "^umts.*$", "^dhcp.*$", "^nntp.*$", "^smb.*$", "^mailslot.*$",
    "^nbdgm.*$", "^nbns.*$", "^exec.*$", "^messenger.*$", "^msnms.*$", "^irc.*$", "^x224*$", "^tpkt*$",
]

# The hand-written template rules of the built-in set.
BUILTIN_TEMPLATES = [
    {"parentName": ".*", "name": "", "show": "^.+: [tT]ype .+, [cC]lass .+$", "showname": ".*", "value": ".*",
     "nameFormat": "$(parentNamePrefix)namespec", "valueFormat": "$(value)"},
    {"parentName": ".*", "name": "", "show": "^SEQ/ACK analysis$", "showname": ".*", "value": ".*",
     "nameFormat": "tcp.analysis", "valueFormat": "$(value)"},
    {"parentName": ".*", "name": "", "show": r"^.*HTTP/[0-9]\.[0-9].*$", "showname": ".*", "value": ".*",
     "nameFormat": "$(parentNamePrefix)httpdata", "valueFormat": "$(value)"},
]


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Relation of literals; Catalyst knows its exact size and picks join strategies by it."""
    import pandas as pd

    columns = {n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)}
    ddl = []
    for i, n in enumerate(names):
        kinds = {type(r[i]) for r in rows if r[i] is not None}
        ddl.append(f"{n} {'bigint' if kinds == {int} else 'string'}")
    local = pd.DataFrame(columns)
    with_arrow = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    try:
        return spark.createDataFrame(local, schema=", ".join(ddl))
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", with_arrow)


def expand_standard(rules: DataFrame) -> DataFrame:
    """Standard rules (seq, kind, protocol, text, name) to unique lookup rows.

    Speculative rules act as constant and as prefix, comma lists name several
    protocols, a missing name is made from the text, and the last rule for the
    same key wins (E5, E6).
    """
    classes = (F.when(F.col("kind") == "constant", F.array(F.lit("constant")))
               .when(F.col("kind") == "prefix", F.array(F.lit("prefix")))
               .when(F.col("kind") == "speculative", F.array(F.lit("constant"), F.lit("prefix"))))
    usable = rules.where(~N.is_blank(F.col("text")) & F.col("protocol").isNotNull())
    keyed = usable.select(
        "seq", "text", F.explode(F.split("protocol", ",")).alias("protocol"), classes.alias("classes"),
        F.when(N.is_blank(F.col("name")), N.rule_name(F.col("text"))).otherwise(F.col("name")).alias("name"),
    ).select("seq", "text", "protocol", "name", F.explode("classes").alias("class"))
    return keyed.groupBy("class", "protocol", "text").agg(F.max_by("name", "seq").alias("new_name"))


def rename_rules(spark: SparkSession, standard: list[dict] | DataFrame | None = None,
                 templates: list[dict] | None = None) -> RenameRules:
    """Rules in order of appearance; later ones override earlier ones."""
    if isinstance(standard, list):
        rows = [(i, r["kind"], r.get("protocol"), r.get("text"), r.get("name")) for i, r in enumerate(standard)]
        standard = literal_rows(spark, rows, ["seq", "kind", "protocol", "text", "name"]) if rows else None
    usable = [t for t in templates or [] if any(t.get(k) for k in TEMPLATE_KEYS)]
    # Every level of every tree joins the rules: they are expanded once.
    return RenameRules(stage(expand_standard(standard), "rules") if standard is not None else None, usable)


def _whole_texts(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Texts of a rule file, or of all files of a folder or list, in path order.

    Rule files are lists that people write or that mining made, so they are parsed on the driver.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content").orderBy("path").collect()
    texts = [bytes(f["content"]).decode("utf-8-sig") for f in files if bytes(f["content"]).strip()]
    if not files:
        raise ValueError(f"no rule file in {path}")
    return texts


def load_rename_file(spark: SparkSession, path: str) -> tuple[list[dict], list[dict], list[tuple[str, str]]]:
    """XML rule files to (standard, templates, skipped): ``/fixups/*`` elements.

    A folder or list of files counts as one list in path order, so a later file overrides an earlier one.
    """
    standard, templates, skipped = [], [], []
    for node in (n for text in _whole_texts(spark, path) for n in ET.fromstring(text)):
        kind = node.tag.lower()
        if kind == "template" and any(node.get(k) for k in TEMPLATE_KEYS):
            templates.append(dict(node.attrib))
        elif kind in ("constant", "prefix", "speculative") and node.get("text") and node.get("protocol") is not None:
            standard.append({"kind": kind, **node.attrib})
        else:
            skipped.append((path, ET.tostring(node, encoding="unicode").strip()))
    return standard, templates, skipped


RULE = r"""(?is)^(constant|prefix|speculative)((?:\s+[\w:]+\s*=\s*(?:"[^"]*"|'[^']*'))*)\s*/?>"""


def read_rules(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Standard rules of written rule files as a relation for ``rename_rules``, and the elements that are none.

    Files are cut before every tag and rules are parsed one by one, so any number of them, such as those that mining
    writes, stays on the executors. ``seq`` is the place (file, split, position), so later files and elements override earlier ones.
    Rules: seq, kind, protocol, text, name; skipped: file, element. Comments are not known here: files that
    people write, with templates or comments, go through ``load_rename_file``.
    """
    texts = (spark.read.option("lineSep", "<").option("recursiveFileLookup", "true").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"), "value"))
    tags = texts.where(F.col("value").rlike(r"^\w") & ~F.col("value").rlike(r"(?i)^fixups[\s/>]"))
    attributes = F.from_xml(F.concat(F.lit("<rule"), F.regexp_extract("value", RULE, 2), F.lit("/>")),
                            "_protocol string, _text string, _name string", {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"})
    parsed = tags.withColumns({"kind": F.lower(F.regexp_extract("value", RULE, 1)), "rule": attributes})
    usable = (F.col("kind") != "") & ~N.is_blank(F.col("rule._text")) & F.col("rule._protocol").isNotNull()
    rules = parsed.where(usable).select(F.struct("file", "block", "at").alias("seq"), "kind", F.col("rule._protocol").alias("protocol"),
                                        F.col("rule._text").alias("text"), F.col("rule._name").alias("name"))
    return rules, parsed.where(~F.coalesce(usable, F.lit(False))).select("file", F.concat(F.lit("<"), "value").alias("element"))


def load_filter_file(spark: SparkSession, path: str) -> tuple[FilterRules, list[tuple[str, str]]]:
    """XML filter files, in path order, to rules and skipped elements."""
    roots, rules, skipped = [ET.fromstring(t) for t in _whole_texts(spark, path)], FilterRules(), []
    for section, keys, out in (("tables", ("tableName",), rules.tables),
                               ("columns", ("tableName", "columnName"), rules.columns)):
        for node in (n for root in roots for n in root.findall(f"./{section}/*")):
            if node.tag.lower() in ("allow", "deny") and all(node.get(k) for k in keys):
                out.append({"action": node.tag.lower(), **{k: node.get(k) for k in keys}})
            else:
                skipped.append((path, ET.tostring(node, encoding="unicode").strip()))
    return rules, skipped


def preset(name: str | None) -> FilterRules:
    """Named preset, found by name suffix without regard to case."""
    if not name:
        return FilterRules()
    if not "basic".endswith(name.lower()):
        raise ValueError(f"unknown filter preset: {name}")
    tables = [{"action": "deny", "tableName": ".*"}]
    tables += [{"action": "allow", "tableName": p} for p in BASIC_TABLES]
    return FilterRules(tables, [{"action": "allow", "tableName": ".*", "columnName": ".*"}])
