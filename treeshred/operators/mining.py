"""Rename rules mined from a corpus of C sources (2.G)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage

SOURCE_TREES = ("epan/dissectors", "plugins")
OWN = 1 << 30  # position of a file itself, after its headers

# The shapes looked for in the sources.
QUOTED = r'"[^"]*(?:(?<=\\)"[^"]*)*"'
FILLED = r'"[^"]+(?:(?<=\\)"[^"]*)*"'
# Possessive, without alternation in a repeat: a long comment would overflow the stack of the regex engine.
COMMENTS = r"(?:/\*[^*]*+\*++(?:[^/*][^*]*+\*++)*+/\s*+)*+"
SYMBOL = rf"(?:\w+|{FILLED})"
INCLUDE = r'(?U)#include\s*(?:<|")([^>"]+)(?:"|>)'
DEFINE = rf"(?U)(?:#define\s*(\w+)\s*({FILLED}))|(?:static\s*char\s*(\w+)[^=]*=\s*({FILLED}))"
REGISTER = (rf"(?U)proto_register_protocol\s*\(\s*{SYMBOL}\s*,\s*{COMMENTS}{SYMBOL}\s*,\s*{COMMENTS}"
            rf"({SYMBOL})\s*{COMMENTS}\)")
ADD_TEXT = rf"(?U)proto_tree_add_text\s*\(\s*[^,]+,\s*[^,]+,\s*[^,]+,\s*[^,]+,\s*({QUOTED})\s*,"
SPECULATIVE = r"""(?U)"( *[\w(][\w\- ()']{1,64})(?:: *)?\""""


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Sources and headers of the two sub-trees, one whole file per row (G1)."""
    paths = [f"{root.rstrip('/')}/{tree}" for tree in SOURCE_TREES]
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{c,h}").text(
        paths, wholetext=True)
    return corpus_of(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def corpus_of(files: DataFrame) -> DataFrame:
    return files.select("path", F.regexp_replace("path", "[^/]*$", "").alias("dir"),
                        F.substring_index("path", "/", -1).alias("basename"), "text")


def _all(pattern: str, group: int) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(group))


def scan(corpus: DataFrame) -> DataFrame:
    """Matches of all shapes in each file, so that texts are read once: path, dir, basename, includes, defines, names, formats, guesses, registers.

    Shapes overlap (a format text may be a speculative one too), so each keeps its own pattern. The parts of a definition are taken
    from its match, not from the whole text again.
    """
    part = lambda m, n: F.regexp_extract(m, DEFINE, n)
    either = lambda m, n: F.when(part(m, n) != "", part(m, n)).otherwise(part(m, n + 2))
    return corpus.select(
        "path", "dir", "basename",
        F.when(F.col("basename").endswith(".c"), F.array_distinct(_all(INCLUDE, 1))).alias("includes"),
        F.transform(_all(DEFINE, 0), lambda m: F.struct(either(m, 1).alias("key"), either(m, 2).alias("value"))).alias("defines"),
        _all(REGISTER, 1).alias("names"),
        F.transform(_all(ADD_TEXT, 1), lambda x: F.substring(x, F.lit(2), F.length(x) - 2)).alias("formats"),
        _all(SPECULATIVE, 1).alias("guesses"),
        F.col("text").contains("proto_register_protocol").alias("registers"))


def included_headers(found: DataFrame) -> DataFrame:
    """Headers a source names and that lie in its own folder (G2): source, pos, unit."""
    named = found.select(F.col("path").alias("source"), "dir", F.posexplode("includes").alias("pos", "name"))
    named = named.withColumn("basename", F.regexp_replace("name", r"^.*[/\\]", ""))
    return named.join(found.select("dir", "basename", F.col("path").alias("unit")), ["dir", "basename"]).select(
        "source", F.col("pos").cast("bigint").alias("pos"), "unit")


def source_units(found: DataFrame) -> DataFrame:
    """Every source with the files that speak for it: its headers in order, then itself."""
    own = found.where(F.col("basename").endswith(".c")).select(
        F.col("path").alias("source"), F.lit(OWN).cast("bigint").alias("pos"), F.col("path").alias("unit"))
    return included_headers(found).unionByName(own)


def definitions(found: DataFrame) -> DataFrame:
    """String definitions per file (G3): unit, at, key, value with quotes."""
    return found.select(F.col("path").alias("unit"), F.posexplode("defines").alias("at", "d")).select("unit", "at", "d.key", "d.value")


def declared_names(found: DataFrame, units: DataFrame) -> DataFrame:
    """Comma list of the protocol names that a source declares (G4): source, protocols.

    A symbol is resolved by the last definition seen up to that point: headers
    in order, then the file itself. Only the definitions that a symbol asks for meet
    the sources, so those of a header in wide use aren't repeated for each of them.
    """
    raw = found.select(F.col("path").alias("unit"), F.posexplode("names").alias("at", "raw"))
    uses = units.join(raw, "unit")
    quoted = F.col("raw").startswith('"') & F.col("raw").endswith('"')
    last = definitions(found).groupBy("unit", F.col("key").alias("raw")).agg(F.max_by("value", "at").alias("value"))
    before = units.select("source", F.col("pos").alias("_pos"), "unit")
    resolved = uses.where(~quoted).drop("unit").join(before, "source").where("_pos <= pos").join(last, ["unit", "raw"]).groupBy(
        "source", "pos", "at").agg(F.max_by("value", "_pos").alias("name"))
    names = uses.where(quoted).select("source", "pos", "at", F.col("raw").alias("name")).unionByName(resolved)
    names = names.withColumn("name", F.regexp_replace("name", '^"(?s:(.*))"$', "$1")).where("name <> ''")
    return names.groupBy("source").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "at", "name"))),
                                 lambda x: x["name"]), ",").alias("protocols"))


def protocol_names(found: DataFrame, units: DataFrame) -> DataFrame:
    """Declared names of each source, or what its file name says (G4, G5): source, protocols."""
    listed = declared_names(found, units).withColumnRenamed("protocols", "declared")
    sources = units.where(F.col("pos") == OWN).select("source").join(listed, "source", "left")
    stem = F.regexp_replace(F.substring_index("source", "/", -1), r"\.[^.]*$", "")
    fallback = F.when(F.lower(stem).startswith("packet-"), F.substring(stem, 8, 2147483647))
    return sources.select("source", F.coalesce("declared", fallback).alias("protocols")).where("protocols is not null")


def name_rejects(found: DataFrame, units: DataFrame) -> DataFrame:
    """Sources that register a protocol whose name can't be told, in the form of ``quality.REJECT_COLUMNS`` (H1)."""
    silent = found.where(F.col("registers") & F.col("basename").endswith(".c")).select(F.col("path").alias("source")).join(
        declared_names(found, units), "source", "left_anti")
    return silent.select(F.lit("mining").alias("stage"), F.col("source").alias("file"), F.lit(None).cast("bigint").alias("position"),
                         F.lit("unable to parse protocol name").alias("reason"), F.lit("warning").alias("severity"))


def literals(found: DataFrame) -> DataFrame:
    """Format texts and speculative texts per file (G6, G8): unit, phase, at, text."""
    texts = F.array(F.struct(F.lit(0).alias("phase"), F.col("formats").alias("texts")),
                    F.struct(F.lit(1).alias("phase"), F.col("guesses").alias("texts")))
    return found.select(F.col("path").alias("unit"), F.inline(texts)).select(
        "unit", "phase", F.posexplode("texts").alias("at", "text"))


def classify(lits: DataFrame) -> DataFrame:
    """Outcome and rule text of each literal (G7); failed ones have no rule text."""
    text = F.col("text")
    percent, colon = F.instr(text, "%"), F.instr(text, ":")
    early = (colon > 1) & ((percent == 0) | (percent > colon))
    second = F.substring_index(text, ":", 2) != text
    outcome = (F.when(F.col("phase") == 1, F.lit("Speculative"))
               .when((percent == 0) & (colon == 0), F.lit("Constant"))
               .when(early & ~second, F.lit("Prefix"))
               .when(early, F.lit("Failed - Multiple colons"))
               .otherwise(F.lit("Failed - No colon before first percent")))
    out = lits.withColumn("outcome", outcome)
    rule = (F.when(F.col("outcome") == "Prefix", F.substring_index(text, ":", 1))
            .when(F.col("outcome").isin("Constant", "Speculative"), text))
    return out.withColumn("rule_text", rule)


@dataclass
class Mined:
    rules: DataFrame  # kind, protocol, text, seq
    trace: DataFrame  # file, phase, at, text, outcome, n
    rejects: DataFrame


def mine(corpus: DataFrame) -> Mined:
    """Rules, trace and warnings of a corpus, which is read once.

    A file speaks once for each list of protocols, however many sources include it; ``n`` of the trace is
    the number of sources that a literal was met for.
    """
    found = stage(scan(corpus), "sources")
    units = stage(source_units(found), "units")
    spoken = stage(units.join(protocol_names(found, units), "source").groupBy("unit", "protocols").agg(
        F.min(F.struct("source", "pos")).alias("first"), F.count(F.lit(1)).alias("n")), "spoken")
    lits = classify(literals(found))
    trace = lits.join(spoken.groupBy("unit").agg(F.sum("n").alias("n")), "unit").select(
        F.col("unit").alias("file"), "phase", "at",
        F.coalesce(F.when(F.col("outcome") == "Prefix", F.col("rule_text")), "text").alias("text"), "outcome", "n")
    return Mined(first_rules(lits, spoken), trace, name_rejects(found, units))


def mined(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules and trace of a corpus."""
    out = mine(corpus)
    return out.rules, out.trace


def first_rules(lits: DataFrame, spoken: DataFrame) -> DataFrame:
    """First occurrence of each (kind, protocols, text); ``seq`` keeps corpus order."""
    once = lits.where(F.col("rule_text").isNotNull()).groupBy("unit", "outcome", "rule_text").agg(F.min(F.struct("phase", "at")).alias("place"))
    place = F.struct("first.source", "first.pos", "place.phase", "place.at")
    return once.join(spoken, "unit").groupBy(
        F.lower("outcome").alias("kind"), F.col("protocols").alias("protocol"), F.col("rule_text").alias("text")).agg(
        F.min(place).alias("seq"))


def write_trace(trace: DataFrame, path: str) -> None:
    """Trace as comma separated files with a header, by file and place (G10): file, text, outcome, n."""
    place = ["file", "phase", "at"]
    trace.repartitionByRange(*place).sortWithinPartitions(*place).select("file", "text", "outcome", "n").write.options(
        header="true", escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """Rule files as XML elements, grouped by source and readable by the rule loader.

    Each part is a whole ``<fixups>`` document; parts follow corpus order.
    """
    ordered = rules.repartitionByRange("seq").sortWithinPartitions("seq")
    for kind in ("constant", "prefix", "speculative"):
        ordered.where(F.col("kind") == kind).select(
            F.col("protocol").alias("_protocol"), F.col("text").alias("_text")).write.format("xml").option(
            "rootTag", "fixups").option("rowTag", kind).option("declaration", "version=\"1.0\"").save(f"{path}/{kind}")
