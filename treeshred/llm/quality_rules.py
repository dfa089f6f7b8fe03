"""Quality rules: base counts, and the divergence of a document from its language. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeshred.llm.common import SPACES, plain, read_documents
from treeshred.session import stage

MIN_WORDS = 50
# Percent of the words that may lie in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
# Least characters and words for a histogram to say anything, and the distances (0 to 1) from which it speaks against a document.
MIN_CHARS = 200
MIN_COMMON_WORDS = 80
MAX_CLASS_DISTANCE = 0.3
# The distance of words is judged as a share of the distance of a document without any common word.
MAX_WORD_SHARE = 0.9
# Common words of a language: those in the most of its documents of MIN_WORDS words or more; it has none below so many documents.
COMMON_WORDS = 20
MIN_LANGUAGE_DOCS = 20

CLASSES = ("n_upper", "n_digits", "n_marks", "n_symbols", "n_space", "n_rest")


def _all_but(text: Column, pattern: str) -> Column:
    """Characters of a text that are in a class, from what is left without them."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))


def _rows(docs: DataFrame) -> DataFrame:
    return plain(docs, "doc_id", "text", "lang").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))


def common_words(docs: DataFrame) -> dict[str, list[str]]:
    """The COMMON_WORDS words that stand in the most documents of each language, over all its documents of MIN_WORDS words or more.

    Words are counted once a document, partially before the shuffle, and the empty word counts the documents; equal counts go by
    the word. Languages of fewer than MIN_LANGUAGE_DOCS such documents, and null, have none. One row of words for each language
    reaches the driver.
    """
    long = _rows(docs).where("lang IS NOT NULL").select("lang", _words(F.col("text")).alias("words")).where(F.size("words") >= MIN_WORDS)
    counted = long.select("lang", F.explode(F.array_append(F.array_distinct("words"), "")).alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("word") != "", F.desc("n"), "word"))
    listed = (counted.withColumn("k", place).where(F.col("k") <= COMMON_WORDS + 1).groupBy("lang")
              .agg(F.array_sort(F.collect_list(F.struct("k", "n", "word"))).alias("words")))
    return {r["lang"]: [x["word"] for x in r["words"][1:]] for r in listed.collect() if r["words"][0]["n"] >= MIN_LANGUAGE_DOCS}


def base_counts(docs: DataFrame, common: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, lang, base counts, class counts (CLASSES) and ``hits``, how often each common word of its language stands in a document.

    Everything is computed within the row. For repeated windows the hashes of all three-word windows are taken;
    only where two are equal are they sorted with their places, and the words they
    cover counted from the gaps between places. Null texts count as empty. ``hits`` is null for a language without common words.
    """
    common = common or {}
    rows = _rows(docs).withColumn("words", _words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines).withColumn("n_words", F.size("words").cast("long"))
    windows = F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    every = sorted({w for words in common.values() for w in words})
    rows = rows.withColumn("windows", windows).withColumn("common", F.filter("words", lambda w: w.isin(every)))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn("placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(none))
    again = F.filter("placed", lambda p, k: F.get("placed", k - 1)["h"].eqNullSafe(p["h"])
                     | F.get("placed", k + 1)["h"].eqNullSafe(p["h"]))
    rows = rows.withColumn("places", F.array_sort(F.transform(again, lambda p: p["i"])))
    covered = F.aggregate(F.transform("places", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - i, F.lit(3)))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    # Without each word in turn: what is missing then is how often it stands there.
    hits = F.transform(_of_language(common, "array<string>"), lambda x: (
        F.size("common") - F.size(F.array_remove("common", x))).cast("long"))
    counted = rows.select(
        "doc_id", "lang", "n_words", F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("n_chars"),
        _all_but(F.col("text"), r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        _all_but(F.col("text"), r"\p{Lu}+").alias("n_upper"),
        _all_but(F.col("text"), r"[0-9]+").alias("n_digits"),
        _all_but(F.col("text"), r"[.,;:!?'\"()\-]+").alias("n_marks"), hits.alias("hits"))
    counted = counted.withColumn("n_space", F.col("n_chars") - F.col("word_chars"))
    return counted.withColumn("n_rest", F.col("n_chars") - F.col("n_space") - F.col("n_symbols") - F.col("n_upper")
                              - F.col("n_digits") - F.col("n_marks"))


def _of_language(values: dict, kind: str) -> Column:
    """The value of a row's language, null where it has none."""
    if not values:
        return F.lit(None).cast(kind)
    lit = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    return F.try_element_at(F.create_map(*[x for name, v in sorted(values.items()) for x in (F.lit(name), lit(v))]), F.col("lang")).cast(kind)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def distance(counts: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of a histogram from a reference of shares; an empty one has none (null)."""
    total = F.aggregate(counts, F.lit(0).cast("double"), lambda s, x: s + x)
    ref = reference if isinstance(reference, Column) else F.array(*[F.lit(float(q)) for q in reference])

    def part(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / middle)).otherwise(F.lit(0.0))
                + F.when(q > 0, q * F.log2(q / middle)).otherwise(F.lit(0.0)))

    # The shares first, each function's argument bound once: what is named here is computed wherever it stands.
    shares = F.get(F.transform(F.array(total), lambda t: F.transform(counts, lambda x: x / t)), 0)
    terms = F.zip_with(shares, ref, part)
    bits = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
    return F.when(total > 0, F.sqrt(F.greatest(bits, F.lit(0.0))))


def bare_distance(reference: list[float]) -> float:
    """Distance from a reference of words, its last share the other words, of a document that has no common word."""
    rest = reference[-1]
    bits = (1 - rest + math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0.0)) / 2
    return math.sqrt(max(bits, 0.0))


def references(counted: DataFrame, common: dict[str, list[str]]) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of character classes and of common words in each language, over all its documents that pass the base rules.

    One row for each language with common words reaches the driver.
    """
    if not common:
        return {}
    words = [F.sum(F.get("hits", F.lit(k))).alias(f"w{k}") for k in range(COMMON_WORDS)]
    rows = (counted.where(F.col("lang").isin(list(common)) & ~base_failed()).groupBy("lang")
            .agg(*[F.sum(c).alias(c) for c in CLASSES], F.sum("n_words").alias("n"), *words).collect())
    found = {}
    for row in rows:
        held = [row[f"w{k}"] for k in range(len(common[row["lang"]]))]
        found[row["lang"]] = (_shares([row[c] for c in CLASSES]), _shares([*held, row["n"] - sum(held)]))
    return found


def _shares(counts: list[int]) -> list[float]:
    total = sum(counts)
    return [c / total if total else 0.0 for c in counts]


def judge(counted: DataFrame, refs: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Add base_failed, class_distance, word_share and kept.

    The character classes of a document are compared with those of its own language, or with all where that is null or has no
    reference, and the nearest counts. Its words are compared with those of its own language only: ``word_share`` is their distance
    over that of a document without any common word. Histograms below the length guards, and the words of a document whose
    language is null or has no reference, say nothing.
    """
    counts = F.transform("hits", lambda x: x.cast("double"))
    rest = F.col("n_words") - F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    counted = counted.withColumns({"classes": F.array(*[F.col(c).cast("double") for c in CLASSES]), "counts": F.concat(counts, F.array(rest))})
    classes = F.col("classes")
    bare = {name: bare_distance(of_words) for name, (_, of_words) in refs.items()}
    share = distance(F.col("counts"), _of_language({name: r[1] for name, r in refs.items()}, "array<double>"))
    own_share = F.when(_of_language(bare, "double") > 0, share / _of_language(bare, "double"))
    own_class = distance(classes, _of_language({name: r[0] for name, r in refs.items()}, "array<double>"))
    if refs:
        nearest = F.array_min(F.array(*[distance(classes, r[0]) for _, r in sorted(refs.items())]))
        own_class = F.when(F.col("lang").isin(list(refs)), own_class).otherwise(nearest)
    judged = counted.withColumns({
        "base_failed": base_failed(),
        "class_distance": F.when(F.col("n_chars") >= MIN_CHARS, own_class),
        "word_share": F.when(F.col("n_words") >= MIN_COMMON_WORDS, own_share)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("class_distance") <= MAX_CLASS_DISTANCE, F.lit(True))
                             & F.coalesce(F.col("word_share") <= MAX_WORD_SHARE, F.lit(True)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, distances and verdict.

    Words are maximal runs without ASCII white space, in whole texts. Null and empty texts have no words and fail the base
    rules. Rows are independent, so repeated rows and null ids pass through; extra columns are
    dropped; an empty table gives an empty result. The texts are read twice: for the common words of each language, and for
    the counts, which are written; the references are summed from these.
    """
    common = common_words(docs)
    counted = stage(base_counts(docs, common), "rules-counts")
    return judge(counted, references(counted, common))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
ws AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM ws)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n > 1),
cover AS (SELECT rid, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) AS v(j) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
counts AS (
  SELECT d.rid, d.doc_id, d.lang, length(t) AS n_chars, CAST(len(ws.ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS n_digits,
         length(t) - length(regexp_replace(t, '[.,;:!?''"()\-]', '', 'g')) AS n_marks
  FROM d JOIN ws USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN cover USING (rid)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
                n_chars - word_chars AS n_space FROM counts),
long AS (SELECT d.rid, lang, ws FROM d JOIN ws USING (rid) WHERE lang IS NOT NULL AND len(ws) >= {MIN_WORDS}),
spread AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(list_distinct(ws)) AS word FROM long) GROUP BY ALL),
common AS (SELECT lang AS cl, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) - 1 AS k FROM spread
           WHERE lang IN (SELECT lang FROM long GROUP BY lang HAVING count(*) >= {MIN_LANGUAGE_DOCS})
           QUALIFY k < {COMMON_WORDS}),
langs AS (SELECT DISTINCT cl FROM common),
class AS (
  SELECT rid, k, c FROM (SELECT rid, unnest([n_upper, n_digits, n_marks, n_symbols, n_space,
    n_chars - n_space - n_symbols - n_upper - n_digits - n_marks]) AS c, unnest([0, 1, 2, 3, 4, 5]) AS k FROM base)),
found AS (SELECT rid, word, count(*) AS c FROM (SELECT rid, unnest(ws) AS word FROM ws) GROUP BY ALL),
hit AS (SELECT base.rid, cl, k, coalesce(c, 0) AS c FROM base JOIN common ON cl = lang
        LEFT JOIN found ON found.rid = base.rid AND found.word = common.word),
wordh AS (SELECT rid, cl, k, c FROM hit UNION ALL
          SELECT hit.rid, cl, 99, any_value(n_words) - sum(c) FROM hit JOIN base ON base.rid = hit.rid GROUP BY ALL),
cref AS (SELECT lang AS cl, k, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q
         FROM class JOIN base USING (rid) WHERE NOT base_failed AND lang IN (SELECT cl FROM langs) GROUP BY lang, k),
wref AS (SELECT cl, k, sum(c) / sum(sum(c)) OVER (PARTITION BY cl) AS q
         FROM wordh JOIN base USING (rid) WHERE NOT base_failed GROUP BY cl, k),
cand AS (SELECT rid, cl FROM base, (SELECT DISTINCT cl FROM cref) WHERE lang = cl OR lang IS NULL OR lang NOT IN (SELECT cl FROM cref)),
cp AS (SELECT cand.rid, cand.cl, q, c / nullif(sum(c) OVER (PARTITION BY cand.rid, cand.cl), 0) AS p
       FROM cand JOIN class ON class.rid = cand.rid JOIN cref ON cref.cl = cand.cl AND cref.k = class.k),
wp AS (SELECT rid, cl, q, c / nullif(sum(c) OVER (PARTITION BY rid, cl), 0) AS p FROM wordh JOIN wref USING (cl, k)),
dist AS (
  SELECT kind, rid, cl, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS v
  FROM (SELECT 'c' AS kind, * FROM cp UNION ALL SELECT 'w', * FROM wp) WHERE p IS NOT NULL GROUP BY ALL),
near AS (SELECT rid, min(v) AS c FROM dist WHERE kind = 'c' GROUP BY rid),
bare AS (SELECT cl, sqrt(greatest(sum(CASE WHEN k <> 99 THEN q ELSE log2(2 / (1 + q))
    + CASE WHEN q > 0 THEN q * log2(2 * q / (1 + q)) ELSE 0 END END) / 2, 0)) AS v FROM wref GROUP BY cl),
share AS (SELECT rid, min(dist.v / nullif(bare.v, 0)) AS s FROM dist JOIN bare USING (cl) WHERE kind = 'w' GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (n_chars < {MIN_CHARS} OR coalesce(near.c <= {MAX_CLASS_DISTANCE}, true))
         AND (n_words < {MIN_COMMON_WORDS} OR coalesce(share.s <= {MAX_WORD_SHARE}, true)) AS kept
FROM base LEFT JOIN near USING (rid) LEFT JOIN share USING (rid)
"""
