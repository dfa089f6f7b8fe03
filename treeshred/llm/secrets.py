"""Secret scan: Boolean trigram queries derived from the rules, an inverted index per segment, and verification."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as ops
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import FOLD, chunks, plain, read_documents, text_column

MAX_STRINGS = 64
SEGMENT_CHARS = 1 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the least length of ``group`` in a match; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds, in order. Of hex runs only those of 32 or more are looked for, which drops the same ones.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Kinds beyond the base ones: public token formats.
EXTRA = (
    Rule("temporary", r"ASIA[A-Z0-9]+", 0, 16),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("web_api", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9+/_.=~-]+)", 1, 20),
)
RULES = BASE + EXTRA

# A trigram query: None is "all documents", a frozenset of alternatives, each a frozenset of trigrams that all must occur.
Query = frozenset | None


def trigram_query(pattern: str) -> Query:
    """Trigrams, ASCII case folded, without which no text can match the regular expression.

    The parsed pattern is walked from left to right with the set of strings that can stand there exactly. Literals,
    small classes, groups and alternations extend the set; anything unbounded ends it, and
    what it holds becomes an alternative of trigram sets. Alternatives without a trigram make
    the part match everything. None is returned if nothing is mandatory.
    """
    found: list[Query] = []
    _flush(_walk(list(parser.parse(pattern)), [""], found), found)
    alternatives: Query = None
    for query in found:
        alternatives = query if alternatives is None else frozenset(a | b for a in alternatives for b in query)
    return alternatives


def _flush(strings: list[str], found: list[Query]) -> list[str]:
    options = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if options and frozenset() not in options:
        # An alternative that contains another one adds nothing to the union.
        found.append(frozenset(o for o in options if not any(p < o for p in options)))
    return [""]


def _characters(items) -> list[str] | None:
    """The characters of a small class, folded."""
    out: set[str] = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(_folded(value))
        elif op is ops.RANGE and value[1] - value[0] < 8:
            out.update(_folded(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return sorted(out)


def _folded(code: int) -> str:
    """A character as its UTF-8 bytes, ASCII case folded, one letter per byte."""
    return chr(code).encode("utf-8", "surrogatepass").translate(FOLD).decode("latin-1")


def _walk(tokens: list, strings: list[str], found: list[Query]) -> list[str]:
    for op, value in tokens:
        options = None
        if op is ops.LITERAL:
            options = [_folded(value)]
        elif op is ops.IN:
            options = _characters(value)
        elif op is ops.SUBPATTERN:
            strings = _walk(list(value[3]), strings, found)
            continue
        elif op is ops.BRANCH:
            options = _exact(value[1])
        elif op is ops.MAX_REPEAT:
            low, high, inner = value
            part = _exact([inner])
            if part is not None and high is not ops.MAXREPEAT and high <= 2:
                options = sorted({x for n in range(low, high + 1) for x in _power(part, n)})
            elif low:
                # At least one occurrence is mandatory; what comes after it is open.
                strings = _flush(_walk(list(inner), strings, found), found)
                continue
        if options is None or len(strings) * len(options) > MAX_STRINGS:
            strings = _flush(strings, found)
            if options is None:
                continue
        strings = [s + o for s in strings for o in options]
    return strings


def _power(part: list[str], n: int) -> list[str]:
    out = [""]
    for _ in range(n):
        out = [a + b for a in out for b in part]
    return out


def _exact(branches) -> list[str] | None:
    """All strings of some sub-patterns, if they are few and bounded."""
    out: list[str] = []
    for branch in branches:
        found: list[Query] = []
        strings = _walk(list(branch), [""], found)
        if found or not _bounded(list(branch)):
            return None
        out += strings
    return sorted(set(out)) if len(set(out)) <= MAX_STRINGS else None


def _bounded(tokens: list) -> bool:
    for op, value in tokens:
        if op is ops.LITERAL or op is ops.IN and _characters(value) is not None:
            continue
        if op is ops.SUBPATTERN and _bounded(list(value[3])):
            continue
        if op is ops.BRANCH and all(_bounded(list(b)) for b in value[1]):
            continue
        if op is ops.MAX_REPEAT and value[1] is not ops.MAXREPEAT and value[1] <= 2 and _bounded(list(value[2])):
            continue
        return False
    return True


class Scanner:
    """Rules with their queries, and the table of trigrams that an index needs to post."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
        wanted = sorted({t for _, _, q in self.rules if q for alt in q for t in alt})
        self.number = {t: i for i, t in enumerate(wanted)}
        self.slot = np.full(1 << 24, -1, np.int16)
        for t, i in self.number.items():
            a, b, c = t.encode("latin-1")
            self.slot[a << 16 | b << 8 | c] = i

    def index(self, texts: list[str]) -> list[np.ndarray]:
        """Postings of a segment: for each trigram in any query, the sorted documents that hold it."""
        data = [t.encode("utf-8", "surrogatepass").translate(FOLD) for t in texts]
        ends = np.cumsum([len(d) for d in data])
        codes = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
        empty = np.zeros(0, np.int64)
        if len(codes) < 3:
            return [empty] * len(self.number)
        slots = self.slot[codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]]
        at = np.flatnonzero(slots >= 0)
        doc = np.searchsorted(ends, at, "right")
        inside = at + 2 < ends[doc]
        pairs = np.unique(slots[at[inside]].astype(np.int64) * len(texts) + doc[inside])
        bounds = np.searchsorted(pairs, np.arange(len(self.number) + 1) * len(texts))
        return [pairs[a:b] - i * len(texts) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]

    def candidates(self, query: Query, postings: list[np.ndarray], n: int) -> np.ndarray:
        """Documents that meet a query; all of them if it has no mandatory trigram."""
        if query is None:
            return np.arange(n)
        out = np.zeros(0, np.int64)
        for alternative in query:
            lists = sorted((postings[self.number[t]] for t in alternative), key=len)
            held = lists[0]
            for other in lists[1:]:
                if not len(held):
                    break
                held = np.intersect1d(held, other, assume_unique=True)
            out = np.union1d(out, held)
        return out

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of every secret of every text, in code points, sorted."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.index(texts)
        for k, (rule, regex, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, len(texts)).tolist():
                for m in regex.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[i].append((m.start(), k, m.end()))
        for one in spans:
            one.sort()
        return spans


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end).

    Whole texts are scanned, null counts as empty. Rows are taken in
    segments of about a million characters; a segment's index lists, for every trigram that
    any rule needs, the documents that hold it. A rule's query intersects and unites these lists, and its regular expression is run
    over what is left. Rules without mandatory trigrams run over every text. Matches of a rule are leftmost
    and don't overlap; those of different rules may. Nothing is shuffled, so no group can be hot. Repeated rows and
    null ids pass through, other columns are dropped, no rows give none.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _SCANNERS.get(rules) or _SCANNERS.setdefault(rules, Scanner(rules))
        for batch in batches:
            texts = [t or "" for t in text_column(batch)]
            for a, b in chunks(texts, SEGMENT_CHARS):
                spans = [[(rules[k].kind, s, e) for s, k, e in one] for one in scanner.scan(texts[a:b])]
                rows = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in one] for one in spans], kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), rows], names=["doc_id", "spans"])

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    found = find_secrets(read_documents(spark, sf_dir))
    base = [r.kind for r in BASE]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[counted(k) for k in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
