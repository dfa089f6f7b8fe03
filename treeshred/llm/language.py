"""Language identification by cross-parsing: the language whose text explains a document in the fewest phrases wins."""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeshred.llm.common import chunks, plain, read_documents, text_column

# The training sample: so many documents of a language, so many first characters of each, and so many in all.
TRAIN_DOCS = 64
TRAIN_DOC_CHARS = 2000
TRAIN_CHARS = 30_000
BLOCK = 256
UNKNOWN, GAP = 0, 1
NO_LANGUAGE = "und"


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lower_letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if (c := chr(code)).isalpha():
            table[code] = ord(c.lower()[0])
    return table


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: from state 0, exactly the substrings of ``symbols`` can be read."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in go[p]:
            go[p][s] = new
            p = link[p]
        if p >= 0:
            q = go[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(s) == q:
                    go[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


class LanguageModel:
    """Automata of all languages in one table, and the alphabet: every letter of the training text has a symbol.

    Rows of states lie one over the other in the table, each moved to where its edges hit free entries: an edge is at
    the state's offset plus the symbol, and is the state's own if ``owner`` says so. Where it isn't, the phrase ends and
    the next one starts with the character that didn't fit. So the table grows with the edges, not with the alphabet.
    """

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        letters = lower_letters()
        coded = {}
        for name in self.languages:
            codes = letters[np.frombuffer(texts[name].encode("utf-32-le", "surrogatepass"), "<u4")]
            coded[name] = codes[(codes > 0) | np.concatenate(([False], codes[:-1] > 0))].tolist()
        known = sorted({c for codes in coded.values() for c in codes if c})
        symbol = {c: i + 2 for i, c in enumerate(known)}
        self.pad = len(known) + 2
        of_code = np.zeros(0x110000, np.int32)
        of_code[known] = np.arange(2, len(known) + 2)
        symbols = np.where(letters == 0, GAP, of_code[letters]).astype(np.int32)
        self.symbols = zlib.compress(symbols.tobytes())
        states: list[dict[int, int]] = []
        self.bits = []
        self.start = np.zeros((len(self.languages), self.pad + 1), np.int32)
        for n, name in enumerate(self.languages):
            line = [symbol[c] if c else GAP for c in coded[name]][:TRAIN_CHARS]
            base = len(states)
            go = suffix_automaton(line)
            states += [{s: base + to for s, to in edges.items()} for edges in go]
            # The last state stands behind a character that the language doesn't have: whatever follows is a new phrase.
            self.start[n] = len(states)
            self.start[n, list(states[base])] = list(states[base].values())
            states.append({})
            self.bits.append(math.log2(len(line) + 2))
        self._place(states)

    def _place(self, states: list[dict[int, int]]) -> None:
        """Find offsets for the rows, longest first, in a table of four times the edges."""
        size = 4 * sum(map(len, states)) + 1
        used, rnd = bytearray(size + self.pad + 1), random.Random(0)
        self.offset = np.zeros(len(states), np.int32)
        self.owner, self.target = np.full(len(used), -1, np.int32), np.zeros(len(used), np.int32)
        for state in sorted(range(len(states)), key=lambda i: -len(states[i])):
            edges = states[state]
            if not edges:
                break
            at = int(rnd.random() * size)
            while any(used[at + s] for s in edges):
                at = int(rnd.random() * size)
            self.offset[state] = at
            for s, to in edges.items():
                used[at + s] = 1
                self.owner[at + s], self.target[at + s] = state, to

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of whole texts."""
        symbols = _unpacked(self.symbols)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = symbols[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
        shown = codes != GAP
        ends = np.cumsum(sizes)
        held = np.concatenate(([0], np.cumsum(shown)))
        letters = held[ends] - held[ends - sizes]
        # Runs of other characters are one gap.
        keep = shown.copy()
        keep[1:] |= shown[:-1]
        kept = np.concatenate(([0], np.cumsum(keep)))
        n = kept[ends] - kept[ends - sizes]
        codes = codes[keep]
        blocks = -(-n // BLOCK)
        grid = np.full((int(blocks.sum()), BLOCK), self.pad, np.int32)
        doc_start = np.cumsum(blocks) - blocks
        where = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(doc_start * BLOCK, n)
        grid.ravel()[where] = codes
        phrases = self._parse(np.ascontiguousarray(grid.T))
        total = np.concatenate((np.zeros((len(self.languages), 1)), np.cumsum(phrases, axis=1)), axis=1)
        cost = (total[:, doc_start + blocks] - total[:, doc_start]) * np.array(self.bits)[:, None]
        return self._choose(cost, letters)

    def _parse(self, grid: np.ndarray) -> np.ndarray:
        """Phrases of each block under each language; all blocks advance together, character by character."""
        ended = np.ones((len(self.languages), grid.shape[1]), np.int32)
        # With the first character a phrase has just begun.
        state = self.start.take(grid[0], axis=1)
        for line in grid[1:]:
            at = self.offset.take(state)
            at += line
            fits = self.owner.take(at) == state
            state = np.where(fits, self.target.take(at), self.start.take(line, axis=1))
            # The padding is behind all characters.
            ended += ~fits & (line != self.pad)
        return ended

    def _choose(self, cost: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not len(self.languages):
            return [NO_LANGUAGE] * len(letters), np.zeros(len(letters))
        best = cost.argmin(axis=0)
        if len(self.languages) > 1:
            two = np.sort(cost, axis=0)[:2]
            score = 1 - two[0] / np.maximum(two[1], 1e-9)
        else:
            score = np.ones(len(letters))
        names = [self.languages[b] if has else NO_LANGUAGE for b, has in zip(best.tolist(), (letters > 0).tolist())]
        return names, np.where(letters > 0, np.clip(score, 0.0, 1.0), 0.0)


@lru_cache(maxsize=2)
def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.int32)


def train(docs: DataFrame) -> LanguageModel:
    """Learn from text and non-null lang of documents that are not held out.

    The sample is bounded by the constants above: the documents of a language with the smallest
    digests of their ids. They are ranked without their texts, each partition keeping its best
    first; then the texts of these few are fetched. Texts without letters teach nothing.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                        & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    best = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (usable.select("doc_id", "lang").withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= TRAIN_DOCS)
              .select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang")).distinct())
    # At most TRAIN_DOCS rows a language.
    rows = (usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("c_id")) & (F.col("lang") == F.col("c_lang")))
            .select("lang", "doc_id", F.substring("text", 1, TRAIN_DOC_CHARS).alias("text")).distinct().collect())
    texts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.doc_id, r.text)):
        texts.setdefault(row.lang, []).append(row.text)
    return LanguageModel({lang: "\n".join(parts) for lang, parts in texts.items()})


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every whole text.

    Letters are lower-cased and runs of anything else are one gap. From each state of a
    language's automaton the text is read as far as it goes on somewhere in the language's text; where it doesn't, a phrase
    ends. Phrases are counted in bits (phrases times the logarithm of the language's text length); fewest
    bits win, the smaller name if equal. Parses start anew every BLOCK characters, which costs every language the same.
    ``score`` is the lead over the second, 1 - best / second. Null texts and texts without a letter are ``und`` with score 0. Rows are independent:
    repeated rows and null ids pass through, other columns are dropped, no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in text_column(batch)]
            for a, b in chunks(texts):
                names, scores = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names), pa.array(scores)],
                                                 names=["doc_id", "lang_pred", "score"])

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(read_documents(spark, sf_dir), "doc_id", "text", "lang")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
