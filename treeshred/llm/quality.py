"""Quality classifier from weak labels: EM over overlapping heuristics, then a hashed linear scorer."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from treeshred.llm.common import plain, read_documents
from treeshred.session import stage

ABSTAIN, GOOD, BAD = 0, 1, 2
MIN_WORDS = 20
# Shares of repeats are taken of at least so many windows and lines: one repeated line in a short text is no fault.
LEAST_WINDOWS, LEAST_LINES = 40, 8
# The scorer's training sample: so many documents of either side, those with the smallest digests.
TRAIN_DOCS = 1000
BUCKETS = 1 << 16
EPOCHS = 150
THRESHOLD = 0.5
# Beta prior of a labeller's false accusations: its mean is the share of unaccused documents that it leaves undecided, and at least
# LEAST_FALSE; it weighs FALSE_WEIGHT times all documents.
LEAST_FALSE = 0.001
FALSE_WEIGHT = 100
MAX_CACHED_WORDS = 50_000

# Measures of a text, and for each a labeller: (measure, good up to, bad from). Between them, and for few words, it abstains.
MEASURES = ("symbols", "upper", "bangs", "bars", "repeats", "lines", "ends", "odd_lengths")
LABELLERS = (
    ("symbols", 0.05, 0.3),      # symbols #*$%&|<> per word
    ("upper", 0.2, 0.5),         # share of capitals among the ASCII letters
    ("bangs", 0.05, 0.3),        # "!!" per word
    ("bars", 0.02, 0.1),         # "|" per word
    ("repeats", 0.1, 0.3),       # share of three-word windows that occurred before
    ("lines", 0.15, 0.4),        # share of lines that occurred before
    ("ends", 0.25, 0.5),         # share of words that end a sentence
    ("odd_lengths", 0.1, 0.4),   # distance of the mean word length from the range of 3 to 12
)
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_ENDS = (b".", b"!", b"?")


def measures(text: str | None) -> tuple[int, tuple[float, ...]]:
    """Words of a whole text and its measures. Without words all measures are 0."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return 0, (0.0,) * len(MEASURES)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    small = len(data) - len(data.translate(None, _SMALL))
    windows = max(1, n - 2)
    lines = [x for x in data.split(b"\n") if x.strip()]
    mean = sum(map(len, words)) / n
    return n, (
        (len(data) - len(data.translate(None, b"#*$%&|<>"))) / n,
        capitals / max(1, capitals + small),
        data.count(b"!!") / n,
        data.count(b"|") / n,
        (windows - len(set(zip(words, words[1:], words[2:])))) / max(windows, LEAST_WINDOWS) if n > 2 else 0.0,
        (len(lines) - len(set(lines))) / max(len(lines), LEAST_LINES),
        sum(w.endswith(_ENDS) for w in words) / n,
        max(0.0, 3 - mean, mean - 12) / 10,
    )


def votes(n: int, values: tuple[float, ...]) -> str:
    """One digit for each labeller; all abstain on fewer than MIN_WORDS words."""
    if n < MIN_WORDS:
        return str(ABSTAIN) * len(LABELLERS)
    out = []
    for name, good, bad in LABELLERS:
        x = values[MEASURES.index(name)]
        out.append(GOOD if x <= good else BAD if x >= bad else ABSTAIN)
    return "".join(map(str, out))


@dataclass(frozen=True)
class LabelModel:
    """Prior of a bad document, and for each labeller its vote probabilities under good and bad."""

    prior: float
    table: np.ndarray  # labeller, class (good, bad), vote

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Probability that documents of these vote patterns are good."""
        codes = np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), self.table.shape[0])
        logs = np.zeros((len(patterns), 2)) + np.log([1 - self.prior, self.prior])
        for k in range(self.table.shape[0]):
            # An abstention says nothing about quality.
            logs += np.where(codes[:, k, None] == ABSTAIN, 0.0, np.log(self.table[k])[:, codes[:, k]].T)
        top = logs.max(axis=1, keepdims=True)
        share = np.exp(logs - top)
        return share[:, 0] / share.sum(axis=1)


def estimate(patterns: list[str], counts: list[int], rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over all documents, given as counts of vote patterns.

    Each labeller looks for one fault, so most of them are content with any bad document, and votes of one labeller alone may be either a
    fault that only it can see or false accusations: overlaps can't tell these apart. It therefore starts with the belief that a bad vote is
    nearly always right, and false accusations have a Beta prior. Values of good documents that reach a labeller's bad side
    run through its undecided range, too: so the share of documents on which it abstains, of those that no labeller accuses, is the mean of that prior. All-abstaining
    documents, which are too short to judge, don't count. Hits on bad documents have a flat prior.
    """
    k = len(LABELLERS)
    codes = np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), k)
    weight = np.array(counts, float)
    silent = (codes == ABSTAIN).all(axis=1)
    judged = weight[~silent].sum()
    clean = weight * ~silent * ~(codes == BAD).any(axis=1)
    unsure = (codes == ABSTAIN).T @ clean / max(clean.sum(), 1)
    mean = np.clip(unsure, LEAST_FALSE, 0.5)
    good = np.where((codes == BAD).any(axis=1), 0.01, 0.999)
    good[silent] = 0.9
    model = LabelModel(0.1, np.full((k, 2, 3), 1 / 3))
    for _ in range(rounds):
        table = np.empty((k, 2, 3))
        for i in range(k):
            for c, share in enumerate((good, 1 - good)):
                prior_votes = max(FALSE_WEIGHT * judged, 1) * np.array([0.0, 1 - mean[i], mean[i]]) if c == 0 else np.ones(3)
                seen = np.bincount(codes[:, i], weight * share, 3) + prior_votes
                table[i, c] = seen / seen[1:].sum()
        total = weight.sum()
        prior = float(np.clip(((1 - good) * weight).sum() / total if total else 0.1, 0.001, 0.5))
        model = LabelModel(prior, table)
        good = model.posterior(patterns) if len(patterns) else good
    return model


def shape(word: bytes) -> str:
    """Outline of a word: runs of capitals, small letters, digits and other bytes, symbols as they are."""
    out = []
    for b in word:
        c = "A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b > 127 else "0" if 48 <= b <= 57 else chr(b)
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out[:12])


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


class _WordBuckets(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = bucket("shape:" + shape(word))
        return value


def features(text: str | None, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text: shares of its word shapes, and a step for each measure."""
    n, values = measures(text)
    steps = [bucket(f"{name}:{min(10, int(20 * x))}") for name, x in zip(MEASURES, values)] if n >= MIN_WORDS else []
    if not n:
        return np.zeros(0, np.int64), np.zeros(0)
    if len(known) > MAX_CACHED_WORDS:
        known.clear()
    seen, times = np.unique(np.fromiter(map(known.__getitem__, text.encode("utf-8", "surrogatepass").split()), np.int64, n),
                            return_counts=True)
    return np.concatenate((seen, np.array(steps, np.int64))), np.concatenate((times / n, np.full(len(steps), 0.25)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels: weights of all buckets, and the bias."""
    weights, bias = np.zeros(BUCKETS), 0.0
    if not len(rows):
        return weights, bias
    index = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    square, square_bias = np.full(BUCKETS, 1e-6), 1e-6
    for _ in range(EPOCHS):
        z = np.bincount(row, weights[index] * value, len(rows)) + bias
        error = 1 / (1 + np.exp(-z)) - target
        slope = np.bincount(index, error[row] * value, BUCKETS) / len(rows) + 1e-5 * weights
        square += slope * slope
        weights -= 0.5 * slope / np.sqrt(square)
        square_bias += error.mean() ** 2
        bias -= 0.5 * error.mean() / np.sqrt(square_bias)
    return weights, bias


@dataclass(frozen=True)
class Scorer:
    """Weights, and the score of texts that are too short to judge: the estimated share of good documents."""

    weights: np.ndarray
    bias: float
    share: float = 0.5

    def score(self, text: str | None, known: dict[bytes, int]) -> float:
        if len((text or "").encode("utf-8", "surrogatepass").split()) < MIN_WORDS:
            return self.share
        index, value = features(text, known)
        return float(1 / (1 + np.exp(-np.clip((self.weights[index] * value).sum() + self.bias, -30, 30))))


def train(docs: DataFrame) -> tuple[LabelModel, Scorer]:
    """Label model from the votes on all documents; scorer from a bounded sample of them.

    Votes of all documents are counted by pattern: at most 3 to the number of labellers rows, whatever
    the data. For the scorer, TRAIN_DOCS documents on either side of posterior 1/2 are taken by the digest of their
    text, and their hashed features and posteriors are fetched. Fewer documents, or only one side, train on
    what there is; no documents give a scorer that says 1/2 to all.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = [votes(*measures(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(patterns, pa.string())], names=["th", "pattern"])

    texts = plain(docs, "text").where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("th"))
    voted = stage(texts.mapInArrow(run, "th long, pattern string"), "quality-votes")
    counted = [(r["pattern"], r["count"]) for r in voted.groupBy("pattern").count().collect()]
    model = estimate(*map(list, zip(*sorted(counted)))) if counted else estimate([], [])
    posterior = dict(zip([p for p, _ in counted], model.posterior([p for p, _ in counted]).tolist())) if counted else {}
    sides = [[p for p, x in posterior.items() if p.strip("0") and (x >= 0.5) == side] for side in (True, False)]
    chosen = [voted.where(F.col("pattern").isin(side)).select("th", "pattern").distinct().orderBy("th", "pattern").limit(TRAIN_DOCS)
              for side in sides if side]
    if not chosen:
        return model, Scorer(np.zeros(BUCKETS), 0.0)
    few = chosen[0] if len(chosen) == 1 else chosen[0].unionAll(chosen[1])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordBuckets()
        for batch in batches:
            found = [features(t, known) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["th", "pattern", "i", "v"])

    rows = (texts.join(F.broadcast(few), "th").select("text", "th", "pattern").dropDuplicates(["th"])
            .mapInArrow(sampled, "th long, pattern string, i array<long>, v array<double>").collect())
    rows = sorted(rows, key=lambda r: r.th)
    weights, bias = fit([(np.array(r.i, np.int64), np.array(r.v)) for r in rows], np.array([posterior[r.pattern] for r in rows]))
    return model, Scorer(weights, bias, 1 - model.prior)


def with_score(docs: DataFrame, scorer: Scorer, name: str = "quality_score") -> DataFrame:
    """Rows of ``docs`` with the probability that the document is good.

    Whole texts are scored. Texts of fewer than MIN_WORDS words, null among them, get the
    share of good documents: no rule speaks against them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(texts: pd.Series) -> pd.Series:
        known = _WordBuckets()
        scores = pd.Series([shared.value.score(t, known) for t in texts], dtype="float64")
        pa.default_memory_pool().release_unused()
        return scores

    return docs.withColumn(name, F.pandas_udf(score, DoubleType())(F.col("text")))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that the classifier accepts, columns unchanged; too short rows stay.

    Extra columns of any name are kept: the work is done on the row packed in one column.
    """
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("quality_row"))
    _, scorer = train(docs)
    return with_score(packed, scorer).where(F.col("quality_score") >= threshold).select("quality_row.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score, kept for every document."""
    docs = plain(read_documents(spark, sf_dir), "doc_id", "text")
    _, scorer = train(docs)
    return with_score(docs, scorer, "score").select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"))
