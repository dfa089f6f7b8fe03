"""Line deduplication: lines that several documents hold stay in one of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import chunks, fold, plain, read_documents, text_column
from treeshred.session import stage

MIN_CHARS = 10
MIN_DOCS = 2
SPACE = b" \t\n\x0b\x0c\r"

_LINES = "doc_id long, th long, key binary, places array<int>"


def _long_enough(line: bytes, least: int) -> bool:
    """Whether a line has ``least`` code points; bytes of the form 10xxxxxx only continue one."""
    if len(line) < least or len(line) >= 4 * least:
        return len(line) >= least
    return sum(b & 0xC0 != 0x80 for b in line) >= least


def line_keys(text: str | None, min_chars: int) -> dict[bytes, list[int]]:
    """Digest of each normalised line of a whole text that is long enough, with the lines that have it."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(fold(text).split(b"\n")):
        line = line.strip(SPACE)
        if _long_enough(line, min_chars):
            found.setdefault(xxhash.xxh3_128_digest(line), []).append(i)
    return found


def _exploded(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), text_column(batch)
        digests = batch.column(1).to_pylist()
        for start, end in chunks(texts):
            rows = [(ids[i], digests[i], key, places) for i in range(start, end)
                    for key, places in line_keys(texts[i], min_chars).items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())))],
                    names=["doc_id", "th", "key", "places"])


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """key, keep_id: lines that at least ``min_docs`` documents hold, with the smallest doc_id among these.

    Documents are told apart by id; rows without id count as one document, which keeps a line only if no
    other has it. Repeats of an id are merged first, then each line counts its ids; both are
    partially aggregated before the shuffle, so a line that every document holds is one row a task.
    """
    once = lines.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    return (once.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("keep_id"))
            .where(F.col("n_docs") >= min_docs).select("key", "keep_id"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, and ``kept``, its text without the dropped lines.

    A whole text is split at line feeds; null counts as empty, and an empty text has one empty line. A line's key
    is the line without ASCII white space at both ends, A-Z lower-cased. Lines whose key has ``min_chars`` code points
    or more and that ``min_docs`` documents or more hold go, all of them, except in the smallest doc_id that holds
    them, where all of them stay. Other lines stay as they are, in their order.

    Only digests (128 bits) and positions are exploded and joined, which Spark splits where a line is frequent.
    Positions to drop are then gathered per document, and the text is put together again by position. Rows that repeat an id
    and text are treated alike; rows of one id with other texts are one document with several rows. An empty table gives an empty
    result; extra columns are dropped.
    """
    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "text")
    lines = stage(rows.mapInArrow(lambda b: _exploded(b, min_chars), _LINES), "lines-keys")
    frequent = stage(frequent_lines(lines, min_docs), "lines-frequent")
    # As a set: repeated rows bring the same lists again, and lists of different lines differ.
    marks = (lines.join(frequent, "key").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("doc_id", "th").agg(F.flatten(F.collect_set("places")).alias("places")))
    marks = stage(marks.select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), "places"), "lines-marks")
    marked = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, places = batch.column(0), text_column(batch), batch.column(2)
            for start, end in chunks(texts):
                out = []
                for text, drop in zip(texts[start:end], places.slice(start, end - start).to_pylist()):
                    found, gone = (text or "").split("\n"), set(drop or ())
                    out.append((len(found), len(gone), "\n".join(x for i, x in enumerate(found) if i not in gone)))
                n, dropped, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_lines", "n_dropped", "kept"])

    return marked.select("doc_id", "text", "places").mapInArrow(
        rebuilt, "doc_id long, n_lines long, n_dropped long, kept string")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ten characters or more that two documents hold stay in the first of them."""
    return drop_lines(read_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = rf"""
WITH l AS (
  SELECT r, doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
f AS (SELECT k, min(doc_id) AS keep_id FROM l WHERE length(k) >= {MIN_CHARS} GROUP BY k
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= {MIN_DOCS})
SELECT l.doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k AND l.doc_id IS DISTINCT FROM f.keep_id
GROUP BY l.r, l.doc_id
"""
