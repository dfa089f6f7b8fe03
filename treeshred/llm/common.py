"""What several operators share: word rule, ASCII folding, text batches, row identity."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs without ASCII white space; bytes.split() cuts at exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
# Lower-cases A-Z only. It works on UTF-8 bytes, as bytes of longer characters are all above 127.
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
CHUNK_CHARS = 1 << 18
TEXT_ROWS = 256
# Narrow rows that are sent to all executors at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def fold(text: str | None) -> bytes:
    """UTF-8 bytes of a text with A-Z lower-cased; nothing for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def each_text(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch one after the other, of which only TEXT_ROWS are Python strings at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    for at in range(0, len(column), TEXT_ROWS):
        yield from column.slice(at, TEXT_ROWS).to_pylist()


def chunks(texts: list[str | None], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` characters, so that memory follows the chunk and not the batch.

    A longer text is a chunk of its own and stays whole.
    """
    start = held = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n + 1
    if held:
        yield start, len(texts)


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in order: extra columns of any name can't clash with an operator's own."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def checked_broadcast(rows: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be sent around where it has at most BROADCAST_ROWS."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def without_marked(docs: DataFrame, digest: Column, marks: DataFrame) -> DataFrame:
    """Rows of ``docs`` except those that marks name, columns unchanged.

    ``marks`` is a written table of doc_id, th, times, goes: rows of this id and ``digest`` go, or, where ``goes`` is
    false, are ``times`` equal rows of which one stays, the one whose columns have the largest digest. Whole rows are joined
    with the marks once, and not moved while the marks are few; rows to merge are read apart, and only if there are any. Extra
    columns of any name are kept, as the row is packed in one column.
    """
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("th"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept_row"))
    named = marks.select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), "goes")
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th"))
    left = packed.join(checked_broadcast(named), same, "left_anti").select("kept_row.*")
    repeated = named.where("NOT goes")
    if repeated.isEmpty():
        return left
    merged = (packed.join(checked_broadcast(repeated), same, "left_semi").groupBy("doc_id", "th")
              .agg(F.max_by("kept_row", F.xxhash64(F.to_json("kept_row"))).alias("kept_row")))
    return left.unionAll(merged.select("kept_row.*"))


@contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Smaller Arrow batches for what is written meanwhile, where a row holds several whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)
