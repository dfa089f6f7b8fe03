"""Token ids in Arrow stream files of fixed-size-list batches: equal-length sequences with masks, read without copying."""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.bpe import byte_letters, shared_file
from treeshred.llm.common import chunks, plain, read_documents, text_column
from treeshred.llm.pieces import PieceEncoder, classes, packed_classes
from treeshred.session import staging_root

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE = 1024
BATCH_SEQUENCES = 256
END_ID = 2
MAX_CACHED_PIECES = 400_000

_WRITTEN = "part int, path string, n_docs long, n_tokens long"
_LOADED: dict[str, tuple[PieceEncoder, int]] = {}


def _library_encoder(file, packed: bytes) -> tuple[PieceEncoder, int]:
    """Encoder whose ids come from the tokenizers library, piece by piece, and the vocabulary size; one per worker.

    A text's pieces repeat, so the library's model sees a piece once and not each time it occurs.
    """
    from tokenizers import Tokenizer

    key = hashlib.sha256(file.value.encode()).hexdigest()
    if key not in _LOADED:
        tokenizer = Tokenizer.from_str(file.value)
        letters = dict(enumerate(byte_letters()))
        model = tokenizer.model

        def pieces(new: list[str]) -> list[list[int]]:
            # All pieces become letters at once, one for each byte.
            sizes = [len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass")) for p in new]
            text = "".join(new).encode("utf-8", "surrogatepass").decode("latin-1").translate(letters)
            ends = list(accumulate(sizes))
            return [[t.id for t in model.tokenize(text[a:b])] for a, b in zip([0, *ends], ends)]

        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        _LOADED[key] = PieceEncoder(pieces, special, classes(packed), MAX_CACHED_PIECES), tokenizer.get_vocab_size()
    return _LOADED[key]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system behind a shared folder: file:, hdfs:, s3:, gs: or a plain path."""
    return pafs.FileSystem.from_uri(uri if ":" in uri else os.path.abspath(uri))


def sequence_schema(dtype: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(dtype, length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


class TokenWriter:
    """Write documents' ids one after the other as sequences of equal length; the last one is padded, its mask false there.

    Files appear under their name only when whole, so a repeated or lost task leaves no partial
    file; repeats have the same content.
    """

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int = SEQUENCE, per_batch: int = BATCH_SEQUENCES):
        self.system, base = file_system(folder)
        self.system.create_dir(base, recursive=True)
        self.final = [f"{base}/{name}.arrow", f"{base}/{name}.index.arrow"]
        self.open = [f"{base}/.{name}-{uuid.uuid4().hex}{x}" for x in ("", ".index")]
        self.length, self.room = length, length * per_batch
        self.schema = sequence_schema(pa.from_numpy_dtype(dtype), length)
        self.sinks = [self.system.open_output_stream(p) for p in self.open]
        self.ids = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.index = pa.ipc.new_stream(self.sinks[1], INDEX)
        self.buffer, self.filled = np.zeros(self.room, dtype), 0

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64())], schema=INDEX))
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.room - self.filled)
            self.buffer[self.filled:self.filled + n] = ids[at:at + n]
            self.filled, at = self.filled + n, at + n
            if self.filled == self.room:
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.length)
        self.buffer[self.filled:] = 0
        mask = np.arange(rows * self.length) < self.filled
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (self.buffer[:rows * self.length], mask)]
        self.ids.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.filled = 0

    def close(self) -> str:
        if self.filled:
            self._flush()
        for stream, sink in ((self.ids, self.sinks[0]), (self.index, self.sinks[1])):
            stream.close()
            sink.close()
        for temporary, final in zip(self.open, self.final):
            self.system.move(temporary, final)
        return self.final[0]


class TokenFile:
    """Random access to one file. On a local or mounted file system arrays point into the mapped file."""

    def __init__(self, system: pafs.FileSystem, path: str):
        if isinstance(system, pafs.LocalFileSystem):
            self.source = pa.memory_map(path)
        else:
            self.source = system.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.rows = self.batches[0].num_rows if self.batches else 1

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence ``i``."""
        batch, row = self.batches[i // self.rows], i % self.rows
        ids, mask = batch.column(0), batch.column(1)
        return (ids[row].values.to_numpy(zero_copy_only=True), mask[row].values.to_numpy(zero_copy_only=False))

    def parts(self) -> Iterator[np.ndarray]:
        """Ids without padding, batch by batch."""
        for batch in self.batches:
            mask = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield batch.column(0).flatten().to_numpy(zero_copy_only=True)[:int(mask.sum())]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      length: int = SEQUENCE) -> list:
    """Write the ids of all documents in ascending doc_id order; one row per file: part, path, n_docs, n_tokens.

    Whole texts (null: empty) are encoded, ``end_id`` is appended to each. One range shuffle by id puts the
    documents in order; each partition streams its own file. Null ids come first; rows of one id are
    ordered by a digest of the text, then by text. Extra columns are dropped; an empty table gives no file.
    The list has a row per file, not per document.
    """
    file, packed = shared_file(docs.sparkSession, tokenizer), packed_classes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = _library_encoder(file, packed)
        dtype = np.dtype(np.uint16 if vocabulary <= 1 << 16 else np.uint32)
        writer, part, n_docs, n_tokens = None, TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts, doc_ids = [t or "" for t in text_column(batch)], batch.column(0).to_pylist()
            for a, b in chunks(texts):
                writer = writer or TokenWriter(folder, f"part-{part:05d}", dtype, length)
                ids, bounds = encoder.ids(texts[a:b])
                writer.add(doc_ids[a:b], (np.diff(bounds) + 1).tolist(), np.insert(ids, bounds[1:], end_id))
                n_docs, n_tokens = n_docs + b - a, n_tokens + len(ids) + b - a
        if writer:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": writer.close(), "n_docs": n_docs, "n_tokens": n_tokens}],
                                             schema=pa.schema([("part", pa.int32()), ("path", pa.string()),
                                                               ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                                F.xxhash64("text").alias("h"))
    order = ["doc_id", "h"]
    files = (rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
             .mapInArrow(write, _WRITTEN).collect())
    return sorted(files, key=lambda r: r.part)


def read_token_files(spark: SparkSession, folder: str, files: list) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files; a task reads whole files."""
    starts, before = [], 0
    for row in files:
        starts.append((row.path, before))
        before += row.n_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(system, path, start)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    table = spark.createDataFrame(starts, "path string, start long")
    return table.repartition(max(1, len(starts))).mapInArrow(read, schema)


def _documents(system: pafs.FileSystem, path: str, start: int) -> Iterator[pa.RecordBatch]:
    parts = TokenFile(system, path).parts()
    data, at = memoryview(b""), 0
    with system.open_input_file(path.removesuffix(".arrow") + ".index.arrow") as source:
        for index in pa.ipc.open_stream(source):
            sizes, checks = index.column(1).to_numpy(), []
            for size in (4 * sizes).tolist():
                crc = 0
                while size:
                    if at == len(data):
                        data, at = memoryview(next(parts).astype("<u4").tobytes()), 0
                    n = min(size, len(data) - at)
                    crc = zlib.crc32(data[at:at + n], crc)
                    at, size = at + n, size - n
                checks.append(crc)
            begins = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([index.column(0), pa.array(begins), index.column(1), pa.array(checks, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{staging_root(spark)}/tokens/{uuid.uuid4().hex}"
    return read_token_files(spark, folder, write_token_files(read_documents(spark, sf_dir), folder))
