"""BPE encoding by a priority queue of merge ranks over a linked symbol list, and decoding by vocabulary strings."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeshred.llm.common import TEXT_ROWS, chunks, plain, read_documents, text_column
from treeshred.llm.pieces import PieceEncoder, classes, packed_classes

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next free from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class MergeTable:
    """Vocabulary and merge ranks of a byte-level tokenizer file."""

    def __init__(self, file: str):
        data = json.loads(file)
        vocab = data["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = [vocab[c] for c in letters]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(data["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(letters)}
        strings = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        self.strings = [bytes(byte_of[c] for c in strings[i]) for i in range(max(strings) + 1)]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece.

        Symbols are a doubly linked list over the positions of the bytes. The
        queue holds (rank, position) of every adjacent pair that can merge; an entry is
        stale if the pair at its position has changed, and is skipped. Equal
        ranks merge from the left. The time is n log n, also for a piece of a million bytes.
        """
        symbols = [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        merges = self.merges
        queue = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, found[1]))
        if not queue:
            return symbols
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, i, merged = heapq.heappop(queue)
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            found = merges.get((symbols[i], symbols[j]))
            if found is None or found[0] != rank:
                continue
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((merged, symbols[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, found[1]))
        return [s for s in symbols if s >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [self.encode_piece(p) for p in pieces]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in a row, as UTF-8; bytes that are none become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, tuple[MergeTable, PieceEncoder]] = {}


def load(file, packed: bytes) -> tuple[MergeTable, PieceEncoder]:
    """Table and encoder of a broadcast tokenizer file; one per Python worker, whatever its tasks."""
    key = hashlib.sha256(file.value.encode()).hexdigest()
    if key not in _LOADED:
        table = MergeTable(file.value)
        _LOADED[key] = table, PieceEncoder(table.encode_pieces, table.special, classes(packed))
    return _LOADED[key]


def shared_file(spark: SparkSession, path: str):
    """A tokenizer file, read by the driver and sent to the executors: its size doesn't depend on the data."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoded(batches: Iterator[pa.RecordBatch], file, packed: bytes):
    """(batch, row range, ids, bounds, table) for parts of each batch."""
    table, encoder = load(file, packed)
    for whole in batches:
        for at in range(0, whole.num_rows, TEXT_ROWS):
            batch = whole.slice(at, TEXT_ROWS)
            texts = [t or "" for t in text_column(batch)]
            for a, b in chunks(texts):
                ids, bounds = encoder.ids(texts[a:b])
                yield batch.slice(a, b - a), ids, bounds.tolist(), table
    pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Rows of ``docs`` as doc_id, ids (array of int), n_tokens, restored, for whole texts.

    ``restored`` tells that decoding the ids gave the text again. Null texts count as empty and have no ids. Strings of special tokens in a text become
    their id. Rows are independent: repeated rows and null ids pass through, other columns are dropped, no rows give none.
    """
    file, packed = shared_file(docs.sparkSession, tokenizer), packed_classes()

    def run(batches):
        for batch, ids, bounds, table in _encoded(batches, file, packed):
            listed = ids.tolist()
            same = [table.decode(listed[a:b]) == (t or "") for a, b, t in zip(bounds, bounds[1:], text_column(batch))]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(np.diff(bounds), pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "ids", "n_tokens", "restored"])

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, restored boolean")


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Texts of (doc_id, ids), as doc_id, text. Null ids count as none."""
    file, packed = shared_file(encoded.sparkSession, tokenizer), packed_classes()

    def run(batches):
        table, _ = load(file, packed)
        for batch in batches:
            texts = [table.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return plain(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them, without moving the ids."""
    file, packed = shared_file(docs.sparkSession, tokenizer), packed_classes()

    def run(batches):
        for batch, ids, bounds, table in _encoded(batches, file, packed):
            little = ids.astype("<u4").tobytes()
            listed = ids.tolist()
            sha, back = [], []
            for a, b in zip(bounds, bounds[1:]):
                sha.append(hashlib.sha256(little[4 * a:4 * b]).hexdigest())
                back.append(hashlib.sha256(table.decode(listed[a:b]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(sha), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read_documents(spark, sf_dir))
