"""Splitting texts into the pieces that byte-level BPE encodes one by one, and a bounded cache of their ids."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa

# The Unicode white space characters.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, SPACE, OTHER = range(4)
# A Python worker lives on through all stages of a job, and so does its cache.
MAX_CACHED_PIECES = 200_000
MAX_CACHED_IDS = 4_000_000


@lru_cache(maxsize=1)
def packed_classes() -> bytes:
    """Compressed class of every code point.

    Python's Unicode tables may be older than the tokenizer library's: what
    Python has no category for in the planes in use is asked of the library.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    table = np.full(0x110000, OTHER, np.uint8)
    unknown = []
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            table[code] = LETTER
        elif kind[0] == "N":
            table[code] = NUMBER
        elif kind == "Cn" and code < 0x40000:
            unknown.append(code)
    # Around each character stand a letter before and a digit after: a cut shows which of the two it doesn't join.
    probe = ByteLevel(add_prefix_space=False)
    for at in range(0, len(unknown), 4000):
        part = unknown[at:at + 4000]
        cuts = {span[0] for _, span in probe.pre_tokenize_str("".join(f"\0a{chr(c)}1" for c in part))}
        for i, code in enumerate(part):
            if 4 * i + 2 not in cuts:
                table[code] = LETTER
            elif 4 * i + 3 not in cuts:
                table[code] = NUMBER
    table[WHITE_SPACE] = SPACE
    return zlib.compress(table.tobytes())


@lru_cache(maxsize=2)
def classes(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def split_pieces(texts: list[str], table: np.ndarray, whole: frozenset[str] = frozenset()) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces of all texts, the place of each piece among them in order, and the number of pieces of each text.

    A piece is a contraction, or a run of letters, numbers or other
    characters with at most one space before it, or white space; white space
    before a visible character leaves its last character apart. The rules look
    at neighbours only, so they are array operations over all texts at once.
    Texts in ``whole`` are one piece each.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    text = "".join(texts)
    n = len(text)
    if not n:
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = table[codes]
    space = kind == SPACE
    first = np.zeros(n + 1, bool)
    first[bounds[:-1]] = True
    first[n] = True
    shown_next = np.zeros(n, bool)
    shown_next[:-1] = ~space[1:]
    shown_next &= ~first[1:]
    changed = np.ones(n, bool)
    changed[1:] = kind[1:] != kind[:-1]
    # A visible character right after a plain space is joined to it.
    joined = np.zeros(n, bool)
    joined[1:] = codes[:-1] == 0x20
    start = np.where(space, changed | shown_next, changed & ~joined) | first[:n]
    _contractions(codes, start, first, n)
    if whole:
        for i, t in enumerate(texts):
            if t in whole:
                start[bounds[i] + 1:bounds[i + 1]] = False
    starts = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(starts, bounds))
    distinct, places = _distinct(text, codes, np.append(starts, n))
    return distinct, places, counts


def _distinct(text: str, codes: np.ndarray, cuts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct runs of a text between cuts, in order of their first place, and which of them each run is."""
    n = len(cuts) - 1
    runs = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(4 * cuts.astype(np.int64)), pa.py_buffer(codes)])
    found = runs.dictionary_encode()
    places = found.indices.to_numpy()
    # Places are numbered as they first occur: a run is the first of its kind where the highest number so far goes up.
    highest = np.maximum.accumulate(places)
    first = np.flatnonzero(np.diff(highest, prepend=-1))
    return [text[a:b] for a, b in zip(cuts[first].tolist(), cuts[first + 1].tolist())], places


def _contractions(codes: np.ndarray, start: np.ndarray, first: np.ndarray, n: int) -> None:
    """An apostrophe that begins a piece takes s, t, m, d, re, ve or ll with it."""
    at = np.flatnonzero((codes == 0x27) & start)
    at = at[at + 1 < n]
    at = at[~first[at + 1]]
    one = codes[at + 1]
    short = at[np.isin(one, [ord(c) for c in "stmd"])]
    rest = at[at + 2 < n]
    rest = rest[~first[rest + 2]]
    a, b = codes[rest + 1], codes[rest + 2]
    long = rest[((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))]
    for found, size in ((short, 2), (long, 3)):
        start[found + 1] = False
        after = found + size
        start[after[after < n]] = True


class PieceEncoder:
    """Ids of whole texts from ids of their pieces. ``encode`` gives the ids of pieces not seen lately.

    Ids are cached in two generations: frequent pieces outlive the many that a text brings once.

    ``special`` maps strings that are cut out of a text first and have one id.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], special: dict[str, int], table: np.ndarray,
                 most: int = MAX_CACHED_PIECES):
        self.encode, self.special, self.table, self.most = encode, special, table, most
        self._clear()
        self.before = {}, self.begin, self.length, self.flat

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.size, self.used = 0, 0
        self.begin, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.uint32)
        if self.special:
            self._add(list(self.special), np.ones(len(self.special), np.int64), np.array(list(self.special.values()), np.uint32))

    def _turn(self) -> None:
        """Begin a new generation. What is used again comes over from the one before, the rest goes with it."""
        before = self.index, self.begin, self.length, self.flat[:self.used].copy()
        self._clear()
        self.before = before

    def _learn(self, pieces: list[str]) -> None:
        """Add pieces with their ids from the generation before, or else encoded."""
        index, begin, length, flat = self.before
        at = np.fromiter(map(index.get, pieces, repeat(-1)), np.int64, len(pieces))
        known = at >= 0
        if known.any():
            lengths = length[at[known]]
            self._add(list(compress(pieces, known.tolist())), lengths, _gather(flat, begin[at[known]], lengths))
            pieces = list(compress(pieces, (~known).tolist()))
        ids = self.encode(pieces)
        self._add(pieces, np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32))

    def _add(self, pieces: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        total = len(ids)
        while self.size + len(pieces) > len(self.begin):
            self.begin, self.length = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.length, 2 * len(self.length))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.length[self.size:self.size + len(pieces)] = lengths
        self.begin[self.size:self.size + len(pieces)] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used:self.used + total] = ids
        self.index.update(zip(pieces, range(self.size, self.size + len(pieces))))
        self.size, self.used = self.size + len(pieces), self.used + total

    def segments(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Texts cut at special strings, and the number of segments of each."""
        out, counts = [], np.ones(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            for mark in self.special:
                if mark in text:
                    parts = [y for x in parts for y in ([x] if x in self.special else _around(x, mark))]
            out += parts
            counts[i] = len(parts)
        return out, counts

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's ids begin (one more entry at the end)."""
        # Two generations share the bounds.
        if self.size > self.most // 2 or self.used > MAX_CACHED_IDS // 2:
            self._turn()
        parts, counts = self.segments(texts)
        # Most pieces of a chunk repeat: only distinct ones become strings and are looked up.
        pieces, places, per_part = split_pieces(parts, self.table, frozenset(self.special))
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            # Only what was missing is looked up again.
            late = list(map(pieces.__getitem__, missing.tolist()))
            self._learn(late)
            at[missing] = np.fromiter(map(self.index.__getitem__, late), np.int64, len(late))
        at = at[places]
        length = self.length[at]
        ends = np.cumsum(length)
        out = _gather(self.flat, self.begin[at], length)
        piece_bounds = np.concatenate(([0], np.cumsum(per_part)))[np.concatenate(([0], np.cumsum(counts)))]
        return out, np.concatenate(([0], ends))[piece_bounds]


def _gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, one after the other."""
    ends = np.cumsum(length)
    return flat[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


def _around(text: str, mark: str) -> list[str]:
    parts = text.split(mark)
    return [y for x in parts[:-1] for y in (x, mark)] + parts[-1:]
