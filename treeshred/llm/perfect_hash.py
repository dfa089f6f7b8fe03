"""Minimal perfect hashes of term shards: build one, and look many terms up at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

KEYS_PER_BUCKET = 3
# Displacements tried at a time, and at most.
TRIALS = 64
MAX_TRIALS = 1 << 22
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def digests(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each term."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, terms)), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def build(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of each bucket, and the slot of each key: all slots below the number of keys, each taken once.

    Keys fall into buckets by ``first``. Buckets of several keys, largest first, get the smallest number that sends their keys to free
    slots by ``second``; a bucket of one key names a free slot itself, as -1 - slot.
    """
    n = len(first)
    n_buckets = max(1, -(-n // KEYS_PER_BUCKET))
    bucket = (first % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    ends = np.cumsum(sizes)
    shift, slots, free = np.zeros(n_buckets, np.int32), np.empty(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        keys = order[ends[b] - sizes[b]:ends[b]]
        shift[b], to = _first_fit(second[keys], free)
        slots[keys], free[to] = to, False
    alone = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    shift[alone] = -1 - left
    slots[order[ends[alone] - 1]] = left
    return shift, slots


def _first_fit(second: np.ndarray, free: np.ndarray) -> tuple[int, np.ndarray]:
    """The smallest displacement that sends keys to free slots, all different, and these slots; TRIALS are tried at a time."""
    for at in range(0, MAX_TRIALS, TRIALS):
        to = _slots(second, np.arange(at, at + TRIALS, dtype=np.uint64)[:, None], np.uint64(len(free)))
        for d in np.flatnonzero(free[to].all(axis=1)):
            if len(set(to[d].tolist())) == len(second):
                return at + int(d), to[d]
    raise ValueError("keys with equal digests have no perfect hash")


def _slots(second: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (_spread(second + shift * _GOLD) % n).astype(np.int64)


class Shards:
    """Perfect hashes of one language's shards in one table, with the stored keys that verify a hit.

    ``rows`` are (shard, n_keys, displacements, keys in slot order); ``n_shards`` is the number of shards of the whole language, of which
    these may be some.
    """

    def __init__(self, n_shards: int, rows: list[tuple[int, int, np.ndarray, pa.Array]]):
        self.n_shards = n_shards
        self.shards = np.array([r[0] for r in rows], np.int64)
        self.sizes = np.array([r[1] for r in rows], np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        self.buckets = np.array([len(r[2]) for r in rows], np.uint64)
        self.bucket_starts = np.concatenate(([0], np.cumsum(self.buckets))).astype(np.int64)
        self.shift = np.concatenate([r[2] for r in rows])
        self.keys = pa.concat_arrays([r[3] for r in rows])
        self.place = np.full(n_shards, -1, np.int64)
        self.place[self.shards] = np.arange(len(rows))

    def find(self, terms: list[bytes]) -> np.ndarray:
        """Slot of each term among all slots of these shards, -1 for terms that are not stored."""
        if not terms:
            return np.zeros(0, np.int64)
        first, second = digests(terms)
        at = self.place[shard_of(second, self.n_shards)]
        found = np.full(len(terms), -1, np.int64)
        here = np.flatnonzero(at >= 0)
        at, first, second = at[here], first[here], second[here]
        shift = self.shift[self.bucket_starts[at] + (first % self.buckets[at]).astype(np.int64)].astype(np.int64)
        to = np.where(shift < 0, -1 - shift, _slots(second, np.maximum(shift, 0).astype(np.uint64), self.sizes[at]))
        to += self.starts[at]
        same = pc.equal(self.keys.take(pa.array(to)), pa.array([terms[i] for i in here], pa.binary()))
        held = same.to_numpy(zero_copy_only=False)
        found[here[held]] = to[held]
        return found


def shard_of(second: np.ndarray, n_shards) -> np.ndarray:
    return ((second >> np.uint64(20)) % np.uint64(n_shards)).astype(np.int64)
