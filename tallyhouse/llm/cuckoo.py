"""One shard of a cuckoo filter: 16-bit marks, four to a bucket, two buckets for a key.

Keys are 16 hashed bytes. A mark (bytes 2 and 3) and its first bucket (bytes 8 and up) come from
different bytes of the key, and the first two are left to whoever deals keys out to shards; the second bucket is the first one XOR a hash of the mark, so that an entry can be moved or
deleted knowing nothing but its mark.
"""

import numpy as np

SLOTS = 4
LOAD = 0.9
_KICKS = 500


class Full(Exception):
    """No slot was found; the filter must be built anew with more buckets."""


def buckets_for(n_keys: int) -> int:
    """A power of two that holds ``n_keys`` below the load at which insertion gets hard."""
    return 1 << max(3, int(np.ceil(np.log2(max(1, n_keys) / (SLOTS * LOAD)))))


def _split(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks (never 0, which is an empty slot) and first buckets of 16-byte keys."""
    halves = keys.view("<u8").reshape(-1, 2)
    marks = (halves[:, 0] >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64)
    return np.where(marks == 0, 1, marks), (halves[:, 1] & np.uint64(n_buckets - 1)).astype(np.int64)


def _other(bucket, mark, n_buckets: int):
    return bucket ^ ((mark * 0x5BD1E995) & (n_buckets - 1))


class Shard:
    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def empty(cls, n_keys: int) -> "Shard":
        return cls(np.zeros((buckets_for(n_keys), SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, blob: bytes) -> "Shard":
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, first = _split(keys, len(self.table))
        second = _other(first, marks, len(self.table))
        wanted = marks.astype(np.uint16)[:, None]
        return (self.table[first] == wanted).any(axis=1) | (self.table[second] == wanted).any(axis=1)

    def insert(self, keys: np.ndarray) -> None:
        """Most keys find a slot in one of their buckets at once; the rest move others."""
        marks, first = _split(keys, len(self.table))
        left = self._place(marks, first)
        marks, first = marks[left], first[left]
        left = self._place(marks, _other(first, marks, len(self.table)))
        rng = np.random.default_rng(len(keys))
        for mark, bucket in zip(marks[left].tolist(), first[left].tolist(), strict=True):
            self._move(mark, bucket, rng.integers(0, SLOTS, _KICKS).tolist())

    def _place(self, marks: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Fills free slots; returns which keys found none."""
        order = np.argsort(buckets, kind="stable")
        ordered = buckets[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        slots = np.argsort(self.table[ordered] != 0, axis=1, kind="stable")
        fits = rank < (self.table[ordered] == 0).sum(axis=1)
        self.table[ordered[fits], slots[fits, rank[fits]]] = marks[order[fits]]
        left = np.ones(len(marks), bool)
        left[order[fits]] = False
        return left

    def _move(self, mark: int, at: int, slots: list[int]) -> None:
        for slot in slots:
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at = int(_other(at, mark, len(self.table)))
        raise Full

    def delete(self, keys: np.ndarray) -> None:
        """Keys must be in the filter; another key's equal mark serves as well as the own."""
        marks, first = _split(keys, len(self.table))
        for mark, bucket in zip(marks.tolist(), first.tolist(), strict=True):
            for at in (bucket, _other(bucket, mark, len(self.table))):
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break
