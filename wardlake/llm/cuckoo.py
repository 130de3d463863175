"""A cuckoo filter over 64-bit hashes whose operations take whole numpy arrays.

A key leaves a 16-bit fingerprint in one of two buckets of four places; the second bucket follows from the
first and the fingerprint, so a fingerprint can be moved without its key, and taken out again. Insertions
run in rounds: all pending fingerprints try their bucket, then the other one, and of the rest one for each
full bucket changes places with a resident. What is left after the last round goes to a further table of
the same size, so nothing is refused. A held key is always found; another is found with a probability of
some eight times the load in 2^16 per table.
"""

from __future__ import annotations

import numpy as np

from wardlake.llm.flat import mixed

PLACES = 4
LOAD = 0.85
ROUNDS = 200


def buckets_for(keys: int) -> int:
    """A power of two of buckets that holds `keys` keys at no more than the load."""
    return 1 << max(0, int(np.ceil(keys / (PLACES * LOAD))) - 1).bit_length()


class Cuckoo:
    """`slots` is (table, bucket, place) with 0 for an empty place."""

    def __init__(self, buckets: int, data: bytes | None = None):
        self.buckets = buckets
        held = np.zeros(buckets * PLACES, np.uint16) if data is None else np.frombuffer(data, np.uint16).copy()
        self.slots = held.reshape(-1, buckets, PLACES)

    def tobytes(self) -> bytes:
        return self.slots.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots))

    def _homes(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = np.ascontiguousarray(keys).view(np.uint64)
        prints = (keys & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (mixed(keys >> np.uint64(16)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = mixed(prints.astype(np.uint64) + np.uint64(1 << 32)) & np.uint64(self.buckets - 1)
        return bucket ^ step.astype(np.int64)

    @staticmethod
    def _turns(group: np.ndarray) -> np.ndarray:
        """How many equal entries stand before each one."""
        order = np.argsort(group, kind="stable")
        sorted_ = group[order]
        first = np.searchsorted(sorted_, sorted_, "left")
        turns = np.empty(len(group), np.int64)
        turns[order] = np.arange(len(group)) - first
        return turns

    def _place(self, table: np.ndarray, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints into empty places of their buckets; which of them found one."""
        taken = table[bucket] != 0
        turn = self._turns(bucket)
        fits = turn < PLACES - taken.sum(axis=1)
        column = np.argsort(taken, axis=1, kind="stable")[np.flatnonzero(fits), turn[fits]]
        table[bucket[fits], column] = prints[fits]
        return fits

    def insert(self, keys: np.ndarray) -> None:
        """Add keys; one that is held already is then held twice."""
        prints, bucket = self._homes(keys)
        for number in range(1 << 30):
            if number == len(self.slots):
                self.slots = np.concatenate([self.slots, np.zeros((1, self.buckets, PLACES), np.uint16)])
            table = self.slots[number]
            for turn in range(ROUNDS):
                for _ in range(2):
                    left = ~self._place(table, prints, bucket)
                    prints, bucket = prints[left], bucket[left]
                    bucket = self._other(prints, bucket)
                if not len(prints):
                    return
                full, one = np.unique(bucket, return_index=True)
                column = (prints[one] + turn) % PLACES
                out = table[full, column].copy()
                table[full, column] = prints[one]
                prints[one], bucket[one] = out, self._other(out, full)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = self._homes(keys)
        found = np.zeros(len(prints), bool)
        for home in (bucket, self._other(prints, bucket)):
            found |= (self.slots[:, home] == prints[None, :, None]).any(axis=(0, 2))
        return found

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are held; each takes one of its fingerprints."""
        prints, first = self._homes(keys)
        for table in self.slots:
            for moved in (False, True):
                home = self._other(prints, first) if moved else first
                same = table[home] == prints[:, None]
                turn = self._turns(home << 16 | prints)
                gone = turn < same.sum(axis=1)
                column = np.argsort(~same, axis=1, kind="stable")[np.flatnonzero(gone), turn[gone]]
                table[home[gone], column] = 0
                prints, first = prints[~gone], first[~gone]
                if not len(prints):
                    return
        raise KeyError(f"{len(prints)} keys are not in the filter")
