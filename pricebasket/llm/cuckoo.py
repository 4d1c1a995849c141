"""A cuckoo filter over 64-bit key hashes, vectorised with numpy.

Four slots of 16 bits per bucket; a key's two buckets are ``i`` and
``i ^ hash(tag)``, so a stored tag can be moved without its key.  A full
filter chains a further table, so an insertion never fails and a stored key
is never missed.  Tag 0 marks an empty slot.
"""

from __future__ import annotations

import struct

import numpy as np

SLOTS, MAX_KICKS, TARGET_LOAD = 4, 200, 0.85


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x


class CuckooFilter:
    def __init__(self, expected: int = 1):
        self.tables = [self._table(expected)]

    @staticmethod
    def _table(expected: int) -> np.ndarray:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, expected) / (SLOTS * TARGET_LOAD)))))
        return np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def _places(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(table) - 1)
        tags = (hashes >> np.uint64(48)).astype(np.uint16)
        tags[tags == 0] = 1
        first = _mix(hashes) & mask
        return tags, first.astype(np.int64), ((first ^ _mix(tags)) & mask).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """Per hash, whether it may be stored; a stored one always is True."""
        found = np.zeros(len(hashes), bool)
        for t in self.tables:
            tags, a, b = self._places(t, hashes)
            found |= (t[a] == tags[:, None]).any(1) | (t[b] == tags[:, None]).any(1)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        """Store each hash once more (a hash given twice is stored twice)."""
        left = hashes
        for i in range(64):
            if not len(left):
                return
            if i == len(self.tables):
                self.tables.append(self._table(max(len(left), 4 * len(self.tables[-1]))))
            left = self._fill(self.tables[i], left)
        raise RuntimeError("cuckoo filter: too many copies of one hash")

    def _fill(self, t: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Place what fits: in a free slot of either bucket, all keys at once,
        then key by key with evictions; returns the hashes that don't fit."""
        for pick in (1, 2):
            places = self._places(t, hashes)
            tags, at = places[0], places[pick]
            order = np.argsort(at, kind="stable")
            buckets, start = np.unique(at[order], return_index=True)
            rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
            free = (t == 0)
            slot_of = np.argsort(~free[at[order]], axis=1, kind="stable")
            fits = rank < free[at[order]].sum(1)
            rows = order[fits]
            t[at[rows], slot_of[fits, rank[fits]]] = tags[rows]
            hashes = hashes[np.sort(order[~fits])]
            if not len(hashes):
                return hashes
        tags, first, _ = self._places(t, hashes)
        mask, left = len(t) - 1, []
        for h, tag, at in zip(hashes, tags, first, strict=True):
            moved = []
            for kick in range(MAX_KICKS):
                row = t[at]
                free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = tag
                    break
                slot = (int(tag) + kick) % SLOTS
                moved.append((at, slot))
                tag, row[slot] = row[slot], tag
                at = at ^ (int(_mix(np.array([tag]))[0]) & mask)
            else:  # undo the moves, so that no stored tag is lost
                for at, slot in reversed(moved):
                    tag, t[at, slot] = t[at, slot], tag
                left.append(h)
        return np.array(left, np.uint64)

    def delete(self, hashes: np.ndarray) -> None:
        """Remove one copy of each hash; only hashes that were inserted may be given.

        Within a table, equal tags of one pair of buckets stand for each other.
        Between tables they don't: a hash whose tag is found in several may be
        another's there, so its tags stay, which costs a look-up but never hides
        a stored key."""
        found = np.zeros((len(self.tables), len(hashes)), bool)
        for i, t in enumerate(self.tables):
            tags, a, b = self._places(t, hashes)
            found[i] = (t[a] == tags[:, None]).any(1) | (t[b] == tags[:, None]).any(1)
        sure = found.sum(0) == 1
        for i, t in enumerate(self.tables):
            left, cells = hashes[found[i] & sure], t.reshape(-1)
            while len(left):
                tags, a, b = self._places(t, left)
                match = np.concatenate([t[a], t[b]], axis=1) == tags[:, None]
                rows = np.flatnonzero(match.any(1))
                slot = match[rows].argmax(1)
                cell = np.where(slot < SLOTS, a[rows], b[rows]) * SLOTS + slot % SLOTS
                first = np.unique(cell, return_index=True)[1]  # one hash a slot at a time
                cells[cell[first]] = 0
                left = np.delete(left[rows], first)

    def to_bytes(self) -> bytes:
        return b"".join(struct.pack("<I", len(t)) + t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out, at = cls(), 0
        out.tables = []
        while at < len(data):
            n = struct.unpack_from("<I", data, at)[0]
            out.tables.append(np.frombuffer(data, np.uint16, n * SLOTS, at + 4).reshape(n, SLOTS).copy())
            at += 4 + n * SLOTS * 2
        return out
