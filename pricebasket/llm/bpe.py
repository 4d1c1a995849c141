"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The merges wait in a queue with a bucket per merge rank.  A bucket holds
positions in the linked list of the pre-tokens' parts; a two-level bitmap over
the ranks finds the next non-empty bucket by find-first-set.  An entry is stale,
and skipped, if the pair at its position has changed since.  So a pre-token of n
bytes costs O(n log n) however long it is.

Short pre-tokens, nearly all, are merged many at a time, by whole columns: the
bitmap finds the lowest block of ranks, and every pre-token with entries in it
makes the merge of its lowest rank.  The ranks of pairs are looked up by the ids
of their two parts.

Texts are cut at whitespace runs into units (a run and the word after it; no
pre-token crosses the start of a run), and each worker remembers the ids of the
units it has met, in a table of bounded size.

Defined results: NULL is the empty text, which has no ids.  Rows repeated in
the input get equal rows back.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import remembered, table, utf8

BLOCK_BITS = 8
BLOCK_MASK = (1 << BLOCK_BITS) - 1
#: Half of the units and pre-tokens remembered per worker, about, and the longest ones remembered.
CACHE_UNITS, CACHE_PIECES, CACHE_CHARS = 200_000, 250_000, 64
#: Bytes of text whose units are held at once (a longer text is held alone).
PART_CHARS = 2_500_000
#: New pre-tokens that share the queue: few enough that its lists stay in the processor's cache.
PIECES_AT_ONCE = 2000
#: Pre-tokens of at most so many bytes are merged by whole columns, so many together, in blocks of 2**SHORT_BITS ranks.
SHORT_BYTES, SHORT_AT_ONCE, SHORT_BITS = 64, 25_000, 10
#: White space as Unicode has it, spelled out: the standard library's \\s differs from the pattern's.
SPACES = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Of a byte of UTF-8: 1 if it is white space, 2 if longer white space may begin with it, which is one of LONG_SPACES.
SPACE_BYTES = np.zeros(256, np.uint8)
LONG_SPACES = [c.encode() for c in re.findall(f"[{SPACES}]", "".join(map(chr, range(0xD800)))) if c > "\x7f"]
SPACE_BYTES[[c[0] for c in LONG_SPACES]] = 2
SPACE_BYTES[[c for c in range(128) if re.match(f"[{SPACES}]", chr(c))]] = 1
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


class RankQueue:
    """Positions by merge rank: a heap per rank, found through a hierarchical bitmap."""

    def __init__(self, ranks: int):
        self.top = 0  # bit per non-empty block
        self.blocks = [0] * ((ranks >> BLOCK_BITS) + 1)  # bit per non-empty bucket
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, position: int) -> None:
        """A first position in an empty bucket."""
        self.buckets[rank] = [position]
        block = rank >> BLOCK_BITS
        self.blocks[block] |= 1 << (rank & BLOCK_MASK)
        self.top |= 1 << block

    def lowest(self) -> int:
        block = (self.top & -self.top).bit_length() - 1
        bits = self.blocks[block]
        return (block << BLOCK_BITS) + (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        """An emptied bucket leaves the bitmap."""
        del self.buckets[rank]
        block = rank >> BLOCK_BITS
        self.blocks[block] ^= 1 << (rank & BLOCK_MASK)
        if not self.blocks[block]:
            self.top ^= 1 << block


class PairRanks:
    """Merge ranks by the ids of a pair's parts: open addressing, probed by whole columns."""

    def __init__(self, ranks: dict[bytes, int]):
        get, pairs = ranks.get, []
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                a = get(piece[:k])
                if a is not None:
                    b = get(piece[k:])
                    if b is not None:
                        pairs.append((a, b, rank))
        a, b, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.base = max(ranks.values()) + 1
        bits = (2 * len(pairs) + 1).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        keys = a * self.base + b
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] < 0]
            self.keys[at[free]] = keys[free]  # of those that share a slot, the last stays
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = at[todo] + 1 & self.mask
        self.ranks[at] = rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, -1 for those that don't merge."""
        keys = a.astype(np.int64) * self.base + b
        at = self._slot(keys)
        found = self.keys[at]
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            at[todo] = at[todo] + 1 & self.mask
            found = self.keys[at[todo]]
            todo = todo[(found != keys[todo]) & (found >= 0)]
        return self.ranks[at]  # an empty slot has -1


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.vocabulary = {i: piece for piece, i in ranks.items()}
        self.bytes_ = np.array([ranks.get(bytes([c]), -1) for c in range(256)], np.int32)
        self.byte_pairs = np.full(1 << 16, -1, np.int32)  # ranks of the pairs of single bytes
        for piece, i in ranks.items():
            if len(piece) == 2:
                self.byte_pairs[piece[0] << 8 | piece[1]] = i
        #: Parts are known by their ids, so every byte needs one; else all pre-tokens are taken as long ones.
        self.pairs = PairRanks(ranks) if (self.bytes_ >= 0).all() else None
        self.names = pa.array([self.vocabulary.get(i) for i in range(max(ranks.values()) + 1)], pa.large_binary())
        self.units, self.pieces = _Recent(CACHE_UNITS), _Recent(CACHE_PIECES)

    def encode_short(self, pieces: list[bytes]) -> list[bytes]:
        """``encode_pieces`` by whole columns.  A bucket of the queue is a block of
        ranks.  Of each pre-token with entries in the lowest block, the lowest
        rank, leftmost, is merged: no other of its entries is lower, as all lower
        blocks are empty.  A pre-token makes one merge at a time, hence short ones only."""
        data = b"".join(pieces)
        n = len(data)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        of = np.append(np.repeat(np.arange(len(pieces)), sizes), -1)  # pre-token of each byte
        token = np.append(self.bytes_[np.frombuffer(data, np.uint8)], 0)  # id of the part that starts here
        end = np.arange(1, n + 2)  # part i is data[i:end[i]]
        before = np.arange(-1, n)  # start of the part before, maybe another pre-token's; -1 wraps to the end, which is none's
        parts = np.ones(n, bool)
        pair = np.full(n + 1, -1, np.int64)  # rank of the pair that starts here, -1 if none
        raw = token[:-1]
        pair[:-2] = np.where(of[:-2] == of[1:-1], self.pairs.find(raw[:-1], raw[1:]), -1)
        buckets: dict[int, list[np.ndarray]] = {}
        top = 0  # bit per non-empty bucket
        fresh = np.flatnonzero(pair >= 0)
        while True:
            if len(fresh):
                blocks = (pair[fresh] >> SHORT_BITS).astype(np.uint16)
                order = np.argsort(blocks, kind="stable")
                fresh, blocks = fresh[order], blocks[order]
                cuts = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
                cuts = [0, *cuts.tolist(), len(fresh)]
                for block, x, y in zip(blocks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
                    if top >> block & 1:
                        buckets[block].append(fresh[x:y])
                    else:
                        buckets[block] = [fresh[x:y]]
                        top |= 1 << block
            if not top:
                break
            block = (top & -top).bit_length() - 1
            i = np.concatenate(buckets[block])
            i = i[pair[i] >> SHORT_BITS == block]  # the others are stale
            key = np.sort(((of[i] << SHORT_BITS) + (pair[i] & (1 << SHORT_BITS) - 1)) * (n + 1) + i)
            i = key % (n + 1)
            whose = of[i]
            lowest = np.append(True, whose[1:] != whose[:-1])[:len(i)]
            rest = i[~lowest & np.append(True, key[1:] != key[:-1])[:len(i)]]
            if len(rest):
                buckets[block] = [rest]
            else:
                del buckets[block]
                top ^= 1 << block
            i = i[lowest]
            right = end[i]
            stop = end[right]
            token[i] = pair[i]
            end[i], before[stop] = stop, i
            pair[right], parts[right] = -1, False
            left = before[i]
            i = np.concatenate([i, left[of[left] == of[i]]])
            stop = end[i]
            pair[i] = r = np.where(of[i] == of[stop], self.pairs.find(token[i], token[stop]), -1)
            fresh = i[r >= 0]
        ids = token[:-1][parts].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(of[:-1][parts], minlength=len(pieces)))).tolist()
        return [ids[x:y] for x, y in zip([0, *stops], stops, strict=False)]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, each as little-endian unsigned 32-bit integers.

        The pre-tokens lie in one linked list of parts and share the queue; no
        pair reaches over a pre-token's end.  Positions of one rank are taken
        from its bucket until it is empty or a merge has made a pair of the
        same or a lower rank, which then is next.
        """
        queue = self.queue
        rank_of, buckets, first = self.ranks.get, queue.buckets, queue.open
        data = b"".join(pieces)
        n = len(data)
        end = list(range(1, n + 1))  # part i is data[i:end[i]]
        before = list(range(-1, n - 1))  # start of the part before, -1 at a pre-token's start
        stops, at = bytearray(n + 1), 0
        for piece in pieces:
            before[at] = -1
            at += len(piece)
            stops[at] = 1
        raw = np.frombuffer(data, np.uint8).astype(np.int32)
        token = self.bytes_[raw].tolist()  # id of the part that starts here
        ranked = np.append(self.byte_pairs[raw[:-1] << 8 | raw[1:]], -1) if n else np.zeros(0, np.int32)
        ranked[np.frombuffer(stops, np.uint8)[1:] == 1] = -1
        pair = ranked.tolist()  # rank of the pair that starts here, -1 if none
        order = np.argsort(ranked, kind="stable")[int((ranked < 0).sum()):]
        cuts = [*np.flatnonzero(np.diff(ranked[order], prepend=-1)).tolist(), len(order)]
        order = order.tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            first(pair[order[a]], order[a])
            buckets[pair[order[a]]] = order[a:b]  # ascending, so a heap
        while queue.top:
            rank = queue.lowest()
            heap, lower = buckets[rank], False
            while heap and not lower:
                i = heappop(heap)
                if pair[i] != rank:
                    continue  # stale
                right = end[i]
                end[i] = stop = end[right]
                token[i] = rank
                pair[right], r = -1, None
                if not stops[stop]:
                    before[stop] = i
                    r = rank_of(data[i:end[stop]])
                    if r is not None:
                        lower = r <= rank
                        bucket = buckets.get(r)
                        if bucket is not None:
                            heappush(bucket, i)
                        else:
                            first(r, i)
                pair[i] = -1 if r is None else r
                left = before[i]
                if left >= 0:
                    r = rank_of(data[left:stop])
                    pair[left] = -1 if r is None else r
                    if r is not None:
                        lower = lower or r <= rank
                        bucket = buckets.get(r)
                        if bucket is not None:
                            heappush(bucket, left)
                        else:
                            first(r, left)
            if not heap:
                queue.close(rank)
        out, i = [], 0
        for piece in pieces:
            ids, stop = [], i + len(piece)
            while i < stop:
                ids.append(token[i])
                i = end[i]
            out.append(array("I", ids).tobytes())
        return out

    def _learn(self, units: list[bytes]) -> list[bytes]:
        """Ids of units that are not in the table, which remembers them."""
        find = self.pattern.findall
        split = [find(str(u, "utf-8", "surrogatepass")) for u in units]
        known, whole = self.pieces, self.ranks
        short, long = [], []
        pieces = list({p for s in split for p in s})
        for piece, ids in zip(pieces, known.found(pieces), strict=True):
            if ids is not None:
                continue
            data = utf8(piece)
            r = whole.get(data)
            if r is not None:
                known[piece] = r.to_bytes(4, "little")
            else:
                (short if len(data) <= SHORT_BYTES and self.pairs else long).append((piece, data))
        for fresh, most, encode in ((short, SHORT_AT_ONCE, self.encode_short), (long, PIECES_AT_ONCE, self.encode_pieces)):
            for at in range(0, len(fresh), most):
                some = fresh[at:at + most]
                known.update(zip((p for p, _ in some), encode([d for _, d in some]), strict=True))
        get, join = known.__getitem__, b"".join
        out = [get(s[0]) if len(s) == 1 else join(map(get, s)) for s in split]
        known.trim(p for p, _ in long)
        self.units.update(zip(units, out, strict=True))
        self.units.trim(units)
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, as ``encode``."""
        for ids, stops in self.encode_column(pa.array(map(utf8, texts), pa.large_binary())):
            yield from slices(ids, stops)

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[memoryview, np.ndarray]]:
        """Ids of the texts, null ones empty, about ``PART_CHARS`` bytes of text at a time: the
        ids of one text after the other, as ``encode``, and where each text's begin and end."""
        texts = texts.cast(pa.large_binary())
        starts, data = bounds(texts.fill_null(b"") if texts.null_count else texts)
        a, rows = 0, len(starts) - 1
        while a < rows:
            b = max(a + 1, min(rows, int(np.searchsorted(starts, starts[a] + PART_CHARS))))
            yield self._encode_part(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
            a = b

    def _encode_part(self, data: np.ndarray, starts: np.ndarray) -> tuple[memoryview, np.ndarray]:
        collects = gc.isenabled()
        gc.disable()  # the tables hold no cycles, and walking them takes long
        try:
            return self._encode_texts(data, starts)
        finally:
            if collects:
                gc.enable()

    def _encode_texts(self, data: np.ndarray, starts: np.ndarray) -> tuple[memoryview, np.ndarray]:
        cuts = unit_starts(data, starts)
        ends = np.append(cuts, len(data))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        texts = coded.dictionary.to_pylist()
        known = self.units.found(texts)
        fresh = [k for k, x in enumerate(known) if x is None]
        if fresh:
            for k, x in zip(fresh, self._learn([texts[k] for k in fresh]), strict=True):
                known[k] = x
        stops, ids = bounds(pa.array(known, pa.large_binary()).take(coded.indices))
        return memoryview(ids), stops[np.searchsorted(cuts, starts)]

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return next(iter(self.encode_all([text])))

    def decode_column(self, ids: memoryview, stops: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of what ``encode_column`` gives, and where each text's begin and end; an unknown id is an error."""
        pieces = self.names.take(pa.array(np.frombuffer(ids, "<u4")))
        if pieces.null_count:
            raise KeyError("an id without a piece")
        ends, data = bounds(pieces)
        return memoryview(data), ends[stops // 4]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, memoryview(ids).cast("I")))


class _Recent(dict):
    """Ids by text.  When it has ``most`` entries, they become the old ones, and
    those looked up again come back: what is frequent stays, and what is
    remembered is bounded by twice ``most`` and the texts of one part."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def missing(self, texts: set[str]) -> set[str]:
        """The texts that are not known; the others are in the table after the call."""
        texts = texts.difference(self)
        old = self.old
        again = texts.intersection(old)
        self.update((t, old[t]) for t in again)
        return texts - again

    def found(self, texts: list[str]) -> list[bytes | None]:
        """The ids of the texts, None of those that are not known; the others are in the table after the call."""
        out, old = list(map(self.get, texts)), self.old
        if old:
            for k in [k for k, ids in enumerate(out) if ids is None]:
                ids = old.get(texts[k])
                if ids is not None:
                    out[k] = self[texts[k]] = ids
        return out

    def trim(self, fresh: Iterable[str]) -> None:
        for text in [t for t in fresh if len(t) > CACHE_CHARS]:
            del self[text]
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()


def bounds(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values begin and the last one ends, and their bytes one after the other."""
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return at - at[0], data[at[0]:at[-1]]


def slices(data: memoryview, stops: np.ndarray) -> Iterator[bytes]:
    stops = stops.tolist()
    return (bytes(data[a:b]) for a, b in zip(stops, stops[1:], strict=False))


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the units of UTF-8 texts begin: with a text, and with each white space after something else."""
    kinds = SPACE_BYTES[data]
    space = kinds == 1
    at = np.flatnonzero(kinds == 2)
    if len(at):
        space = np.append(space, [False, False])
        seen = [data.take(at + k, mode="clip") for k in range(3)]
        for c in LONG_SPACES:
            here = at[np.logical_and.reduce([x == y for x, y in zip(seen, c, strict=False)])]
            for k in range(len(c)):
                space[here + k] = True
        space = space[:-2]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[starts[:-1][starts[:-1] < starts[1:]]] = True
    return np.flatnonzero(begins)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def load_codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, once per worker (two are remembered at most); the
    file is installed with its library on every machine."""
    codecs = remembered("bpe")
    codec = codecs.pop((path, pattern), None)
    if codec is None:
        if len(codecs) > 1:
            del codecs[next(iter(codecs))]
        with open(path, "rb") as f:
            codec = Codec(parse_ranks(f.read()), pattern)
    codecs[path, pattern] = codec  # the last used comes last
    return codec


def digests(data: memoryview, stops: np.ndarray) -> list[str]:
    stops = stops.tolist()
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(stops, stops[1:], strict=False)]


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 and,
    with ``keep_ids``, the ids and the decoded text's bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())]
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        kind += ", ids array<int>"
    schema = pa.schema(fields)

    def run(batches):
        codec = load_codec(path, pattern)
        for b in batches:
            sizes, sha, back, kept = [], [], [], []
            for ids, stops in codec.encode_column(b.column(1)):
                sizes += (np.diff(stops) // 4).tolist()
                sha += digests(ids, stops)
                back += digests(*codec.decode_column(ids, stops))
                if keep_ids:
                    kept.append(ids)
            cols = [b.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if keep_ids:
                flat = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(kept))])
                cols.append(pa.ListArray.from_arrays(pc.cumulative_sum(pa.array([0, *sizes], pa.int32())), flat))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, kind)


def decode(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes) of a table with ids; an unknown id is an error."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        vocabulary = load_codec(path, pattern).vocabulary
        for b in batches:
            out = [b"".join(vocabulary[i] for i in ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, "doc_id long, bytes binary")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), keep_ids=False)
