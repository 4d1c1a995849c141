"""Cross-tokenizer alignment by products of sparse token-byte matrices.

A text's tokens under tokenizer A are the rows of a 0/1 matrix whose columns are
the bytes of the text, and so are those under B.  ``A * B transposed`` has an
entry for every two tokens that overlap, the number of bytes they share: the
links.  Byte offsets where tokens of both end cut the tokens into groups; with
the tokens' group incidence, ``GA * GB transposed`` has an entry for every two
tokens of one group.  Both products are Gustavson row products over matrices in
compressed rows (``csr.py``).  A unit, a word with the white space before it (several, where
that isn't blanks), ends a token of both wherever it stands, so the products are
block-diagonal by units: they are taken once for the distinct units of many
texts, which lie one after the other on the byte axis, and a text's figures are
the sums over its units.  Where B has pieces that reach over such an end, a text
is one unit.

Corpus-wide counts: a task packs its documents in chunks of bounded size and
hands on each chunk's distinct pairs of ids with their counts, so a pair that is
in every text is one row a chunk.  The summed counts come back to the chunks
that hold the pair.  A chunk keeps the matrices of documents and units and of
units and pairs, whose products with the counts give each document's sums: no
text is encoded twice, and no text or token moves.

Defined results: a NULL or empty text, and one whose joined tokens of A or B
aren't the bytes of blank + text (B normalises some characters), has no
tokens, links or groups; repeated rows count and are returned each for itself;
any doc_id, NULL too, passes through; a longer text than a chunk is a chunk of
its own, whose products are taken in parts.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.bpe import _Recent, bounds, unit_starts
from pricebasket.llm.common import table, utf8, written
from pricebasket.llm.csr import Csr, members, product_sizes, row_products, spans

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text of a chunk, about, and terms of a product that are summed at once.
CHUNK_BYTES, TERMS = 4_000_000, 1_000_000
#: Text given to the tokenizers at once, and in one string, in bytes, about.
BATCH_BYTES, JOINED_BYTES = 250_000, 4000
#: Bytes whose units are looked for at once.
WINDOW_BYTES = 1_000_000
#: Half of the units whose ids a worker remembers, about (some 200 bytes each).
CACHE_UNITS = 150_000
#: Units of a text that are held as text at once.
UNITS_AT_ONCE = 200_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters for themselves, the other bytes, in order, from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """One tokenizer: the bytes of every id."""

    def __init__(self, pieces: list[bytes]):
        self.bytes = pieces
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.column = pa.array(pieces, pa.large_binary())

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of ids begin and the last one ends, and their bytes one after the other."""
        return bounds(self.column.take(pa.array(ids)))

    def names(self, marks: str) -> list[str]:
        """Ids as text with a mark after them, all ids for each mark."""
        return [f"{i}{mark}" for mark in marks for i in range(len(self.bytes))]


class ByteLevel(Tokens):
    """Byte-level BPE of the ``tokenizers`` library, of blank + text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as f:
            special = {t["id"] for t in json.load(f)["added_tokens"]}
        pieces = [b""] * self.model.get_vocab_size()
        for piece, i in self.model.get_vocab().items():
            pieces[i] = piece.encode() if i in special else bytes(map(alphabet.__getitem__, piece))
        super().__init__(pieces)

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit: no pre-token reaches over its ends."""
        return [e.ids for e in self.model.encode_batch_fast(units, add_special_tokens=False)]


class Pieces(Tokens):
    """BPE with byte fallback of the ``sentencepiece`` library, which adds the blank itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        super().__init__([bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.blank = m.piece_to_id("▁")
        self.by_units = self._keeps_text(m.serialized_model_proto()) and not any(
            "▁" in p.lstrip("▁") for p in pieces)

    @staticmethod
    def _keeps_text(proto: bytes) -> bool:
        """Whether the model is a BPE of the text as it stands, blanks as U+2581, one put before it."""
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        p = ModelProto.FromString(proto)
        n, t = p.normalizer_spec, p.trainer_spec
        return (t.model_type == t.BPE and t.byte_fallback and not t.treat_whitespace_as_suffix and n.add_dummy_prefix
                and n.escape_whitespaces and not n.remove_extra_whitespaces and not n.precompiled_charsmap
                and not any(x.type == x.USER_DEFINED for x in p.pieces))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit, whose first blank is the one that the library adds (to no empty text)."""
        return [x or [self.blank] for x in self.encode([u[1:] for u in units])]


def unit_cuts(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the units of texts in UTF-8, each with a blank before it, begin: from a
    blank that stands after a letter to the next such neither tokenizer merges."""
    data, found = np.frombuffer(data, np.uint8), []
    for x in range(0, len(data), WINDOW_BYTES):
        first = max(0, x - 3)  # the longest white space before a window
        own = starts[np.searchsorted(starts, first):np.searchsorted(starts, x + WINDOW_BYTES)]
        at = unit_starts(data[first:x + WINDOW_BYTES], np.append(own, min(len(data), x + WINDOW_BYTES)) - first) + first
        at = at[at >= x]
        found.append(at[data[at] == 0x20])
    return np.concatenate([np.zeros(0, np.int64), *found])


@dataclass
class Ids:
    """Ids of units under A and B, one unit's after the other's, and how many each
    unit has: none under both for a unit that has no tokens."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    @staticmethod
    def packed(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[bytes]:
        """Each unit's number of ids under A, these, and those under B, as unsigned 32-bit integers."""
        kinds = _kinds(n_a, n_b)
        words = np.empty(len(kinds), np.uint32)
        words[kinds == 0], words[kinds == 1], words[kinds == 2] = n_a, a, b
        data, ends = words.tobytes(), (4 * np.cumsum(1 + n_a + n_b)).tolist()
        return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    @classmethod
    def unpacked(cls, units: list[bytes]) -> Ids:
        starts, data = bounds(pa.array(units, pa.large_binary()))
        starts, words = starts // 4, data.view(np.uint32)
        n_a = words[starts[:-1]].astype(np.int64)
        n_b = np.diff(starts) - 1 - n_a
        kinds = _kinds(n_a, n_b)
        return cls(words[kinds == 1].astype(np.int64), words[kinds == 2].astype(np.int64), n_a, n_b)

    def only(self, kept: np.ndarray) -> Ids:
        """The others have no tokens."""
        return Ids(self.a[np.repeat(kept, self.n_a)], self.b[np.repeat(kept, self.n_b)], self.n_a * kept, self.n_b * kept)


def _kinds(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Of every integer of packed units 0 if it is the number, 1 an id under A, 2 under B."""
    return np.repeat(np.tile(np.arange(3, dtype=np.int8), len(n_a)), np.column_stack([np.ones_like(n_a), n_a, n_b]).ravel())


class Units:
    """Ids of units, in UTF-8, under both tokenizers; those met before are looked up."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.names = pa.array(a.names(",|") + b.names(",;"), pa.large_string())
        self.met = _Recent(CACHE_UNITS)

    def coded(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct units of texts, each with a blank before it or empty, the
        number of each unit of one text after the other, and how many each text has."""
        data, starts = b"".join(texts), _starts(np.fromiter(map(len, texts), np.int64, len(texts)))
        cuts = unit_cuts(data, starts[:-1]) if self.b.by_units else np.unique(starts[:-1][np.diff(starts) > 0])
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(data)]).dictionary_encode()
        return units.dictionary.to_pylist(), units.indices.to_numpy(), np.diff(np.searchsorted(cuts, starts))

    def cut(self, text: str | None) -> Iterator[list[bytes]]:
        """The units of blank + text, ``UNITS_AT_ONCE`` at a time."""
        units, codes, _ = self.coded([utf8(text and " " + text)])
        for i in range(0, len(codes), UNITS_AT_ONCE):
            yield list(map(units.__getitem__, codes[i:i + UNITS_AT_ONCE].tolist()))

    def _try(self, units: list[bytes], firsts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Packed ids of units given to the tokenizers in blocks, the units from each of
        ``firsts`` to the next as one text, and whether its block spells them out."""
        data, ends = b"".join(units), np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        lasts = np.append(firsts[1:], len(units)) - 1
        sizes = lasts - firsts + 1
        stops = _starts(ends[lasts] - np.append(0, ends[lasts[:-1]])).tolist()
        texts = [str(data[i:j], "utf-8") for i, j in zip(stops, stops[1:], strict=False)]
        good, columns = np.ones(len(firsts), bool), []
        for vocab in (self.a, self.b):
            ids = vocab.encode_units(texts)
            cuts = _starts(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(cuts[-1]))
            at, spelled = vocab.spell(flat)
            got, spelled = at[cuts].tolist(), spelled.tobytes()
            if spelled != data or got != stops:
                good &= [spelled[i:j] == data[x:y] for i, j, x, y in zip(got, got[1:], stops, stops[1:], strict=False)]
            # a block spells its units if a token ends where each of them does
            want = ends + np.repeat(np.subtract(got[:-1], stops[:-1]), sizes)
            last = np.searchsorted(at[1:], want)
            last[lasts] = cuts[1:] - 1
            good &= np.logical_and.reduceat(at[np.minimum(last + 1, len(flat))] == want, firsts)
            columns.append((flat, cuts, last + 1))
        whole = np.repeat(good, sizes)
        numbers = []
        for flat, cuts, last in columns:
            n = np.diff(last, prepend=0) * whole
            n[firsts] = (last[firsts] - cuts[:-1]) * good
            numbers.append((flat[np.repeat(good, np.diff(cuts))], n))
        (a, n_a), (b, n_b) = numbers
        return Ids.packed(a, b, n_a, n_b), whole

    def _encode(self, units: list[bytes]) -> list[bytes]:
        """Packed ids of each unit, none if they don't spell it out.  Many units are one
        text to the tokenizers, which is faster; where white space ends a unit, more of it
        would follow, so it is a text of its own, as are the units of a text not spelled out."""
        out, alone = [b""] * len(units), np.ones(len(units), bool)
        if self.b.by_units:
            ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
            alone[:] = False
            alone[:-1] = ~np.isin(ends[:-1], unit_cuts(b"".join(units), np.zeros(1, np.int64)), assume_unique=True)
            joined = np.flatnonzero(~alone)
            some = [units[k] for k in joined.tolist()]
            firsts = np.array([i for i, _ in _batches(some, JOINED_BYTES)])
            if len(firsts):
                found, whole = self._try(some, firsts)
                for k, x in zip(joined.tolist(), found, strict=True):
                    out[k] = x
                alone[joined[~whole]] = True
        rest = np.flatnonzero(alone).tolist()
        if rest:
            for k, x in zip(rest, self._try([units[k] for k in rest], np.arange(len(rest)))[0], strict=True):
                out[k] = x
        return out

    def ids(self, units: list[bytes]) -> Ids:
        """Ids of each unit under A and B, none if they don't spell it out."""
        found = self.met.found(units)
        missing = [k for k, x in enumerate(found) if x is None]
        fresh = list(dict.fromkeys(units[k] for k in missing))
        for first, last in _batches(fresh):
            self.met.update(zip(fresh[first:last], self._encode(fresh[first:last]), strict=True))
        for k in missing:
            found[k] = self.met[units[k]]
        self.met.trim(fresh)
        return Ids.unpacked(found)

    def of_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text under both, none where they don't spell it out."""
        found = self.ids(list(chain.from_iterable(self.cut(text))))
        none = np.zeros(0, np.int64)
        return (found.a, found.b) if found.n_a.all() else (none, none)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32).astype(np.int64)


@lru_cache(maxsize=4)
def _vocabularies(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """Once a worker."""
    return ByteLevel(path_a), Pieces(path_b)


@lru_cache(maxsize=4)
def _units(path_a: str, path_b: str) -> Units:
    """Once a worker."""
    return Units(*_vocabularies(path_a, path_b))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


class Aligned:
    """Texts of two tokenizations on one byte axis, in order."""

    def __init__(self, a: np.ndarray, b: np.ndarray, vocab_a: Tokens, vocab_b: Tokens):
        self.a, self.b = a, b
        self.ends_a, self.ends_b = np.cumsum(vocab_a.lengths[a]), np.cumsum(vocab_b.lengths[b])

    def links(self, terms: int = TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, bytes they share), by token of A."""
        return row_products(spans(self.ends_a), spans(self.ends_b).transpose(), terms)

    def groups(self) -> tuple[np.ndarray, np.ndarray, Csr, Csr]:
        """Group of each token of A and of B, and their incidence matrices: a group ends at
        a byte where tokens of both end."""
        cut = np.zeros(int(max(self.ends_a[-1:].sum(), self.ends_b[-1:].sum())) + 1, np.int8)
        cut[self.ends_a] = 1
        cut[self.ends_b] += 1
        cut = cut == 2
        before = np.cumsum(cut)
        of_a, of_b = (before[ends] - cut[ends] for ends in (self.ends_a, self.ends_b))
        return of_a, of_b, members(of_a, int(before[-1])), members(of_b, int(before[-1]))

    def group_links(self, terms: int = TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, 1) of every two in one group."""
        _, _, in_a, in_b = self.groups()
        return row_products(in_a, in_b.transpose(), terms)


def _batches(texts: list[str] | list[bytes], most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` bytes of text, ``BATCH_BYTES`` if not given; a longer text is alone."""
    most, first, size = most or BATCH_BYTES, 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def _spelled(tokens: Aligned, groups: tuple[np.ndarray, np.ndarray, Csr, Csr], n_a: np.ndarray, names: pa.Array,
             size: int) -> tuple[np.ndarray, list[str]]:
    """Per unit the number of groups and their spelling, with a mark after each;
    ``size`` is that of vocabulary A."""
    of_a, of_b, in_a, in_b = groups
    last_a, last_b = (np.diff(g, append=-1) != 0 for g in (of_a, of_b))
    size_a, size_b = (np.bincount(g, minlength=m.n_cols) for g, m in ((of_a, in_a), (of_b, in_b)))
    # a group's A tokens stand before its B tokens, after the groups before it
    name = np.empty(len(of_a) + len(of_b), np.int32)
    name[np.arange(len(of_a)) + (np.cumsum(size_b) - size_b)[of_a]] = tokens.a + size * last_a
    name[np.arange(len(of_b)) + np.cumsum(size_a)[of_b]] = 2 * size + tokens.b + (len(names) // 2 - size) * last_b
    starts, data = bounds(names.take(pa.array(name)))
    ends = np.concatenate([[0], np.cumsum(n_a)])
    groups = np.concatenate([[0], np.cumsum(last_a)])[ends]  # groups up to each unit's end
    places = starts[np.concatenate([[0], np.cumsum(size_a + size_b)])[groups]]
    words = pa.LargeStringArray.from_buffers(len(n_a), pa.py_buffer(places), pa.py_buffer(data))
    return np.diff(groups), words.to_pylist()


def _digest(spelled: list[str], codes: np.ndarray) -> str:
    """The digest of a text's groups, without the mark after the last; '' of none."""
    if not len(codes):
        return ""
    sha = hashlib.sha256()
    for i in range(0, len(codes), UNITS_AT_ONCE):
        words = "".join(map(spelled.__getitem__, codes[i:i + UNITS_AT_ONCE].tolist()))
        sha.update((words if i + UNITS_AT_ONCE < len(codes) else words[:-1]).encode())
    return sha.hexdigest()


class Part:
    """Units' own figures, and the matrix of units and pairs of ids: row ``u``
    has the pairs ``pair[ptr[u]:ptr[u + 1]]`` of ``keys``, ``n`` links each."""

    def __init__(self, ids: Ids, vocab_a: Tokens, vocab_b: Tokens, names: pa.Array | None = None):
        if names is None:
            names = pa.array(vocab_a.names(",|") + vocab_b.names(",;"), pa.large_string())
        self.n_a, self.n_b = ids.n_a, ids.n_b
        tokens = Aligned(ids.a, ids.b, vocab_a, vocab_b)
        unit_of = np.repeat(np.arange(len(ids.n_a)), self.n_a)
        cells = []
        for i, j, _ in tokens.links():  # in parts of bounded size, each counted by unit and pair at once
            pairs = pa.array(tokens.a[i] << 32 | tokens.b[j]).dictionary_encode()
            own = pairs.dictionary.to_numpy()
            order = np.argsort(own)
            at = np.empty(len(own), np.int64)
            at[order] = np.arange(len(own))
            cell = unit_of[i] * len(own) + at[pairs.indices.to_numpy()]
            cell.sort()
            new = np.flatnonzero(np.diff(cell, prepend=-1))
            cells.append((own[order], cell[new], np.diff(np.append(new, len(cell)))))
        self.keys = keys = np.unique(np.concatenate([np.zeros(0, np.int64), *(own for own, _, _ in cells)]))
        most = max(1, len(keys))
        cell = np.concatenate([np.zeros(0, np.int64), *(
            cell // len(own) * most + np.searchsorted(keys, own)[cell % len(own)] for own, cell, _ in cells)])
        n = np.concatenate([np.zeros(0, np.int64), *(n for _, _, n in cells)])
        if len(cells) > 1:  # a unit whose links lie in two parts has some pairs in both
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            new = np.flatnonzero(np.diff(cell, prepend=-1))
            cell, n = cell[new], np.add.reduceat(n[order], new)
        self.n, self.pair = n, cell % most
        self.ptr = _starts(np.bincount(cell // most, minlength=len(ids.n_a)))
        self.n_links = sums_of_rows(self.ptr, self.n)
        groups = tokens.groups()
        self.n_group_links = sums_of_rows(_starts(self.n_a), product_sizes(groups[2], groups[3].transpose()))
        self.n_groups, self.spelled = _spelled(tokens, groups, self.n_a, names, len(vocab_a.bytes))


def sums_of_rows(ptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ptr[1:]] - total[ptr[:-1]]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _packed(numbers: np.ndarray) -> bytes:
    """Their number and themselves, as unsigned 32-bit integers, compressed."""
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    return _numbers(pa.decompress(data[8:], int.from_bytes(data[:8], "little") * 4, codec="zstd", asbytes=True))


OWN = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
#: The matrix of documents and units, and that of units and pairs: sizes of the rows, columns, and the latter's values.
MATRICES = ["sizes", "codes", "unit_sizes", "pairs", "times"]
CHUNK = ("chunk string, doc_ids array<long>, " + ", ".join(f"{c} array<long>" for c in OWN)
         + ", digests array<string>, " + ", ".join(f"{c} binary" for c in MATRICES) + ", keys array<long>, counts array<long>")
_LONGS = pa.list_(pa.int64())
CHUNK_SCHEMA = pa.schema([("chunk", pa.string()), ("doc_ids", _LONGS), *((c, _LONGS) for c in OWN), ("digests", pa.list_(pa.string())),
                          *((c, pa.binary()) for c in MATRICES), ("keys", _LONGS), ("counts", _LONGS)])


class Chunk:
    """Documents as numbers of their units."""

    def __init__(self, units: Units):
        self.units, self.doc_ids, self.texts, self.bytes = units, [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.doc_ids.append(doc_id)
        self.texts.append(utf8(text and " " + text))
        self.bytes += len(text or "")

    def row(self) -> pa.RecordBatch:
        units, codes, sizes = self.units.coded(self.texts)
        self.texts = []
        ids = self.units.ids(units)
        del units
        # a text that has a unit without tokens has none
        none = ids.n_a == 0
        whole = sums_of_rows(_starts(sizes), none[codes]) == 0
        codes, sizes = codes[np.repeat(whole, sizes)], sizes * whole
        met = np.bincount(codes, minlength=len(none))
        part = Part(ids if met.all() else ids.only(met > 0), self.units.a, self.units.b, self.units.names)
        ptr, unit_sizes = _starts(sizes), np.diff(part.ptr)
        own = [sums_of_rows(ptr, getattr(part, c)[codes]) for c in OWN]
        digests = [_digest(part.spelled, codes[i:j]) for i, j in zip(ptr.tolist(), ptr[1:].tolist(), strict=False)]
        counts = np.bincount(part.pair, part.n * np.repeat(met, unit_sizes), len(part.keys)).astype(np.int64)
        cells = [uuid.uuid4().hex, self.doc_ids, *own, digests, *map(_packed, (sizes, codes, unit_sizes, part.pair, part.n)), part.keys, counts]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, CHUNK_SCHEMA, strict=True)], schema=CHUNK_SCHEMA)


def chunks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row a chunk of documents: each one's own figures, the chunk's distinct
    pairs of ids with their counts, and its matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(_units(path_a, path_b))
        gc.freeze()  # the vocabularies; what a chunk makes holds no cycles, and walking it takes long
        gc.disable()
        try:
            for batch in batches:
                for doc, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    chunk.add(doc, text)
                    if chunk.bytes >= chunk_bytes:
                        yield chunk.row()
                        chunk = Chunk(chunk.units)
            if chunk.doc_ids:
                yield chunk.row()
        finally:
            gc.enable()

    return docs.select(id_col, text_col).mapInArrow(run, CHUNK)


def pair_counts(packed: DataFrame) -> DataFrame:
    """(key, count, best): corpus-wide links of each pair of ids, and whether no
    other A id has more with its B id."""
    pairs = packed.select(F.explode(F.arrays_zip("keys", "counts")).alias("p")).select("p.*")
    counts = written(pairs.groupBy(F.col("keys").alias("key")).agg(F.sum("counts").alias("count")), "align-counts")
    b = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("key", "count", (F.col("count") == F.col("most")).alias("best"))


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def summaries(packed: DataFrame, counts: DataFrame) -> DataFrame:
    """The contract's row of every document: its own figures, and the products of
    the chunk's matrices with the counts of the pairs."""
    own = packed.select("chunk", F.explode("keys").alias("key")).join(counts, "key").toDF("key", "of_chunk", "count", "best")

    def run(chunk: pa.Table, found: pa.Table) -> pa.Table:
        cell = {c: chunk.column(c)[0].as_py() for c in ("digests", "doc_ids")}
        sizes, codes, unit_sizes, pair, times = (_unpacked(chunk.column(c)[0].as_py()) for c in MATRICES)
        order = np.argsort(found.column("key").to_numpy())
        count, best = (found.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))

        def sums(of_pair: np.ndarray) -> np.ndarray:
            of_unit = sums_of_rows(_starts(unit_sizes), times * of_pair[pair])
            return sums_of_rows(_starts(sizes), of_unit[codes])

        columns = {"doc_id": pa.array(cell["doc_ids"], pa.int64()), **{c: pa.array(chunk.column(c)[0].as_py(), pa.int64()) for c in OWN},
                   "n_best": pa.array(sums(best)),
                   "count_sum": pa.array(sums(count)),
                   "groups_sha256": pa.array(cell["digests"], pa.string())}
        return pa.table([columns[c.split()[0]] for c in RESULT.split(", ")], names=[c.split()[0] for c in RESULT.split(", ")])

    of_chunk = packed.drop("keys", "counts")
    return of_chunk.groupBy("chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(run, RESULT)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document with its alignment: token ids under both, ``links`` (token
    of A, token of B, bytes shared) and ``group_links`` (token of A, token of B),
    tokens by their number in the text, and each token's group."""
    pair = "array<struct<a: long, b: long{}>>"
    out = (f"doc_id long, a array<long>, b array<long>, links {pair.format(', bytes: long')}, "
           f"group_links {pair.format('')}, group_a array<long>, group_b array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(path_a, path_b)
        for batch in batches:
            for doc, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = units.of_text(text)
                t = Aligned(a, b, units.a, units.b)
                links = [dict(zip(("a", "b", "bytes"), x, strict=True)) for p in t.links() for x in zip(*map(np.ndarray.tolist, p), strict=True)]
                shared = [{"a": x, "b": y} for i, j, _ in t.group_links() for x, y in zip(i.tolist(), j.tolist(), strict=True)]
                of_a, of_b, _, _ = t.groups()
                yield pa.RecordBatch.from_pylist([{"doc_id": doc, "a": a.tolist(), "b": b.tolist(), "links": links, "group_links": shared,
                                                   "group_a": of_a.tolist(), "group_b": of_b.tolist()}], schema=arrow)

    ab = [("a", pa.int64()), ("b", pa.int64())]
    arrow = pa.schema([("doc_id", pa.int64()), ("a", _LONGS), ("b", _LONGS), ("links", pa.list_(pa.struct([*ab, ("bytes", pa.int64())]))),
                       ("group_links", pa.list_(pa.struct(ab))), ("group_a", _LONGS), ("group_b", _LONGS)])
    return docs.select(id_col, text_col).mapInArrow(run, out)


def aligned_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document its numbers of tokens, groups and links, how many links are
    the best of their B id, the sum of their counts, and a digest of the groups."""
    if path_a is None or path_b is None:
        path_a, path_b = default_paths()
    packed = written(chunks(docs, path_a, path_b, id_col, text_col, chunk_bytes), "align-chunks")
    return summaries(packed, written(pair_counts(packed), "align-pairs"))


def op13_token_align(spark, sf_dir: str) -> DataFrame:
    return aligned_counts(table(spark, sf_dir, "documents"))
