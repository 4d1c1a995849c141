import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from llm import cases
from pricebasket.llm import bpe as B


@pytest.fixture(scope="module")
def codec():
    return B.load_codec(public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(codec, text):
    return list(memoryview(codec.encode(text)).cast("I"))


def test_random_texts(codec, reference):
    rng = random.Random(1)
    letters = "ab cdeé\n \t'sSll0 1९٣ñ漢字🙂!?.,-_　\xa0\x85\x1c\x0b "
    for _ in range(5000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert ids(codec, t) == reference.encode_ordinary(t)
        assert codec.decode(codec.encode(t)) == t.encode()


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 20_000, " " * 30_000, "漢" * 8000, "\n" * 999 + "x",
                                  "".join(random.Random(2).choice("abcdefgh") for _ in range(40_000)), "<|endoftext|> a"])
def test_long_pre_tokens(codec, reference, text):
    assert ids(codec, text) == reference.encode_ordinary(text)


def test_caches_are_bounded(reference, monkeypatch):
    monkeypatch.setattr(B, "CACHE_UNITS", 50)
    monkeypatch.setattr(B, "CACHE_PIECES", 40)
    monkeypatch.setattr(B, "PART_CHARS", 200)
    small = B.Codec(reference._mergeable_ranks, public_tokenizers.PATTERN)
    texts = [cases.prose(random.Random(i), "fr", 60) + "x" * 100 for i in range(50)]
    assert [list(memoryview(x).cast("I")) for x in small.encode_all(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert len(small.units) + len(small.units.old) < 400 and max(map(len, [*small.units, *small.units.old])) <= B.CACHE_CHARS


def test_tied_ranks_go_left_first(codec):
    """Two pairs of one rank: 'ab'+'c' and 'a'+'bc' make the same token."""
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")} | {b"ab": 3, b"bc": 4, b"abc": 5, b"abcabc": 6, b"cab": 7}
    small = B.Codec(ranks, public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("tiny", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for _ in range(500):
        t = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        assert ids(small, t) == enc.encode_ordinary(t)


def test_short_pre_tokens_are_merged_by_columns(codec, reference, monkeypatch):
    """No merge of theirs is taken from a heap one at a time."""
    def one_at_a_time(*_):
        raise AssertionError("a short pre-token's merge was popped")

    monkeypatch.setattr(B, "heappop", one_at_a_time)
    rng = random.Random(4)
    small = B.Codec(codec.ranks, public_tokenizers.PATTERN)
    t = " ".join("".join(rng.choice("abcdefghé漢") for _ in range(rng.randint(1, 20))) for _ in range(3000))
    assert ids(small, t) == reference.encode_ordinary(t)


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_columns_merge_as_the_queue(bits, monkeypatch):
    """A vocabulary with ties and with merges that lower the next rank, blocks of few ranks."""
    monkeypatch.setattr(B, "SHORT_BITS", bits)
    rng = random.Random(bits)
    for _ in range(10):
        more = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 6))).encode() for _ in range(60)}
        ranks = {p: i for i, p in enumerate([*(bytes([c]) for c in range(256)), *rng.sample(sorted(more), len(more))])}
        small = B.Codec(ranks, public_tokenizers.PATTERN)
        pieces = ["".join(rng.choice("abc" if rng.random() < 0.95 else "dé") for _ in range(rng.randint(1, 30))).encode() for _ in range(300)]
        pieces = [p for p in pieces if p not in ranks]  # those are tokens as they stand
        got = small.encode_short(pieces)
        assert got == small.encode_pieces(pieces)
        enc = tiktoken.Encoding("tiny", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        assert [list(memoryview(x).cast("I")) for x in got] == [enc.encode_ordinary(p.decode()) for p in pieces]


def test_units_of_bytes():
    """Texts are cut where Python's white space, spelled out, begins."""
    unit = re.compile(f"[{B.SPACES}]*[^{B.SPACES}]+|[{B.SPACES}]+")
    letters = "ab cé漢🙂\n\t\x85\xa0\u1680\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\x1c"
    rng = random.Random(5)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *(len(t.encode()) for t in texts)])
    cuts = B.unit_starts(data, starts).tolist()
    assert [bytes(data[a:b]).decode() for a, b in zip(cuts, [*cuts[1:], len(data)])] == [u for t in texts for u in unit.findall(t)]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_columns_with_nulls_and_offsets(codec, reference, monkeypatch, kind):
    monkeypatch.setattr(B, "PART_CHARS", 40)
    texts = [None, "", "x y", *(cases.prose(random.Random(i), "fr", 9) for i in range(9)), "", None, " \u3000", "a" * 200]
    for a, b in ((0, len(texts)), (1, len(texts) - 1), (3, 7), (0, 2), (5, 5)):
        got, back = [], []
        for x, stops in codec.encode_column(pa.array(texts, kind).slice(a, b - a)):
            got += B.slices(x, stops)
            back += B.slices(*codec.decode_column(x, stops))
        assert [list(memoryview(x).cast("I")) for x in got] == [reference.encode_ordinary(t or "") for t in texts[a:b]]
        assert back == [(t or "").encode() for t in texts[a:b]]


def test_unknown_ids_are_not_decoded():
    small = B.Codec({b"a": 0, b"b": 1, b"ab": 3}, public_tokenizers.PATTERN)
    with pytest.raises(KeyError):
        small.decode_column(memoryview(struct.pack("<2I", 0, 2)), np.array([0, 8]))


def test_table(spark, reference):
    docs = cases.clashing(cases.docs(spark))
    out = B.encode(docs)
    want = sorted((-1 if i is None else i, hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), len(x),
                   hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t, *_ in cases.rows() for x in [reference.encode_ordinary(t or "")])
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids_sha256"], r["n_tokens"], r["decoded_sha256"]) for r in out.collect())
    assert got == want
    back = {r["doc_id"]: bytes(r["bytes"]) for r in B.decode(out).collect()}
    assert back == {i: (t or "").encode() for i, t, *_ in cases.rows()}
    assert B.encode(cases.docs(spark, [])).collect() == []
