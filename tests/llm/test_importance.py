import hashlib
import math
import random
import re
import zlib

import pytest

from llm import cases
from pricebasket.llm import importance as M


def brute_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(data, target, percent=5, min_words=20):
    """Multiset of (doc_id, n_features, weight, score, rank) by plain sorting."""
    s, t = [0] * 10000, [0] * 10000
    found = [brute_features(r[1]) for r in data]
    for _, f in found:
        for b in f:
            s[b] += 1
    for text in target:
        for b in brute_features(text)[1]:
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    out = []
    for r, (n_words, f) in zip(data, found, strict=True):
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in f)
        h = int(hashlib.sha256(f"42:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    enough = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for i, x in enumerate(enough[:percent * len(enough) // 100]):
        x[4] = i + 1
    return out


def as_set(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


TARGET = ["the story of the water and the house", "reading with other THOUGHT", None, ""]


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_matches_brute_force(spark, percent):
    data = cases.rows(120, 5)
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    # blocks of 16 places: many blocks and several passes
    got = M.resample(cases.clashing(cases.docs(spark, data)), target, percent, block=16)
    want = [x[:5] for x in brute(data, TARGET, percent)]
    assert as_set(got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == as_set(want)


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    got = M.op12_importance(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert as_set(got.collect()) == as_set(x[:5] for x in brute(data, target))


def test_radix_sort_of_ties_negatives_and_the_whole_range(spark):
    rng = random.Random(4)
    rows = [(rng.choice([-3, 0, 7, 2**63 - 1, -2**63, rng.getrandbits(40) - 2**39]), rng.randint(0, 4), i) for i in range(400)]
    rows += [(5, 5, i) for i in range(400, 600)]  # one hot key
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(7)
    got = M.radix_ranks(df, ["i", "b", "a"], block=64).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(600))
    assert [(r["a"], r["b"], r["i"]) for r in got] == sorted(rows)


def test_radix_sort_where_no_key_differs(spark):
    df = spark.createDataFrame([(1,)] * 50, "a long").repartition(5)
    assert sorted(r["place"] for r in M.radix_ranks(df, ["a"], block=8).collect()) == list(range(50))


def test_empty_tables(spark):
    none, target = cases.docs(spark, []), spark.createDataFrame([("a b",)], "text string")
    assert M.resample(none, target).collect() == []
    got = M.resample(cases.docs(spark), target.limit(0)).collect()
    assert as_set([r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]] for r in got) == as_set(
        x[:5] for x in brute(cases.rows(), []))


def test_long_texts_are_hashed_in_parts(monkeypatch):
    words = M.words_of(cases.rows()[3][1])
    whole = sorted(x for p in M.buckets(words) for x in p.tolist())
    monkeypatch.setattr(M, "PART_WORDS", 7)
    assert sorted(x for p in M.buckets(words) for x in p.tolist()) == whole
