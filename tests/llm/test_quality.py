import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import cases
from pricebasket.llm import quality as Q

LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c, hit, seen, dups = Counter(zip(w, w[1:], w[2:], strict=False)), set(), set(), 0
    for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if c[g] > 1:
            hit |= {k, k + 1, k + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit)


def test_base_counts(spark):
    data = [*cases.rows(), (1000, "a a a a", "en", "s", 1), (1001, "a b a b a\n\n a b\na b\n a b", "en", "s", 1), (1002, "#*$%&|<>\n#\n#", "en", "s", 1)]
    out = Q.score(cases.clashing(cases.docs(spark, data)), np.zeros(Q.BUCKETS)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[c] for c in names) for r in out) == sorted(brute_counts(r[1]) for r in data)
    assert {r["score"] for r in out} == {0.0}


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = cases.prose(rng, rng.choice(["en", "fr"]), rng.randint(60, 150))
        junk = i % 5 == 0
        if junk:
            text = " ".join(w + rng.choice(["%%%", "###"]) for w in text.split())
        docs.append((i, text, "en", "s", 1))
        if i % 2:
            labels.append((i, int(not junk), 0))
    return docs, labels


def brute_ratio(docs, labels):
    raw, target = np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS)
    import zlib
    good = {i for i, q, _ in labels if q == 1 and i is not None and zlib.crc32(str(i).encode()) % Q.HELD}
    for i, text, *_ in docs:
        words = (text or "").encode().split()
        if words:
            for b in Q.buckets(Q.word_hashes(words)):
                raw[b] += 1
                target[b] += i in good
    share = target.sum() / raw.sum()
    p, q = target + Q.PRIOR * share, raw + Q.PRIOR
    return np.log(p / p.sum() / (q / q.sum())) if target.sum() else np.zeros(Q.BUCKETS)


@pytest.mark.parametrize("broadcast", [0, 10_000])
def test_ratio_and_verdicts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(Q, "BROADCAST_IDS", broadcast)
    docs, labels = corpus()
    labels += [labels[0], (None, 1, 0), (7777, 1, 0)]
    frame, marks = cases.docs(spark, [*docs, *cases.rows()]), spark.createDataFrame(labels, LABELS)
    ratio = Q.fit_ratio(Q.gram_counts(frame, marks))
    assert np.allclose(ratio, brute_ratio([*docs, *cases.rows()], labels))
    got = {r["doc_id"]: r for r in Q.judge(cases.docs(spark, docs), marks).collect()}
    for i, text, *_ in docs:
        n, _, _, _, rep = brute_counts(text)
        assert got[i]["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert got[i]["kept"] == (not got[i]["base_failed"] and i % 5 != 0)


def test_ratio_of_hot_text(spark):
    """A long text's n-grams are counted as well as a short one's."""
    docs, labels = [(1, "tick tack " * 5000, "en", "s", 1), (2, "tick tock", "en", "s", 1)], [(2, 1, 0), (1, 1, 0)]
    frame, marks = cases.docs(spark, docs), spark.createDataFrame(labels, LABELS)
    assert np.allclose(Q.fit_ratio(Q.gram_counts(frame, marks)), brute_ratio(docs, labels))


def test_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert Q.judge(cases.docs(spark, []), none).collect() == []
    got = Q.judge(cases.docs(spark), none).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0 for r in got)
    assert Q.threshold(Q.score(cases.docs(spark), np.zeros(Q.BUCKETS)), none) == -math.inf
