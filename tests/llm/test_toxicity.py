import math
import random
import zlib

import numpy as np
import pytest

from llm import cases
from pricebasket.llm import toxicity as T

INSULTS = ["idiot", "scum", "moron"]


def data(n=900, seed=1):
    """Documents of several sentences; the toxic ones have an insult in one."""
    rng = random.Random(seed)
    docs, labels, places = [], [], {}
    for i in range(n):
        sentences = [" ".join(rng.choice(cases.WORDS["en"]) for _ in range(rng.randint(2, 8))).capitalize() + "." for _ in range(rng.randint(1, 12))]
        toxic = rng.random() < 0.25
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] = f"You {rng.choice(INSULTS)} " + sentences[k]
            places[i] = sentences[k]
        docs.append((i, " ".join(sentences), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels, places


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels, places = data()
    frame = cases.docs(spark, docs)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return T.train(frame, marks), docs, labels, places


def test_held_out_accuracy(trained):
    model, docs, labels, _ = trained
    held = [(d[1], y) for d, (i, _, y) in zip(docs, labels, strict=True) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([(model.score(t) >= 0.5) == bool(y) for t, y in held]) > 0.98


def test_offending_sentences_are_located(spark, trained):
    model, docs, _, places = trained
    got = {r["doc_id"]: r for r in T.score(cases.docs(spark, docs), model, locate=True).collect()}
    found = 0
    for i, text, *_ in docs:
        spans = [text[s["start"]:s["end"]].strip() for s in got[i]["offending"]]
        assert all(any(w in s for w in INSULTS) for s in spans)
        found += i in places and places[i] in spans
    assert found > 0.95 * len(places)


def test_score_is_noisy_or_of_sentences(trained):
    model, docs, *_ = trained
    for _, text, *_ in docs[:50]:
        clean = 1 - T._logistic(model.leak)
        for *_, p in model.sentences(text):
            clean *= 1 - p
        assert math.isclose(model.score(text), 1 - clean, rel_tol=1e-6, abs_tol=1e-9)


def test_long_clean_text_stays_clean(trained):
    model, docs, labels, _ = trained
    clean = " ".join(d[1] for d, y in zip(docs, labels, strict=True) if not y[2])
    assert model.score(clean) < 0.5 <= model.score(clean + " You idiot thing.")


def test_insults_tell_in_long_and_short_sentences(spark):
    """Held-out documents: insults that come several at a time, one that seldom
    comes alone, in sentences of many words or of one."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abdeghilnorstuv") for _ in range(rng.randint(2, 8))) for _ in range(1500)]
    insults = ["idiot", "moron", "loser", "pathetic", "scum"]
    docs, labels = [], []
    for i in range(1500):
        sentences = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) + "." for _ in range(rng.randint(3, 15))]
        toxic = rng.random() < 0.12
        if toxic:
            for word in ["scum", rng.choice(insults[:-1])] if rng.random() < 0.6 else rng.sample(insults, rng.randint(1, 3)):
                k = rng.randrange(len(sentences))
                sentences[k] = f"{word.upper()}!!" if rng.random() < 0.3 else sentences[k][:-1] + f" {word} " + sentences[k]
        rng.shuffle(sentences)
        docs.append((i, " ".join(sentences), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    model = T.train(cases.docs(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [(d[1], y) for d, (i, _, y) in zip(docs, labels, strict=True) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(model.score(t) >= 0.5 for t, y in held if y) and sum(y for _, y in held) > 20
    assert np.mean([model.score(t) >= 0.5 for t, y in held if not y]) < 0.01
    filler = " ".join(vocabulary[:80])
    assert all(model.score(f"{filler} {w} {filler}.") >= 0.5 for w in insults) and model.score(f"{filler} {filler}.") < 0.5


def test_training_reaches_a_low_point():
    """The trained weights are no worse than small moves from them."""
    rng = np.random.default_rng(0)
    labels = (np.arange(40) % 3 == 0).astype(float)
    doc = np.repeat(np.arange(40), 3)
    row, col = np.repeat(np.arange(120), 2), rng.integers(1, 10, 240)
    col[::6][labels > 0] = 0  # the telling word
    weights, leak = T.Instances(labels, np.ones(40), doc, row, col).fit()

    def loss(w, k):
        z = np.bincount(row, w[col], 120) + T.BIAS
        total = np.bincount(doc, np.logaddexp(0, z), 40) + np.logaddexp(0, k)
        return np.where(labels > 0, -np.log(-np.expm1(-total)), total).mean()

    best = loss(weights[:10], leak)
    assert best < loss(np.zeros(10), leak)
    assert np.argmax(weights[:10]) == 0
    # the weight that tells is settled: pushing it down costs more than it saves
    assert best < loss(weights[:10] - 5 * (np.arange(10) == 0), leak)


def test_hard_rows(spark, trained):
    model = trained[0]
    got = {r["doc_id"]: r for r in T.score(cases.clashing(cases.docs(spark)), model, locate=True).collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[900]["score"] == got[901]["score"] == 0 and got[902]["offending"] == []
    assert T.score(cases.docs(spark, []), model).collect() == []


def test_too_few_labels(spark):
    docs = cases.docs(spark)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (3, 1, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (empty, one_kind):
        assert T.train(docs, labels) is None
    assert {r["score"] for r in T.score(docs, None).collect()} == {0.0}
