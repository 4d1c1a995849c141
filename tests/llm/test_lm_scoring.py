import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm import cases
from pricebasket.llm import lm_scoring as L
from pricebasket.llm.common import words_of


def tokens(text):
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())] + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(data):
    """Counts, base scores and, from the class definition, each token's probability in its class."""
    c = Counter()
    for i, text, *_ in data:
        if not held(i):
            c.update(tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for i, text, *_ in data:
        t = tokens(text)
        out.append((-1 if i is None else i, held(i), len(t), sum(c[x] > 0 for x in t), n,
                    round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), 6)))
    return sorted(out), c


def rows_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in df.collect())


@pytest.mark.parametrize("chunk, broadcast", [(1_000_000, 100_000), (50, 3)])
def test_base_matches_brute_force(spark, monkeypatch, chunk, broadcast):
    monkeypatch.setattr(L, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(L, "BROADCAST_WORDS", broadcast)
    monkeypatch.setattr(L, "LEAST_TRAINED", 500)
    want, _ = brute(cases.rows())
    assert rows_of(L.score(cases.clashing(cases.docs(spark)))) == want


def brute_score(model, counts, text):
    """log10 probability of a text from the model's vectors, token by token, each
    softmax written out over all classes and all words of the class; and the sums
    of the probabilities that they give."""
    tree, known = model.tree, {w: c for w, c in counts.items() if w is not None}
    of = lambda w: L.END if w is None else tree.class_of(w)
    members = {}
    for w in known:
        members.setdefault(of(w), []).append(w)
    total, sums, before, topic = 0.0, [], [], L.TOPICS
    for n, w in enumerate(tokens(text)):
        if n % L.TOPIC_TOKENS == 0 and n:
            topic = int(sum(model.scores[k] for k in before).argmax())
        ctx = [before[-1] if n else L.END, before[-2] if n > 1 else L.END]
        q = model.topic[topic].astype(float) * model.position[2]
        h = model.context[ctx[0]].astype(float) * model.position[0] + model.context[ctx[1]].astype(float) * model.position[1] + q
        logits = [float(h @ model.target[k].astype(float)) + float(model.bias[k]) for k in range(tree.n)]
        z = [math.exp(x) for x in logits]
        k = of(w)
        total += math.log10(z[k] / sum(z))
        if k > tree.n_top:  # a class of many words, and one not seen
            n_c, v_c = sum(counts[x] for x in members.get(k, [])), len(members.get(k, []))
            wish = {x: (counts[x] + 1) / (n_c + v_c + 1) * math.exp(float(q @ model.word[tree.leaf[x]].astype(float)) if x in tree.leaf else 0.0)
                    for x in members.get(k, [])}
            unseen = 1 / (n_c + v_c + 1)
            total += math.log10(wish.get(w, unseen) / (sum(wish.values()) + unseen))
        before.append(k)
    return total


@pytest.mark.parametrize("modelled", [100_000, 30])
def test_scores_are_the_normalised_probabilities(spark, monkeypatch, modelled):
    """Against the model applied token by token, rare and unseen words included; in
    one chunk and in many."""
    monkeypatch.setattr(L, "BROADCAST_WORDS", modelled)
    monkeypatch.setattr(L, "LEAST_TRAINED", 5000)
    data = [r for r in cases.rows(40, 8) if r[0] is not None and r[0] < 900]
    data.append((2, "words that were never seen in any of it", "en", "s", 1))
    _, c = brute(data)
    packed = L.chunks(cases.docs(spark, data))
    counts = L.word_counts(packed)
    model = L.train(packed, counts)
    assert np.abs(model.target).sum() > 0 and np.abs(model.word).sum() > 0
    monkeypatch.setattr(L, "CHUNK_TOKENS", 30)
    many = L.chunks(cases.docs(spark, data))
    assert many.count() > packed.count()
    for chunked in (packed, many):
        got = {(r["doc_id"], r["n_tokens"]): r["score"] for r in L.score_with(chunked, counts, model).collect()}
        for i, text, *_ in data:
            assert math.isclose(got[i, len(tokens(text))], brute_score(model, c, text), rel_tol=1e-5)


def test_a_larger_vocabulary_has_more_classes():
    sizes = [L.Tree({f"word{i}".encode(): 5 for i in range(n)}).n for n in (0, 100, 2500, 40_000)]
    assert sizes == [9, 11, 51, 201]
    tree = L.Tree({w.encode(): 9 - len(w) for w in ("é", "thé,", "the", "then", "when", "where")})
    assert tree.class_of("soigné".encode()) == tree.class_of("abîgné!".encode())
    assert sorted(tree.leaf.values()) == list(range(6)) and tree.first[-1] == 6


def test_words_of_a_column():
    texts = ["Ab c", "a\x1cB \x85x\xa0y\x00Z \tÄÖ\n\n q", "\x0b\x0c", "", "trail ", " Lead", " k\u3000m", "z" * 50, "One TWO one"] * 4
    for rows in (texts, [*texts, None]):
        for lo, hi in ((0, len(rows)), (1, 9), (7, len(rows)), (3, 3)):
            words, sizes = L.split_words(pa.array(rows).slice(lo, hi - lo))
            own = [words_of(t) for t in rows[lo:hi]]
            assert words.to_pylist() == [w for x in own for w in x] and sizes.tolist() == list(map(len, own))


def test_chunks_hold_every_word_of_long_columns(spark, monkeypatch):
    """A column larger than what is split at once, over several chunks."""
    monkeypatch.setattr(L, "PART_BYTES", 20_000)
    monkeypatch.setattr(L, "CHUNK_TOKENS", 5000)
    data = [(i, f"Word{i % 7} some{i} " * (200 + i), "en", "s", None) for i in range(60)]
    got, chunks = [], []
    for r in L.chunks(cases.docs(spark, data).coalesce(1).sortWithinPartitions("doc_id")).orderBy("chunk").collect():
        held, sizes, codes = L._arrays(r.asDict())
        words = [bytes(w) for w in r["words"]]
        assert [L.ending(w) for w in words] == np.frombuffer(r["endings"], np.int32).tolist()
        assert r["counts"] == np.bincount(codes[np.repeat(~held, sizes)], minlength=len(words)).tolist()
        assert len(codes) + len(sizes) - sizes[-1] - 1 < L.CHUNK_TOKENS
        ends = np.cumsum(sizes)
        got += [(i, [words[c] for c in codes[e - n:e]]) for i, n, e in zip(r["ids"], sizes, ends, strict=True)]
        chunks.append(len(sizes))
    assert len(chunks) > 4 and got == [(r[0], words_of(r[1])) for r in data]


def test_topics_follow_the_text():
    scores = np.zeros((10, L.TOPICS))
    scores[1:5, 2], scores[5:, 3] = 1.0, 1.0
    sizes = np.array([40, 3, 20])
    starts = np.cumsum(sizes + 1) - sizes - 1
    classes = np.concatenate([np.full(41, 2), np.full(4, 7), np.full(21, 6)])
    got = L.topics_so_far(classes, sizes, starts, scores)
    none, n = L.TOPICS, L.TOPIC_TOKENS
    assert got.tolist() == [none] * n + [2] * (41 - n) + [none] * 4 + [none] * n + [3] * (21 - n)


def test_held_out_text_is_likelier_than_by_the_base(spark):
    data = [r for r in cases.rows(400, 6) if r[0] is not None and r[0] < 900]
    got = [r for r in L.score(cases.docs(spark, data)).collect() if r["held_out"]]
    assert len(got) > 30 and sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), max(1, 1000 // (i + 1))) for i in range(300)], "word binary, c long")
    for most in (1, 10, 120, 1000):
        got = L.frequent_words(counts, most)
        assert len(got) <= most and len(got) > min(most, 300) // 3 - 1
        assert min(got.values(), default=1) >= max([r["c"] for r in counts.collect() if bytes(r["word"]) not in got], default=0)
    same = spark.createDataFrame([(f"w{i}".encode(), 5) for i in range(20)], "word binary, c long")
    assert L.frequent_words(same, 19) == {} and len(L.frequent_words(same, 20)) == 20


def test_drawn_noise_recovers_the_probabilities():
    """Trained on a known chain of classes, the normalised model is far nearer to it than the unigram is."""
    rng = np.random.default_rng(1)
    words = {f"w{i}".encode(): 1000 - i for i in range(12)}
    tree = L.Tree(words)
    truth = rng.dirichlet(np.full(tree.n, 0.5), size=tree.n)
    chain = [1]
    for _ in range(40_000):
        chain.append(int(rng.choice(tree.n, p=truth[chain[-1]])))
    chain = np.array(chain)
    tree.fill(np.bincount(chain, minlength=tree.n), np.ones(tree.n, np.int64), 1)
    model = L.LogBilinear(tree, np.zeros((tree.n, L.TOPICS)))
    model.prepare()
    p, none = model.params(), np.full(len(chain) - 2, L.TOPICS)
    one, two, target = chain[1:-1], chain[:-2], chain[2:]
    for turn in range(10):
        for lo in range(0, len(target), 500):
            x = slice(lo, lo + 500)
            model.learn_classes(p, one[x], two[x], none[x], target[x], rng, 0.1)
    before = L.class_logs(model.tables(), one, two, none, target).mean()
    model.set_flat(model.flat(p))
    after = L.class_logs(model.tables(), one, two, none, target).mean()
    best = np.log10(truth[one, target]).mean()
    assert before < after < best + 0.01 and after - before > 0.6 * (best - before)
    every = [10 ** L.class_logs(model.tables(), np.full(tree.n, a), np.full(tree.n, b), np.full(tree.n, 3), np.arange(tree.n)).astype(float)
             for a, b in ((1, 2), (0, 0), (5, 3))]
    assert np.allclose([x.sum() for x in every], 1, atol=1e-5)


def test_empty_and_untrained(spark):
    assert L.score(cases.docs(spark, [])).collect() == []
    only_held = [(i, "some words", "en", "s", 1) for i in range(200) if held(i)][:3]
    got = L.score(cases.docs(spark, only_held)).collect()
    assert all((r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and math.isfinite(r["score"]) for r in got) and len(got) == 3
