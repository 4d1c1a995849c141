import math
import random
from collections import Counter

import numpy as np
import pytest

from llm import cases
from pricebasket.llm import language_id as L


def brute_model(counts):
    """Interpolated Kneser-Ney with plain dictionaries: log probability of a word."""
    grams = [Counter() for _ in range(L.ORDER + 1)]
    for w, n in counts.items():
        s = ["<", *w, ">"]
        for k in range(1, L.ORDER + 1):
            for e in range(max(1, k - 1), len(s)):
                grams[k][tuple(s[e - k + 1:e + 1])] += n
    used = [None] * (L.ORDER + 1)
    used[L.ORDER] = grams[L.ORDER]
    for k in range(1, L.ORDER):
        before = Counter()
        for g in grams[k + 1]:
            before[g[1:]] += 1
        used[k] = Counter({g: n if g[0] == "<" else before[g] for g, n in grams[k].items()})
    discount, total, kinds = [0.0] * (L.ORDER + 1), [Counter() for _ in used], [Counter() for _ in used]
    for k in range(1, L.ORDER + 1):
        ones, twos = (sum(v == x for v in used[k].values()) for x in (1, 2))
        discount[k] = ones / (ones + 2 * twos) if ones and twos else 0.5
        for g, n in used[k].items():
            total[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def word(w, floor):
        s, out = ["<", *w, ">"], 0.0
        for e in range(1, len(s)):
            p = floor
            for k in range(1, min(L.ORDER, e + 1) + 1):
                g = tuple(s[e - k + 1:e + 1])
                if total[k][g[:-1]]:
                    p = max(used[k][g] - discount[k], 0) / total[k][g[:-1]] + discount[k] * kinds[k][g[:-1]] / total[k][g[:-1]] * p
            out += math.log(p)
        return out

    return word, {g[0] for g in used[1]}


def test_models_match_plain_dictionaries():
    rng = random.Random(0)
    counts = {x: Counter(w for _ in range(300) for w in L.WORDS.findall(cases.prose(rng, x, 3))) for x in ("en", "fr")}
    models = L.LanguageModels({x: L.fit_language(c) for x, c in counts.items()})
    plain = {x: brute_model(c) for x, c in counts.items()}
    assert math.isclose(models.floor, 1 / (len(set().union(*(s for _, s in plain.values()))) + 1))
    words = ["the", "était", "thought", "zq", "e", "漢字", "a" * 300, "houses"]
    got = models.word_logs(words)
    for i, w in enumerate(words):
        for j, x in enumerate(models.langs):
            assert math.isclose(got[i, j], plain[x][0](w, models.floor), rel_tol=1e-4), (w, x)


def test_probabilities_sum_to_one():
    counts = Counter({"abab": 3, "ba": 2, "b": 1, "aab": 1})
    models = L.LanguageModels({"x": L.fit_language(counts)})
    # all words over the letters and one unseen: the chance of a word of up to three letters and its end, or of going on
    def spread(prefix, depth):
        own = math.exp(models.word_logs([prefix])[0, 0]) if prefix else math.exp(models.word_logs([""])[0, 0])
        return own + (sum(spread(prefix + c, depth - 1) for c in "abz") if depth else 0)
    assert spread("", 5) <= 1.0 + 1e-6


def labelled(n=400, seed=3):
    rng = random.Random(seed)
    return [(i, cases.prose(rng, lang, rng.randint(3, 80)), lang, "s", 1) for i in range(n) for lang in [rng.choice(["en", "fr"])]]


@pytest.fixture(scope="module")
def models(spark):
    return L.train(cases.docs(spark, labelled()))


def test_held_out_accuracy_and_keeps(spark, models):
    data = labelled(200, 9)
    got = {r["doc_id"]: r for r in L.predict(cases.docs(spark, data), models).collect()}
    right = np.mean([got[i]["lang_pred"] == lang for i, _, lang, *_ in data])
    assert right > 0.97 and not any(r["rejected"] for r in got.values())
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_hard_rows(spark, models):
    docs = cases.clashing(cases.docs(spark))
    got = {r["doc_id"]: r for r in L.predict(docs, models).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {900, 901, 902, 906}
    assert all(got[i]["rejected"] and got[i]["score"] == 0 for i in (900, 901, 902, 906))
    kept = L.keep_known(docs, models)
    assert kept.columns == docs.columns and kept.where("c0 = 'own c0' and score = 'own score'").count() == kept.count() > 40
    other = [(1, "привет мир как дела сегодня очень хорошо " * 5, "en", "s", 1)]
    assert L.keep_known(cases.docs(spark, other), models).count() == 0
    assert L.keep_known(cases.docs(spark, []), models).collect() == []


def test_nothing_to_learn(spark):
    models = L.train(cases.docs(spark, [(1, "words", None, "s", 1), (None, "words", "en", "s", 1)]))
    assert models.langs == [] and models.predict(["words", None])[0] == ["und", "und"]
    assert L.train(cases.docs(spark, [])).langs == []


def test_cache_limit_changes_nothing(models, monkeypatch):
    texts = [r[1] for r in labelled(50, 4)]
    want = models.predict(texts)
    monkeypatch.setattr(L, "CACHE_WORDS", 3)
    monkeypatch.setattr(L, "CACHE_CHARS", 4)
    got = [models.predict([t]) for t in texts]
    assert [g[0][0] for g in got] == want[0] and np.allclose([g[1][0] for g in got], want[1])


def test_lang_is_no_input_of_held_out_rows(spark):
    data = labelled(120)
    import zlib
    held = [zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in data]
    swapped = [(r[0], r[1], "xx", "t", 0) if h else r for r, h in zip(data, held, strict=True)]
    a, b = (sorted(map(tuple, L.predict(cases.docs(spark, data), L.train(cases.docs(spark, d))).collect())) for d in (data, swapped))
    assert a == b
