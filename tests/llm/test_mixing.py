import hashlib
import math
from collections import Counter

import pytest

from llm import cases
from oracle_compare import compare, duck
from pricebasket.llm import mixing as M


def brute_counts(data, weights, other, epochs):
    size, w = Counter(), {}
    for _, text, _, source, _ in data:
        size[source] += len(text or "")
    for s in size:
        w[s] = weights.get(s, other) if size[s] else 0.0
    total, all_w = sum(size.values()), sum(w.values())
    out = []
    for i, _, _, s, _ in data:
        mean = epochs * total * w[s] / all_w / size[s] if size[s] else 0.0
        draws = max(1, math.ceil(mean / M.STEP))
        n = 0
        for d in range(1, draws + 1):
            digest = hashlib.md5(f"{M.SEED}:{'null' if i is None else i}:{d}".encode()).hexdigest()
            u, p = int(digest[:13], 16) / (1 << 52), math.exp(-mean / draws)
            below, k = p, 0
            while k < M.TERMS and u >= below:
                k += 1
                p *= mean / draws / k
                below += p
                n += 1
            n += u >= below and k == M.TERMS
        out.append(n)
    return out


@pytest.mark.parametrize("weights, epochs", [({"s0": 2.0}, 1.0), ({"s0": 0.0, "s9": 300.0}, 3.0)])
def test_matches_brute_force(spark, weights, epochs):
    """The second case has a mean of several steps and a source of weight zero."""
    data = cases.rows()
    want = Counter()
    for r, n in zip(data, brute_counts(data, weights, 1.0, epochs), strict=True):
        want.update({(*r, c): 1 for c in range(n)} if n else {})
    got = Counter(tuple(r) for r in M.mix(cases.docs(spark), weights, epochs=epochs, copy_col="copy").collect())
    assert got == want and max(c for *_, c in got) >= 1


def test_shares_come_near_the_target(spark):
    rows = [(i, "x" * 100, "en", "big" if i % 3 else f"s{i % 4}", 100) for i in range(6000)]
    out = M.mix(cases.docs(spark, rows), {"big": 1.0})
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    share = 6000 / len(n)
    assert all(abs(c - share) < 5 * math.sqrt(share) for c in n.values())


def test_clashing_names_and_empty(spark):
    docs = cases.clashing(cases.docs(spark))
    out = M.mix(docs, {})
    assert out.columns == docs.columns and out.where("_copies = 'own _copies' and c1 = 'own c1'").count() == out.count() > 0
    assert M.mix(cases.docs(spark, []), {}).collect() == []
    assert M.mix(cases.docs(spark, [(1, None, "en", None, None), (2, "", "en", "a", 0)]), {}).collect() == []


def test_rates_by_join_are_the_same(spark, monkeypatch):
    docs = cases.docs(spark)
    want = Counter(map(tuple, M.mix(docs, {"s0": 2.0}).collect()))
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert Counter(map(tuple, M.mix(docs, {"s0": 2.0}).collect())) == want


def test_copies_of_a_tiny_source_are_exploded_in_bounded_ranges(spark, monkeypatch):
    """A NULL source of one short document, repeated, and a NULL id, beside much text."""
    monkeypatch.setattr(M, "BLOCK_DRAWS", 4, raising=False)
    explode = M.F.explode
    monkeypatch.setattr(M.F, "explode", lambda c: explode(M.F.when(M.F.size(c) <= 4 * M.TERMS, c).otherwise(
        M.F.raise_error(M.F.lit("a row of too many copies")).cast("array<bigint>"))))
    data = [(i, "x" * 200, "en", "big", 200) for i in range(100)] + [(500, "short", "en", None, 5)] * 2 + [(None, "tiny", "en", "s1", 4)]
    want = Counter()
    for r, n in zip(data, brute_counts(data, {}, 1.0, 1.0), strict=True):
        want.update({(*r, c): 1 for c in range(n)} if n else {})
    assert max(c for *_, c in want) > 1000
    assert Counter(tuple(r) for r in M.mix(cases.docs(spark, data), {}, copy_col="copy").collect()) == want


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), "op1", M.op1_mixing, M.ORACLE_OP1, sf)["ok"]
