import math

import numpy as np
import pytest

from oracle_compare import compare, duck
from pricebasket.llm import vector_search as V

KIND = "vec_id long, embedding array<float>, label int"


def vectors(n=300, dim=12, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, dim))
    out = [(i, [float(x) for x in (centres[i % 5] + rng.normal(0, spread, dim)).astype(np.float32)], i % 5) for i in range(n)]
    out[7] = (7, out[3][1], 0)  # equal vectors: a tie
    out[9] = (9, out[3][1], 0)
    bad = [None, [], [0.0] * dim, [None] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1),
           [1.0] * (dim + 1), [None, *[1.0] * (dim - 1)]]
    out += [(1000 + 100 * i, v, 0) for i, v in enumerate(bad)]
    return out + [(None, [1.0] * dim, 0)]


def brute(rows, k=10):
    ok = [(i, np.array(v, np.float64)) for i, v, *_ in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for q, a in ok:
        if q % 100 == 0:
            near = sorted((math.sqrt(sum((a - b) ** 2)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def same(got, want):
    got = sorted(tuple(r) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-12, abs_tol=1e-12) for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("rows, strip, queries", [(16_384, 2048, 1024), (37, 10, 2), (64, 64, 1)])
@pytest.mark.parametrize("spread", [1.0, 1e-4])
def test_matches_brute_force(spark, monkeypatch, rows, strip, queries, spread):
    monkeypatch.setattr(V, "ROWS", rows)
    monkeypatch.setattr(V, "STRIP", strip)
    monkeypatch.setattr(V, "QUERY_ROWS", queries)
    data = vectors(spread=spread)
    frame = spark.createDataFrame(data, KIND).selectExpr("*", "'own' as block", "'own' as id", "'own' as dim")
    same(V.nearest(frame, frame.where("vec_id % 100 = 0")).collect(), brute(data))


def test_bounds_hold():
    """Every pair's exact distance lies within the quantised one's bounds."""
    rng = np.random.default_rng(3)
    for scale in (1e-6, 1.0, 1e6):
        x = rng.normal(0, 1, (200, 30)) * rng.uniform(0.01, 10, (200, 1)) * scale
        q, s, e = V.quantise(x)
        back = q * s[:, None]
        about = np.sqrt(((back[:, None] - back) ** 2).sum(2))
        exact = np.sqrt(((x[:, None] - x) ** 2).sum(2))
        assert (np.abs(about - exact) <= e[:, None] + e + 1e-9 * scale).all()


def test_fewer_candidates_than_k(spark):
    data = [(0, [1.0, 2.0], 0), (1, [1.0, 2.5], 0), (2, [3.0, 3.0], 0), (100, [9.0], 0)]
    frame = spark.createDataFrame(data, KIND)
    same(V.nearest(frame, frame.where("vec_id % 100 = 0")).collect(), brute(data))


def test_repeated_rows(spark):
    data = [(i, [float(i % 17), 1.0 + i], 0) for i in range(30)]
    once = spark.createDataFrame(data, KIND)
    twice = spark.createDataFrame([*data[1:], data[0], data[0]], KIND)
    want = brute(data, 5)
    same(V.nearest(once, once.where("vec_id = 0"), 5).collect(), want)
    same(V.nearest(twice, twice.where("vec_id = 0"), 5).collect(), want)


def test_empty(spark):
    frame = spark.createDataFrame([], KIND)
    assert V.nearest(frame, frame).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), "op10", V.op10_vector_search, V.ORACLE_OP10, sf)["ok"]
