import random
import re

import numpy as np
import pytest
import xxhash

from llm import cases
from pricebasket.llm import simhash as S
from pricebasket.llm.components import connected_components
from pricebasket.llm.gray_index import GrayIndex, gray_rank


def brute_print(text, words=3):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    grams = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64(g, seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def brute_components(prints, radius=2):
    """Node to smallest linked node, over nodes with given fingerprints."""
    nodes = sorted(prints)
    f = np.array([prints[n] for n in nodes], np.uint64)
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, n in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = find(n), find(nodes[j])
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_prints(rng, families=20, size=25):
    out = set()
    for _ in range(families):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    # a run: all agree on their upper half
    return out | {0xABCDEF01 << 32 | rng.getrandbits(14) for _ in range(400)}


def test_matches_brute_force(spark):
    data = [r for r in cases.rows(80, 2) if r[0] is not None]
    prints = {r[0]: brute_print(r[1]) for r in data}
    want = brute_components(prints)
    got = [tuple(r) for r in S.near_dup_components(cases.docs(spark, data)).collect()]
    assert sorted(got) == sorted((r[0], f"{prints[r[0]]:016x}", want[r[0]]) for r in data)


def test_long_text_is_summed_in_parts(monkeypatch):
    rng = random.Random(0)
    hashes = np.array([rng.getrandbits(64) for _ in range(1000)], np.uint64)
    sizes = np.array([0, 3, 500, 0, 497])
    whole = S.majority(hashes, sizes)
    monkeypatch.setattr(S, "LANE_ROWS", 7)
    assert (S.majority(hashes, sizes) == whole).all() and whole[0] == whole[3] == 0
    of = hashes[3:503]
    assert int(whole[2]) == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in of) > 500)


@pytest.mark.parametrize("block", [40, 300, 100_000])
def test_links_have_the_components_of_all_pairs(spark, block):
    """Also where runs are larger than a block and are cut, and searched in several tasks."""
    prints = np.array(sorted(near_prints(random.Random(4))), np.uint64)
    want = brute_components({int(s): int(p) for s, p in zip(prints.view(np.int64), prints, strict=True)})
    classes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    root = {r["node"]: r["root"] for r in connected_components(S.links(classes, 2, block)).collect()}
    assert {n: root.get(n, n) for n in want} == want


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_index_finds_all_pairs(radius):
    prints = np.array(sorted(near_prints(random.Random(5), 8)), np.uint64)
    got = {(int(q), int(m)) for a, b in GrayIndex(prints).search(prints, radius) for q, m in zip(a, b, strict=True)}
    near = np.bitwise_count(prints[:, None] ^ prints) <= radius
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(1000, dtype=np.uint64)
    codes ^= codes >> np.uint64(1)
    assert (gray_rank(codes) == np.arange(1000)).all()


def test_chain_and_empty_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(7, 7), (3, 2)], "a long, b long")
    assert {tuple(r) for r in connected_components(edges).collect()} == {(i, 0) for i in range(1, 61)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_kept(data):
    """(doc_id, text) of the row that stays of each component: nodes are rows, told by their place."""
    prints = {n: brute_print(r[1]) for n, r in enumerate(data)}
    groups = {}
    for n, root in brute_components(prints).items():
        groups.setdefault(root, []).append(data[n])
    out = []
    for rows in groups.values():
        first = min((r[0] is None, r[0] or 0) for r in rows)
        out.append({(r[0], r[1]) for r in rows if (r[0] is None, r[0] or 0) == first})
    return out


@pytest.mark.parametrize("seed", [2, 7])
def test_one_row_of_each_group_stays(spark, seed):
    data = cases.rows(80, seed)
    data += [(5, "quite another text under an id that is there", "en", "s", 1), (None, data[9][1], "en", "s", 2)]
    docs = cases.clashing(cases.docs(spark, data))
    kept = S.drop_near_dups(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = brute_kept(data)
    assert len(left) == len(want) and all(any(x in group for group in want) for x in left)
    assert all(sum(x in group for x in left) >= 1 for group in want)


def test_rows_without_ids_and_with_one_id(spark):
    text, other = "one two three four five six", "nothing like it in any of its words at all"
    rows = [(1, text), (5, text), (5, other), (None, text), (None, text)]
    for data, want in ((rows, [(1, text), (5, other)]), (rows[3:], [(None, text)]), ([rows[2]] * 3, [(5, other)])):
        got = S.drop_near_dups(spark.createDataFrame(data, "doc_id long, text string"))
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_table(spark):
    assert S.near_dup_components(cases.docs(spark, [])).collect() == []
    assert S.drop_near_dups(cases.docs(spark, [])).collect() == []


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r[0]: brute_print(r[1]) for r in rows}
    want = brute_components(prints)
    assert {tuple(r) for r in S.op2_simhash(spark, sf).collect()} == {(i, f"{prints[i]:016x}", want[i]) for i in prints}
