import hashlib
from collections import defaultdict

import numpy as np
import pytest

from llm import cases
from pricebasket.llm import line_dedup as L
from pricebasket.llm.cuckoo import CuckooFilter

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, min_chars=10):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(AZ)
    rank = lambda i: (1 << 63) if i is None else i
    holders = defaultdict(set)
    for i, text, *_ in data:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(rank(i))
    out = []
    for i, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == rank(i)]
        out.append((-1 if i is None else i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(df):
    return sorted((-1 if r[0] is None else r[0], r["n_lines"], r["n_dropped"], r["kept_text"] or "") for r in df.collect())


def report(docs, index):
    return result(L.drop_lines(docs, index.duplicates(), report=True))


def test_matches_brute_force(spark):
    docs = cases.docs(spark)
    assert report(docs, L.build_index(docs)) == brute(cases.rows())


def test_other_columns_stay(spark):
    docs = cases.clashing(cases.docs(spark))
    out = L.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("fp = 'own fp' and c1 = 'own c1'").count() == docs.count()


def test_empty_table(spark):
    docs = cases.docs(spark, [])
    assert L.dedup_lines(docs).collect() == []


@pytest.mark.parametrize("shard_keys", [20, 250_000])
def test_insert_and_delete_are_reversible(spark, monkeypatch, shard_keys):
    monkeypatch.setattr(L, "SHARD_KEYS", shard_keys)
    data = [r for r in cases.rows(90, 3) if r[0] is not None]
    first, second = [r for r in data if r[0] % 3], [r for r in data if not r[0] % 3]
    a, b = cases.docs(spark, first), cases.docs(spark, second)
    index = L.LineIndex.empty(spark, 200).insert(L.postings(a))
    before = sorted(map(tuple, index.refs.collect()))
    both = index.insert(L.postings(b))
    assert report(cases.docs(spark, data), both) == brute(data)
    back = both.delete(b.select("doc_id"))
    assert sorted(map(tuple, back.refs.collect())) == sorted(map(tuple, before))
    assert report(a, back) == brute(first)
    # keys nobody holds have left their filters, the others are still there
    stored = {r["shard"]: CuckooFilter.from_bytes(r["filter"]) for r in back.filters.collect()}
    live = sum(int((t > 0).sum()) for f in stored.values() for t in f.tables)
    assert live == back.refs.count()
    for r in back.refs.collect():
        assert stored[r["shard"]].contains(np.frombuffer(bytes(r["key"])[8:], "<u8"))[0]


def test_only_lines_seen_before_are_looked_up(spark):
    data = [(i, f"line number {i} is its own\nthis line is in all of them\nand line {i % 20} in some", "en", "s", 1) for i in range(300)]
    first, second = (L.postings(cases.docs(spark, x)) for x in (data[:200], data[200:]))
    index = L.LineIndex.empty(spark, 400).insert(first)
    assert index.looked_up.count() == 0  # nothing is known to an empty index
    both = index.insert(second)
    known = {bytes(r["key"]) for r in index.refs.collect()}
    really = {bytes(r["key"]) for r in second.collect()} & known
    looked = {bytes(r["key"]) for r in both.looked_up.collect()}
    assert len(really) == 21 and really <= looked and len(looked) <= 23  # of 121 keys; false positives are rare
    assert both.refs.count() == 300 + 21 and both.refs.agg({"n_docs": "sum"}).first()[0] == 900
    assert report(cases.docs(spark, data), both) == brute(data)


def test_a_growing_index_gets_more_shards(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 10)
    data = [r for r in cases.rows(60, 6) if r[0] is not None]
    index = L.LineIndex.empty(spark)
    for part in range(3):
        index = index.insert(L.postings(cases.docs(spark, [r for r in data if r[0] % 3 == part])))
    assert index.shards > 5 and index.filters.count() <= index.shards
    assert report(cases.docs(spark, data), index) == brute(data)
    back = index.delete(spark.createDataFrame([(r[0],) for r in data if r[0] % 2], "id long"))
    left = [r for r in data if r[0] % 2 == 0]
    assert report(cases.docs(spark, left), back) == brute(left)


def test_rows_without_an_id_are_documents_of_their_own(spark):
    shared = "a line that two rows share"
    data = [(None, f"{shared}\nfirst row's own line", "en", "s", 1), (None, f"{shared}\nsecond row's own line", "en", "s", 1),
            (4, "an unrelated line here\na line that only 4 and none hold", "en", "s", 1),
            (None, "a line that only 4 and none hold", "en", "s", 1)]
    got = [r["text"] for r in L.dedup_lines(cases.docs(spark, data)).collect()]
    assert sum(shared in t for t in got) == 1 and sum("own line" in t for t in got) == 2
    assert "" in got and data[2][1] in got  # 4 keeps its line, the row without an id loses it
    index = L.build_index(cases.docs(spark, data))
    none = index.delete(spark.createDataFrame([(None,)], "id long"))
    assert {r["doc_id"] for r in none.posts.select("doc_id").distinct().collect()} == {4}


def test_rows_of_one_id_gather_no_more_than_a_text(spark):
    """A third of all rows may share an id, or have none: a text's list of lost lines stays its own."""
    for doc in (None, 7):
        data = [(doc, f"own line number {i}\nthe line that all rows share\n" + "\n".join(f"line {i} {j} here" for j in range(4)), "en", "s", 1)
                for i in range(300)] + [(1, "the line that all rows share", "en", "s", 1)]
        dups = L.build_index(cases.docs(spark, data)).duplicates().collect()
        assert len(dups) == 300 and max(len(r["keys"]) for r in dups) == 1


def test_cuckoo_delete_leaves_what_it_cannot_tell():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 4000).astype(np.uint64)
    f = CuckooFilter(50)
    f.insert(keys)
    assert len(f.tables) > 1
    f.delete(keys[:3000])
    assert f.contains(keys[3000:]).all() and f.contains(keys[:3000]).mean() < 0.02
    twice = CuckooFilter(8)
    twice.insert(np.array([9, 9, 9], np.uint64))
    twice.delete(np.array([9, 9], np.uint64))
    assert sum(int((t > 0).sum()) for t in twice.tables) == 1


def test_cuckoo_never_misses():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    f = CuckooFilter(100)  # far too small: it chains further tables
    f.insert(keys)
    assert f.contains(keys).all() and f.contains(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01
    f = CuckooFilter.from_bytes(f.to_bytes())
    f.delete(keys[:5000])
    assert f.contains(keys[5000:]).all() and f.contains(keys[:5000]).mean() < 0.01
    full = CuckooFilter(1)
    full.insert(np.full(40, 7, np.uint64))
    assert sum(int((t > 0).sum()) for t in full.tables) == 40


def test_query_hashes_kept_text(spark):
    got = {r["doc_id"]: r for r in L.op9_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    for i, n, d, kept in brute(data):
        assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["kept_sha256"]) == (n, d, hashlib.sha256(kept.encode()).hexdigest())
