"""The pipeline's stages against the operators' brute-force versions, and the guard."""

import subprocess
import sys
import weakref
from collections import Counter
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline as P
from llm import cases
from llm.test_line_dedup import brute as brute_lines
from llm.test_mixing import brute_counts
from llm.test_simhash import brute_kept
from pricebasket.llm import bpe, language_id, line_dedup, mixing, simhash

ROOT = Path(__file__).resolve().parents[2]


def step(spark, stage, rows):
    name, f = P.STAGES[stage]
    return f(spark, cases.docs(spark, rows), "unused")


def test_stages():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "bpe"]


def test_each_stage_on_hard_rows(spark):
    data = cases.rows(70, 12)
    docs = cases.docs(spark, data)
    kept = step(spark, 0, data)
    assert kept.columns == docs.columns
    models = language_id.train(docs)
    want = [r for r in data if not models.predict([r[1]])[2][0]]
    rows = [tuple(r) for r in kept.collect()]
    assert Counter(rows) == Counter(want) and len(want) >= 68

    lines = step(spark, 1, rows)
    after = [tuple(r) for r in lines.collect()]
    texts = {(i, t) for i, _, _, t in brute_lines(rows)}
    assert lines.columns == docs.columns and len(after) == len(rows)
    assert {(-1 if r[0] is None else r[0], r[1] or "") for r in after} == texts
    assert all(r[4] == len(r[1]) for r in after if r[1] is not None)

    near = step(spark, 2, after)
    left = [tuple(r) for r in near.collect()]
    groups = brute_kept(after)
    assert near.columns == docs.columns
    assert len(left) == len(groups) and all(any((r[0], r[1]) in g for r in left) for g in groups) and set(left) <= set(after)

    mixed = step(spark, 3, left)
    copies = [tuple(r) for r in mixed.collect()]
    want = Counter()
    for r, n in zip(left, brute_counts(left, mixing.WEIGHTS, 1.0, 1.0), strict=True):
        want[r] += n
    assert mixed.columns == docs.columns and Counter(copies) == +want

    codec = bpe.load_codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in step(spark, 4, copies).collect())
    assert got == Counter((r[0], tuple(enc.encode_ordinary(r[1] or ""))) for r in copies)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "12", "en", "s", 2), (None, "", "en", None, 0)]])
def test_run_takes_poor_tables(spark, tmp_path, rows):
    cases.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


class Task:
    """Stands for a table: gives the function that its tasks would run."""

    def select(self, *cols):
        return self

    def mapInArrow(self, run, kind):
        return run


def test_a_worker_holds_one_operators_memory(spark):
    """Tables of words met, of some 100 MB a worker, stayed while later stages ran."""
    def codec():
        return weakref.ref(bpe.load_codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN))

    def words():
        models = language_id.LanguageModels({"en": language_id.fit_language({"some": 3, "words": 2})})
        assert models.entropies(["some words"])[1].tolist() == [11.0]
        return weakref.ref(models)

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array(["a line of text"])], names=["a", "b", "c"])
    for held in (codec, words):
        for other in (lambda: list(line_dedup.postings(Task())([batch])), lambda: simhash._prints(pa.array(["a b c"]), 3)):
            one = held()
            assert one() is not None  # from one task to the next
            other()
            assert one() is None
    one = words()
    again = codec()
    assert one() is None and codec()() is again()


def test_run_is_the_stages_in_turn(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, f in P.STAGES:
        docs = f(spark, docs, sf)
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in docs.collect()) == \
        Counter((r["doc_id"], r["ids_sha256"]) for r in P.run(spark, sf).collect())


def test_entry_works_without_the_subpackage(tmp_path):
    """As if the folders were deleted, or a library that only they need were not
    there: the base queries are there, the others aren't."""
    code = ("import sys; sys.path.insert(0, {root!r}); sys.modules[{gone!r}] = None\n"
            "import __spark_entry__ as E; print(len(E.queries()) == len(E.base_queries()), 'pipeline' in E.queries())")
    for gone in ("corpus_pipeline", "pricebasket.llm", "xxhash", "regex", "public_tokenizers"):
        run = subprocess.run([sys.executable, "-c", code.format(root=str(ROOT), gone=gone)], capture_output=True, text=True, cwd=tmp_path)
        assert run.stdout.split() == ["True", "False"], (gone, run.stderr[-500:])
        assert (gone in run.stderr) == (gone in ("xxhash", "regex", "public_tokenizers"))  # said, not swallowed
