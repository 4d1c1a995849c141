"""Quality rules: a hashed n-gram log-likelihood ratio between the trusted
target and the raw corpus.

Words and word pairs are hashed into ``BUCKETS`` buckets.  One multinomial is
fitted on the documents labelled good (the trusted target), one on all
documents (the raw corpus), both over every row; a document's score is the mean
log ratio of its n-grams.  Rare buckets say little: each starts from ``PRIOR``
raw occurrences with the corpus's share of trusted ones.  A document is kept if
its score reaches the threshold and no base rule fails.  One in ``HELD`` trusted
documents is left out of the target and sets the threshold, exactly and
deterministically: one standard deviation under the score that ``KEEP_GOOD`` of
them reach, from their counts in score bins of ``BIN``.

Defined results: NULL and empty texts have no words, zero counts, score 0 and
fail the base rules.  Rows repeated in the input count as often as they occur.
A document labelled more than once is trusted if any label says so.  Without
trusted documents every score is 0 and the base rules alone decide.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import crc_mod, table, utf8, written

BUCKETS = 1 << 16
PRIOR = 10.0
HELD = 4
#: Up to so many trusted ids (8 bytes each) are broadcast; more are joined.
BROADCAST_IDS = 2_000_000
KEEP_GOOD, BIN = 0.998, 0.005
#: Words remembered per worker.
CACHE_WORDS = 250_000
SYMBOLS = re.compile(r"[#*$%&|<>]")
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hash of each word, and its number of code points."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 7)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def buckets(hashes: np.ndarray, n: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and word pairs."""
    pairs = (hashes[:-1] * _PAIR) ^ (hashes[1:] >> np.uint64(7)) ^ hashes[1:]
    return np.concatenate([hashes % np.uint64(n), (pairs ^ (pairs >> np.uint64(31))) % np.uint64(n)]).astype(np.int64)


def repeat_words(hashes: np.ndarray) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    n = len(hashes) - 2
    if n < 2:
        return 0
    h = hashes
    window = (h[:-2] * _PAIR + h[1:-1]) * _PAIR + h[2:]
    _, at, count = np.unique(window, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[at] > 1)
    hit = np.zeros(len(h) + 1, np.int64)
    np.add.at(hit, again, 1)
    np.add.at(hit, again + 3, -1) if len(again) and again[-1] + 3 <= len(h) else None
    return int((np.cumsum(hit)[:-1] > 0).sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _trusted(labels: DataFrame) -> DataFrame:
    """(good_id, held): trusted documents, and which set the threshold."""
    return labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").alias("good_id"), (crc_mod("doc_id", HELD) == 0).alias("held")).distinct()


def gram_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, raw, target): n-grams per bucket over all documents and over the trusted ones."""
    good = _trusted(labels).where(~F.col("held")).select("good_id")
    if good.count() <= BROADCAST_IDS:  # then the texts stay where they are
        ids = docs.sparkSession.sparkContext.broadcast(np.sort(good.toArrow().column(0).to_numpy()))
        marked = docs.select("text", F.col("doc_id").cast("long"))
    else:
        ids = None
        marked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("good_id"), "left").select("text", "good_id")

    def trusted(column: pa.Array) -> list[bool]:
        have = column.is_valid().to_numpy(zero_copy_only=False)
        if ids is None:
            return have.tolist()
        own, of = column.fill_null(0).to_numpy(zero_copy_only=False), ids.value
        at = np.minimum(np.searchsorted(of, own), max(len(of) - 1, 0))
        return (have & (of[at] == own)).tolist() if len(of) else [False] * len(own)

    def count(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for text, good in zip(b.column(0).to_pylist(), trusted(b.column(1)), strict=True):
                words = utf8(text).split()
                if words:
                    c = np.bincount(buckets(word_hashes(words)), minlength=BUCKETS) if len(words) > 4000 else None
                    at = None if c is not None else buckets(word_hashes(words))
                    for counts in (raw, target) if good else (raw,):
                        if c is not None:
                            counts += c
                        else:
                            np.add.at(counts, at, 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                         names=["bucket", "raw", "target"])

    counted = marked.mapInArrow(count, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit_ratio(counts: DataFrame) -> np.ndarray:
    """Log ratio per bucket; BUCKETS rows at most come to the driver."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    share = target.sum() / raw.sum()
    p = (target + PRIOR * share) / (target.sum() + PRIOR * share * BUCKETS)
    q = (raw + PRIOR) / (raw.sum() + PRIOR * BUCKETS)
    return np.log(p / q)


SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "score double")


def score(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base counts and the length-normalised log-likelihood ratio of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        weight = shared.value
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                data = utf8(text)
                words = data.split()
                if not words:
                    rows.append((0, 0, len(SYMBOLS.findall(text or "")), 0, 0, 0.0))
                    continue
                h = word_hashes(words)
                # code points: the bytes that don't continue one
                raw = np.frombuffer(b"".join(words), np.uint8)
                chars = int(((raw & 0xC0) != 0x80).sum())
                rows.append((len(words), chars, len(SYMBOLS.findall(text)), dup_lines(data), repeat_words(h),
                             float(weight[buckets(h)].mean())))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, SCORED)


def threshold(scored: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> float:
    """The least score that is kept, from the held-out trusted documents' counts by score bin."""
    good = _trusted(labels).where("held")
    bins = (scored.join(good, F.col("doc_id") == F.col("good_id")).where("n_words > 0")
            .groupBy(F.floor(F.col("score") / BIN).alias("bin")).count().orderBy("bin").collect())
    if not bins:
        return -math.inf
    at, n = (np.array([r[c] for r in bins], np.float64) for c in ("bin", "count"))
    mean = (at * n).sum() / n.sum()
    spread = math.sqrt((n * (at - mean) ** 2).sum() / n.sum())
    lowest = at[np.searchsorted(np.cumsum(n), (1 - keep_good) * n.sum(), side="right")]
    return float(lowest - spread) * BIN


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores, base verdict and verdict of each row of ``docs``."""
    scored = written(score(docs, fit_ratio(gram_counts(docs, labels))), "quality-scores")
    least = threshold(scored, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("score") >= F.lit(least))))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
