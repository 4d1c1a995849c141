"""Target-distribution importance resampling: weights scored from one array,
the best scores found by a distributed LSD radix sort.

Features are runs of 1 to 3 words, hashed to ``BUCKETS`` buckets.  Each task
counts its documents' buckets into one array; the summed arrays of the corpus
and of the target give every bucket's gain, and a document's weight is the sum
of the gains at its features' buckets, one array look-up.  A score adds Gumbel
noise hashed from the doc_id, so the highest scores are a draw without
replacement in proportion to exp(weight / 1000).

``radix_ranks`` sorts rows of any number by digits of a composite key, least
significant first.  A pass is a stable counting sort: rows lie in blocks of
``BLOCK`` places; each block counts its digits and numbers its rows within a
digit; the prefix sum of all counts by (digit, block) is where each block's
rows of a digit begin, so offset + number is a row's place for the next pass.
No pass compares keys, and no task sees more than a block.

Defined results: a NULL or empty text, or one without words, has no features
and weight zero; repeated rows are scored and drawn each for itself; a NULL
doc_id draws as the text 'null' and ranks after every other of its score; rows
equal in every column tie, in any order; with no documents, or fewer than
100 / ``percent`` of enough words, nothing is drawn.  An empty target gives every
bucket the gain of no evidence.  Columns of the input that aren't named as id
or text take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.llm.common import table, utf8, written

BUCKETS, MAX_WORDS = 10_000, 3
SEED = 42
#: Documents with fewer words are scored, but never drawn.
MIN_WORDS = 20
#: Drawn documents of 100 that have enough words.
PERCENT = 5
#: Bits of a digit, and rows of a block: a block of rows is what one task sorts at once.
DIGIT_BITS, BLOCK = 16, 1 << 18
#: Features hashed at once (a longer text is hashed in parts).
PART_WORDS = 1 << 20
#: A-Z to a-z; other ASCII than digits and a-z to blanks.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8, A-Z lower-cased."""
    return utf8(text).translate(WORD_BYTES).split()


def buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to MAX_WORDS words, in parts.  The crc32 of a run
    goes on from that of the run without its last word."""
    for at in range(0, len(words), PART_WORDS):
        part = words[at:at + PART_WORDS + MAX_WORDS - 1]
        starts = min(PART_WORDS, len(words) - at)
        sums = list(map(crc32, part[:starts]))
        yield np.fromiter(sums, np.uint32, len(sums)) % BUCKETS
        for n in range(1, MAX_WORDS):
            spaced = [b" " + w for w in part[n:n + starts]]
            sums = list(map(crc32, spaced, sums))
            yield np.fromiter(sums, np.uint32, len(sums)) % BUCKETS


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features of all texts per bucket.  A task sends one array, however many texts it has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            held, size = [], 0
            for text in b.column(0).to_pylist():
                for found in buckets(words_of(text)):
                    held.append(found)
                    size += len(found)
                if size >= PART_WORDS:
                    total += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sums = texts.select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of the smoothed share in the target over that in the corpus)."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight), a row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                n, total = 0, 0
                for found in buckets(words):
                    n += len(found)
                    total += int(gain[found].sum())
                done.append((len(words), n, total))
            cols = np.array(done, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *map(pa.array, cols)], schema=schema)

    return docs.select(id_col, text_col).mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int, doc_id: Column) -> Column:
    """floor(1000 times a Gumbel number) of 32 hashed bits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _digits(keys: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(column, least value, shift) of every digit that can differ, least significant first."""
    out = []
    for name, least, most in keys:
        bits = (most - least).bit_length()
        out += [(name, least, shift) for shift in range(0, bits, DIGIT_BITS)]
    return out


def _numbered_in_block(rows: DataFrame, column: str, least: int, shift: int, block: int) -> DataFrame:
    """``rows`` (place, ...) with block, digit and nth: the number of a row among
    its block's rows of that digit, in the order of their places."""
    names = rows.columns

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place", kind="stable")
        # in unsigned arithmetic, as a key may span all of 64 bits
        key = part[column].to_numpy(np.int64).view(np.uint64) - np.uint64(least % (1 << 64))
        digit = ((key >> np.uint64(shift)) & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64)
        counts = np.bincount(digit, minlength=1 << DIGIT_BITS)
        order = np.argsort(digit, kind="stable")  # a counting sort: digits are small integers
        nth = np.empty(len(part), np.int64)
        nth[order] = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)
        return part.assign(digit=digit, nth=nth)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    blocked = rows.withColumn("block", F.expr(f"place div {block}"))
    return blocked.groupBy("block").applyInPandas(sort, f"{types}, block long, digit long, nth long").select(
        *names, "block", "digit", "nth")


def _offsets(numbered_rows: DataFrame) -> DataFrame:
    """(digit, block, first): the place where a block's rows of a digit begin.
    Within a digit the prefix runs over the blocks; over the digits, of which
    there are ``2 ** DIGIT_BITS`` at most, the totals are added up first."""
    counts = numbered_rows.groupBy("digit", "block").agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n")).toPandas().sort_values("digit")
    base = totals.assign(base=totals["n"].cumsum() - totals["n"])[["digit", "base"]]
    small = numbered_rows.sparkSession.createDataFrame(base.astype("int64"), "digit long, base long")
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(F.broadcast(small), "digit").select(
        "digit", "block", (F.col("base") + F.col("before")).alias("first"))


def radix_ranks(rows: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """``rows`` with ``place``: its place from 0 in ascending order of the long,
    non-null columns ``keys``, the least significant named first."""
    spans = rows.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    digits = _digits([(k, spans[f"min_{k}"], spans[f"max_{k}"]) for k in keys if spans[f"min_{k}"] is not None])
    names = rows.columns
    # any first order will do, if it is one order: the rows are read back from a written table.
    # Its places have gaps, so one pass over a constant digit closes them if no key differs.
    at = written(rows.withColumn("place", F.monotonically_increasing_id()), "radix-rows")
    for column, least, shift in digits or [("place", 0, 63)]:
        numbered_rows = written(_numbered_in_block(at, column, least, shift, block), "radix-pass")
        first = _offsets(numbered_rows)
        at = numbered_rows.join(first, ["digit", "block"]).select(
            *names, (F.col("first") + F.col("nth")).alias("place"))
    return at


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), a row per row of
    ``docs``; ``rank`` is NULL for those that aren't drawn."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    scored = written(weights(docs, gain, id_col, text_col).withColumn(
        "score", F.col("weight") + noise(seed, F.col("doc_id"))), "resample-scored")
    enough = F.col("n_words") >= min_words
    # highest scores first; no id sorts last; the rest of the row makes the order total
    keyed = scored.where(enough).withColumns({
        "by_score": -F.col("score"), "by_no_id": F.col("doc_id").isNull().cast("long"),
        "by_id": F.coalesce("doc_id", F.lit(0)), "by_rest": F.col("n_features")})
    placed = radix_ranks(keyed, ["by_rest", "by_id", "by_no_id", "by_score"], block)
    drawn = percent * scored.where(enough).count() // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    cols = ["doc_id", "n_words", "n_features", "weight", "score"]
    return placed.select(*cols, rank.alias("rank")).unionByName(
        scored.where(~enough).select(*cols, F.lit(None).cast("long").alias("rank")))


def op12_importance(spark, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
