"""Toxicity by multiple-instance learning: sentences are scored, documents labelled.

A sentence's score is the logistic of ``BIAS`` and the sum of its distinct words'
weights.  A word (lower-cased, cut to letters and digits) weighs as much as its
features: the word itself and its first letters, hashed into ``FEATURES`` buckets.  A document is toxic if any sentence is: noisy-or over its sentences,
1 - prod(1 - p), and over one leak term for labels that no sentence explains.
The weights are trained in numpy from document labels alone
by gradient steps on the noisy-or likelihood, over a bounded hash sample of the
labelled training documents; what is learned locates the offending sentences.
No weight is under zero: harmless words cannot cancel a telling one, however long
the sentence.  A weight starts at, and decays to, the lower bound of its feature's
log odds ratio between toxic and clean documents, so that a word that mostly occurs
beside other telling words, which explain its documents already, tells alone too.

Defined results: NULL and empty texts have no sentence and score 0.  Rows
repeated in the input get equal rows back.  Labels given more than once for a
document count once, toxic if any says so; NULL labels and NULL ids teach nothing.
Without a toxic and a clean training document every score is 0.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import crc_mod, table, written

FEATURES = 1 << 18
#: Numbers of first letters that are a feature of a longer word.
HEADS = (3, 4, 5)
#: Training documents of each label (expected number of a hash sample), each with all its sentences.
SAMPLE_DOCS = 3000
#: LEAST_SLOPE damps the weights of rare words; RIDGE, weight decay, shares a document among the words that explain it.
STEPS, RATE, RIDGE, LEAST_SLOPE = 300, 0.3, 5e-4, 3e-3
#: Standard errors between a feature's log odds ratio and the lower bound that its weight starts at.
ERRORS = 2.0
#: A sentence without a telling word: so unlikely to offend that a text of any length stays clean.
BIAS, FIRST_BIAS = -10.0, -5.0
#: Weights under this size are left out of the model.
LEAST_WEIGHT = 0.05
CACHE_WORDS = 250_000
SENTENCES = re.compile(r"[^.!?\n]+[.!?]*")
WORDS = re.compile(r"[^\W_]+")


def features(word: str) -> list[int]:
    parts = [word, *("^" + word[:k] for k in HEADS if len(word) > k)]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 11) % FEATURES for p in parts]


class Instances:
    """Sentences of training documents as sparse rows: the label and weight of
    each document, the document of each sentence, sentence and feature of each word."""

    def __init__(self, labels: np.ndarray, weights: np.ndarray, doc: np.ndarray, row: np.ndarray, col: np.ndarray):
        self.labels, self.share, self.doc, self.row, self.col = labels, weights / weights.sum(), doc, row, col

    def _bounds(self, col: np.ndarray, n: int) -> np.ndarray:
        """The lower bound of each feature's log odds ratio between toxic and clean documents, 0 at least."""
        toxic = self.labels > 0
        feature, doc = np.divmod(np.unique(col.astype(np.int64) * len(toxic) + self.doc[self.row]), len(toxic))
        hit, miss = (np.bincount(feature[toxic[doc] == y], minlength=n) + 0.5 for y in (True, False))
        ratio = np.log(hit / (toxic.sum() + 1)) - np.log(miss / ((~toxic).sum() + 1))
        return np.maximum(ratio - ERRORS * np.sqrt(1 / hit + 1 / miss), 0)

    def fit(self) -> tuple[np.ndarray, float]:
        """Weights and leak by Adam with weight decay on the noisy-or likelihood: with A the sum of softplus(z) over a document's sentences
        and the leak, a clean document costs A and a toxic one -log(1 - exp(-A))."""
        used, col = np.unique(self.col, return_inverse=True)
        n, start = len(self.doc), self._bounds(col, len(used))
        w = np.append(start, -4.0)  # the last one: the leak
        m, v = np.zeros_like(w), np.zeros_like(w)
        toxic = self.labels > 0
        for step in range(1, STEPS + 1):
            # the bias goes down step by step, so that words learn to stand out before it is out of reach
            z = np.bincount(self.row, w[col], n) + max(BIAS, FIRST_BIAS + (BIAS - FIRST_BIAS) * step / (0.6 * STEPS))
            total = np.bincount(self.doc, np.logaddexp(0, z), len(self.labels)) + np.logaddexp(0, w[-1])
            slope = np.where(toxic, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0) * self.share
            g = _logistic(z) * slope[self.doc]
            grad = np.append(np.bincount(col, g[self.row], len(used)), slope.sum() * _logistic(w[-1]))
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
            w -= RATE * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.99 ** step)) + LEAST_SLOPE)
            w[:-1] = np.maximum(w[:-1] - RIDGE * (w[:-1] - start), 0)
        out = np.zeros(FEATURES)
        out[used] = np.where(w[:-1] >= LEAST_WEIGHT, w[:-1], 0)
        return out, float(w[-1])


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: Weights of the words that a worker has met, for one model at a time.
_known: tuple[ToxicityModel | None, dict[str, float]] = (None, {})


def _known_words(model: ToxicityModel) -> dict[str, float]:
    global _known
    if _known[0] is not model:
        _known = (model, {})
    return _known[1]


class ToxicityModel:
    def __init__(self, weights: np.ndarray, leak: float):
        at = np.flatnonzero(weights)
        self.weights = dict(zip(at.tolist(), weights[at].tolist(), strict=True))
        self.leak = leak

    def _weight(self, word: str) -> float:
        w = sum(self.weights.get(f, 0.0) for f in features(word))
        if len(word) <= 40:
            known = _known_words(self)
            if len(known) >= CACHE_WORDS:
                known.clear()
            known[word] = w
        return w

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences of the text and the leak, and (start, end,
        logit) of each sentence with a word."""
        found = []
        for s in SENTENCES.finditer(text or ""):
            words = WORDS.findall(s.group().lower())
            if words:
                found.append((s.start(), s.end(), self._logit(words)))
        if not found:
            return 0.0, found
        logits = [z for *_, z in found]
        return float(-np.expm1(-np.logaddexp(0, [*logits, self.leak]).sum())), found

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence with a word."""
        return [(a, b, float(_logistic(z))) for a, b, z in self.judge(text)[1]]

    def score(self, text: str | None) -> float:
        return self.judge(text)[0]

    def _logit(self, words: list[str]) -> float:
        known, z = _known_words(self), BIAS
        for w in set(words):
            x = known.get(w)
            z += self._weight(w) if x is None else x
        return z


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          per_label: int = SAMPLE_DOCS) -> ToxicityModel | None:
    """The model from labelled documents whose crc32(id) mod 5 is not 0; None
    without documents of both labels."""
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 5) != 0))
             .groupBy(F.col("doc_id").alias("of_id")).agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    unit = 1 << 30
    limit = {y: min(unit, unit * per_label // max(1, sizes.get(y, 0))) for y in (True, False)}
    chosen = marks.where(F.pmod(F.xxhash64("of_id", F.lit("tox")), F.lit(unit)) <
                         F.when(F.col("toxic") > 0, F.lit(limit[True])).otherwise(F.lit(limit[False])))
    # at most about 2 * per_label ids: the sample's bound is the broadcast's
    texts = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                    .join(F.broadcast(chosen), F.col("id") == F.col("of_id")).select("id", "toxic", "text"), "tox-sample")

    def split(batches):
        for b in batches:
            rows = []
            for i, y, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = [[f for w in sorted(set(WORDS.findall(s))) for f in features(w)] for s in SENTENCES.findall((text or "").lower())]
                rows.append((i, int(y > 0), [f for f in found if f]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.list_(pa.int32())))], names=["id", "y", "s"])

    # the sample's features: some ten MB at most per thousand documents
    rows = texts.mapInArrow(split, "id long, y int, s array<array<int>>").orderBy("id", "s").toArrow().combine_chunks()
    labels = rows.column("y").to_numpy()
    if len(set(labels.tolist())) < 2:
        return None
    sentences = rows.column("s").combine_chunks()
    words = sentences.flatten()
    doc = np.repeat(np.arange(len(labels)), pc.list_value_length(sentences).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(doc)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    # each label counts as in all labelled documents, however many of it were sampled
    sampled = np.bincount(labels, minlength=2)
    weights = np.array([sizes[False] / sampled[0], sizes[True] / sampled[1]])[labels]
    return ToxicityModel(*Instances(labels, weights, doc, row, words.flatten().to_numpy()).fit())


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text",
          locate: bool = False) -> DataFrame:
    """(doc_id, score) per row; with ``locate`` also ``offending``, the spans
    (start, end, probability) of the sentences of probability 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
    kind = "doc_id long, score double"
    if locate:
        kind += ", offending array<struct<start:int,end:int,probability:double>>"

    def run(batches):
        m = shared.value
        for b in batches:
            judged = [m.judge(t) if m else (0.0, []) for t in b.column(1).to_pylist()]
            cols = [b.column(0).cast(pa.int64()), pa.array([x for x, _ in judged], pa.float64())]
            if locate:
                cols.append(pa.array([[{"start": i, "end": j, "probability": float(_logistic(z))} for i, j, z in found if z >= 0]
                                      for _, found in judged], span))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "offending"][: len(cols)])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, kind)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), locate=True)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
