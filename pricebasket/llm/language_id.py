"""Language ID by interpolated Kneser-Ney character models.

Each language has a character model of order ``ORDER`` over its words (runs of
letters, lower-cased, with a start and an end mark), fitted from a bounded
sample of labelled documents.  The n-grams of all languages are 64-bit hashes
in one sorted array an order, with a column a language for the discounted
probability of the n-gram and for the weight that its context hands down.  A
text's language is that of the lowest cross-entropy a character; a second part
of the sample sets the scale of the score and how far from its language's usual
cross-entropy a text may be before it is rejected.

Defined results: NULL, empty and letterless texts are ``und`` with score 0 and
rejected; so is every text if there is nothing to learn from.  Of equal
cross-entropies the language first in alphabetical order wins.  Rows repeated
in the input get equal rows back; columns of the input with clashing names do
no harm.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import crc_mod, numbered, remembered, table, written

ORDER = 4
#: Labelled documents a language (expected number of a hash sample) that its model and calibration are fitted on.
SAMPLE_DOCS = 2000
#: One in so many sampled documents calibrates, the others train.
CALIBRATION = 5
#: Words remembered per worker, for one model at a time, and the longest one remembered.
CACHE_WORDS, CACHE_CHARS = 200_000, 40
#: A text is rejected if its cross-entropy is so many spreads of calibration documents above the usual,
#: above this quantile of theirs, and past this part of the way from the usual to that of a model that knows nothing.
REJECT_SPREADS, REJECT_QUANTILE, REJECT_WAY = 6.0, 99.9, 0.85
UNKNOWN = "und"
START, END = 0x110000, 0x110001
WORDS = re.compile(r"[^\W\d_]+")
_FACTOR = 0x9E3779B97F4A7C15


def _mix(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _grams(words: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of the words, each between its marks: position in the word, and for
    every order k the hashes of the k-gram that ends there and of its context;
    last, each character's word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    codes = np.zeros(total, np.int64)
    pos = np.arange(total) - np.repeat(starts, sizes)
    codes[(pos > 0) & (pos < np.repeat(sizes, sizes) - 1)] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    codes[starts] = START
    codes[starts + sizes - 1] = END
    mixed = _mix(codes)
    hashes, power = [np.zeros(total, np.uint64)], 1
    for k in range(1, ORDER + 1):
        h = hashes[-1].copy()
        h[k - 1:] += mixed[: total - k + 1] * np.uint64(power)
        hashes.append(h)
        power = power * _FACTOR % (1 << 64)
    contexts = [np.concatenate([np.zeros(1, np.uint64), h[:-1]]) for h in hashes[:-1]]
    return pos, hashes[1:], contexts, np.repeat(np.arange(len(words)), sizes)


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sums of their values, a place of each."""
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0])) if len(keys) else np.zeros(0, int)
    return keys[order[at]], np.add.reduceat(values[order], at) if len(at) else values[:0], order[at]


def fit_language(counts: dict[str, int]) -> list[tuple[np.ndarray, ...]]:
    """Per order: sorted hashes of the n-grams and their discounted
    probabilities, sorted hashes of the contexts and their weights.  Lower
    orders count the distinct characters before an n-gram, except those that
    start a word, which nothing precedes."""
    words = sorted(counts)
    pos, hashes, contexts, word = _grams(words)
    times = np.array([counts[w] for w in words], np.float64)[word]
    model = []
    for k in range(1, ORDER + 1):
        here = np.flatnonzero(pos >= max(1, k - 1))
        if k < ORDER:
            inner = here[pos[here] >= k]  # a longer n-gram ends here too
            _, _, place = _sum_by(hashes[k][inner], np.ones(len(inner)))
            first = here[pos[here] == k - 1]  # starts with the word's mark
            at = np.concatenate([inner[place], first])
            weight = np.concatenate([np.ones(len(place)), times[first]])
        else:
            at, weight = here, times[here]
        keys, sums, place = _sum_by(hashes[k - 1][at], weight)
        of = contexts[k - 1][at][place]
        ones, twos = (sums == 1).sum(), (sums == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        ctx, total, _ = _sum_by(of, sums)
        kinds = _sum_by(of, np.ones(len(of)))[1]
        probability = np.maximum(sums - discount, 0) / total[np.searchsorted(ctx, of)]
        model.append((keys, probability, ctx, discount * kinds / total))
    return model


class _KnownWords:
    """Scores of the words that a worker has met."""

    def __init__(self, model: LanguageModels):
        self.model, self.rows, self.logs = model, {}, np.zeros((0, len(model.langs)))


def _known_words(model: LanguageModels) -> _KnownWords:
    """The worker's one table, afresh for another model or when it is full."""
    own = remembered("language_id")
    known = own.get("known")
    if known is None or known.model is not model or len(known.logs) > CACHE_WORDS:
        known = own["known"] = _KnownWords(model)
    return known


class LanguageModels:
    """The models of all languages over shared sorted hash arrays."""

    def __init__(self, fitted: dict[str, list[tuple[np.ndarray, ...]]]):
        self.langs = sorted(fitted)
        self.orders = []
        for k in range(ORDER if fitted else 0):
            both = []
            for part, missing in ((0, 0.0), (2, 1.0)):
                keys = np.unique(np.concatenate([fitted[x][k][part] for x in self.langs]))
                cells = np.full((len(keys), len(self.langs)), missing, np.float32)
                for j, x in enumerate(self.langs):
                    cells[np.searchsorted(keys, fitted[x][k][part]), j] = fitted[x][k][part + 1]
                both += [keys, cells]
            self.orders.append(both)
        # what the unigrams leave is spread over the letters seen in any language and one for all others
        self.floor = 1.0 / (len(self.orders[0][0]) + 1) if fitted else 1.0
        self.scale, self.usual = 1.0, {}

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Natural log probability of each word and its end mark, a column a language."""
        out = np.zeros((len(words), len(self.langs)))
        start = 0
        while start < len(words):  # long words alone, short ones together
            stop, chars = start + 1, len(words[start])
            while stop < len(words) and chars + len(words[stop]) + 2 < 200_000:
                chars += len(words[stop]) + 2
                stop += 1
            out[start:stop] = self._logs(words[start:stop])
            start = stop
        return out

    def _logs(self, words: list[str]) -> np.ndarray:
        pos, hashes, contexts, word = _grams(words)
        here = pos > 0
        p = np.full((len(pos), len(self.langs)), self.floor)
        for k, (keys, probability, ctx, weight) in enumerate(self.orders):
            at = np.flatnonzero(here & (pos >= k))
            i = np.minimum(np.searchsorted(ctx, contexts[k][at]), len(ctx) - 1)
            known = ctx[i] == contexts[k][at]
            at, i = at[known], i[known]
            g = np.minimum(np.searchsorted(keys, hashes[k][at]), len(keys) - 1)
            seen = (keys[g] == hashes[k][at])[:, None]
            p[at] = p[at] * weight[i] + np.where(seen, probability[g], 0)
        logs = np.where(here[:, None], np.log(np.maximum(p, 1e-12)), 0)
        return np.add.reduceat(logs, np.flatnonzero(np.concatenate([[True], np.diff(word) != 0])), axis=0)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: cross-entropy a character in each language, and the
        characters (letters and word ends) it is over; 0 without letters."""
        known = _known_words(self)
        rows, fresh, lists = known.rows, [], []
        base = len(known.logs)
        for text in texts:
            words = WORDS.findall((text or "").lower())
            if not any(c.isalpha() for w in words for c in w):
                words = []
            own = []
            for w in words:
                r = rows.get(w)
                if r is None:
                    r = base + len(fresh)
                    fresh.append(w)
                    if len(w) <= CACHE_CHARS:
                        rows[w] = r
                own.append(r)
            lists.append((own, sum(map(len, words)) + len(words)))
        logs = np.concatenate([known.logs, self.word_logs(fresh)]) if fresh else known.logs
        h, chars = np.zeros((len(texts), len(self.langs))), np.array([n for _, n in lists], np.float64)
        for i, (own, n) in enumerate(lists):
            if n:
                h[i] = -logs[own].sum(0) / n
        known.logs = logs
        return h, chars

    def calibrate(self, h: np.ndarray, chars: np.ndarray, truth: list[str]) -> None:
        """Scale of the score and usual cross-entropies, from labelled texts."""
        if not len(h):
            return
        right = np.array([self.langs.index(t) if t in self.langs else -1 for t in truth])
        ok = (right >= 0) & (chars > 0)
        h, chars, right = h[ok], chars[ok], right[ok]
        best = -np.inf
        for scale in 2.0 ** np.arange(-3, 6):
            p = self._softmax(h, chars, scale)[np.arange(len(h)), right]
            fit = np.log(np.maximum(p, 1e-9)).sum()
            if fit > best:
                best, self.scale = fit, float(scale)
        for j, lang in enumerate(self.langs):
            own = right == j
            if own.any():
                x, n = h[own, j], chars[own]
                mean = float(np.median(x))
                spread = max(0.02, float(np.percentile(np.abs(x - mean)[n >= np.median(n)], 68)))
                short = max(0.5, float(np.percentile(np.abs(x - mean) * np.sqrt(n), 68)))
                least = max(mean + REJECT_WAY * (-np.log(self.floor) - mean), float(np.percentile(x, REJECT_QUANTILE)))
                self.usual[lang] = (mean, spread, short, least)

    @staticmethod
    def _softmax(h, chars, scale):
        z = -h * scale * np.sqrt(chars)[:, None]
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, list[bool]]:
        """Language, score and whether the text is rejected."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), [True] * len(texts)
        h, chars = self.entropies(texts)
        p = self._softmax(h, chars, self.scale)
        best = h.argmin(1)
        langs, score, reject = [], np.zeros(len(texts)), []
        for i, j in enumerate(best):
            if not chars[i]:
                langs.append(UNKNOWN)
                reject.append(True)
                continue
            lang = self.langs[j]
            langs.append(lang)
            score[i] = p[i, j]
            mean, spread, short, least = self.usual.get(lang, (0.0, 0.0, 0.0, np.inf))
            reject.append(bool(h[i, j] > max(least, mean + REJECT_SPREADS * (spread + short / np.sqrt(chars[i])))))
        return langs, score, reject


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int) -> DataFrame:
    """(lang, text, calibrates): about ``per_lang`` labelled training documents
    a language, chosen by a hash of the id; written."""
    labelled = docs.where((crc_mod(id_col, 3) != 1) & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = labelled.groupBy(F.col(lang_col).alias("lang")).count().collect()  # a row a language
    unit = 1 << 30
    limit = F.lit(0)
    for r in sizes:
        limit = F.when(F.col(lang_col) == r["lang"], F.lit(min(unit, unit * per_lang // r["count"]))).otherwise(limit)
    chosen = labelled.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("lang")), F.lit(unit)) < limit)
    return written(chosen.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit("part")), F.lit(CALIBRATION)) == 0).alias("calibrates")), "lang-sample")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = SAMPLE_DOCS) -> LanguageModels:
    """Models from the labelled documents whose crc32(id) mod 3 is not 1."""
    sample = _sample(docs, id_col, text_col, lang_col, per_lang)
    schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])

    def count(batches):
        kind = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
        seen = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.update((lang, w) for w in WORDS.findall((text or "").lower()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in seen], pa.string()), pa.array([x[1] for x in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], schema=kind)

    def fit(t: pa.Table) -> pa.Table:
        counts = dict(zip(t.column("word").to_pylist(), t.column("n").to_pylist(), strict=True))
        lang = t.column("lang")[0].as_py()
        rows = [(lang, k, i, a.tobytes()) for k, order in enumerate(fit_language(counts)) for i, a in enumerate(order)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    words = (sample.where("not calibrates").select("lang", "text").mapInArrow(count, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    fitted: dict[str, list] = {}
    for r in words.groupBy("lang").applyInArrow(fit, "lang string, k int, part int, data binary").collect():
        order = fitted.setdefault(r["lang"], [[None] * 4 for _ in range(ORDER)])
        order[r["k"]][r["part"]] = np.frombuffer(r["data"], np.float64 if r["part"] % 2 else np.uint64)
    models = LanguageModels(fitted)
    if fitted:
        shared = docs.sparkSession.sparkContext.broadcast(models)

        def score(batches):
            for b in batches:
                h, chars = shared.value.entropies(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(h)), pa.array(chars)], names=["lang", "h", "chars"])

        rows = (sample.where("calibrates").select("lang", "text")
                .mapInArrow(score, "lang string, h array<double>, chars double").orderBy("lang", "chars", "h").collect())
        models.calibrate(np.array([r["h"] for r in rows]), np.array([r["chars"] for r in rows]), [r["lang"] for r in rows])
    return models


def predict(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for b in batches:
            lang, score, rejected = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows that the models reject."""
    names = docs.columns
    rows = numbered(docs)
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for b in batches:
            rejected = shared.value.predict(b.column(at).to_pylist())[2]
            yield b.filter(pa.array([not x for x in rejected], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*names)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
