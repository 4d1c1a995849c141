"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

The vocabulary is a tree of two levels, so the softmax over it is exact.  Below
the root lie about as many classes as the square root of the number of modelled
words (``Tree``): the end of text, the most frequent words, one class each, and
classes of the other words by their last letters.  In a class lie its modelled
words and one leaf for its rare words, which share it by their counts, smoothed
by one; a word never seen in training is one more of them.

The model is log-bilinear in three context symbols: the classes of the two words
before, and the topic of the text so far, one of ``TOPICS``.  The context's
vector is the sum of their vectors, weighted by position; a class's logit is its
vector times that, plus its bias.  In a class, a word's logit is its vector times
the topic's, plus the logarithm of its share of the class.  All vectors are
trained in numpy by noise-contrastive estimation: every training token is told
from classes drawn from the unigram distribution, or words drawn from its class.
Each task goes through its part of the text, and the tasks' vectors are averaged
by how much they have seen.  Batched matrix products give the tables of
exponentials from which a text's normalised log-probabilities are read.

Documents are packed into chunks of about ``CHUNK_TOKENS`` tokens, as numbers
into the chunk's own word list.  Counts go the way of the words: per chunk and
word one row is summed, and one comes back to the chunk; the most frequent
words' counts are broadcast instead, so no word floods a task.  What is counted
and trained grows with the text; memory for the tree is bounded by
``BROADCAST_WORDS`` modelled words, beyond which words are rare.

Defined results: NULL, empty and blank texts have only the end token.  A NULL
doc_id trains and is not held out.  Rows repeated in the input count as often as they occur.
Without training text every base score is 0 and classes are equally likely.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import crc_mod, table, written

MARKS = b".,;:!?\"'()[]"
#: Class 0 is the end of text, and stands for what is before a text.
END, LEAST_CLASSES = 0, 8
CHUNK_TOKENS = 1_000_000
#: Bytes of text whose words are held at once (a longer text is held alone).
PART_BYTES = 4_000_000
#: Words that have a leaf of their own and whose counts are broadcast (about 150 bytes each).
BROADCAST_WORDS = 100_000
#: Topics, and tokens between two looks at a text's topic.
TOPICS, TOPIC_TOKENS = 8, 16
VECTOR, SEED, RATE = 16, 5, 0.1
#: Tokens of a step, noise draws that a step's tokens share, and noise words drawn for each token from its class.
STEP, NOISE, WORD_NOISE = 8192, 64, 2
#: Steps of the words' vectors over a task's counts.
WORD_STEPS = 40
#: A task of fewer tokens goes through them several times, up to so many in all.
LEAST_TRAINED = 200_000
CHUNK_KIND = ("chunk long, ids array<long>, held binary, sizes binary, codes binary, words array<binary>, "
              "endings binary, counts array<int>")


def ending(word: bytes) -> int:
    """A hash of the last two letters without punctuation."""
    last = word.strip(MARKS)[-8:]
    two = last[-2:]
    return zlib.crc32(two if two.isascii() else last.decode("utf-8", "replace")[-2:].encode("utf-8")) >> 1


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, as ``words_of`` has them, and how many each text has."""
    # copied: of a slice, Arrow's ascii_lower takes the wrong bytes
    own = texts.cast(pa.large_string()).fill_null("").take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(own))
    words, of = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.not_equal(pc.binary_length(words), 0)  # blanks at an end of a text leave an empty one
    words, of = words.filter(some), of.filter(some)
    return words.cast(pa.large_binary()), np.bincount(of.to_numpy(), minlength=len(texts))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """Documents as word numbers, a row a chunk: ids, held-out flags and sizes
    of its documents, their words' codes (int32), the chunk's distinct words,
    their endings and how often each occurs in its training documents; written."""

    def pack(batches):
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        ids, flags, sizes, parts, tokens = [], [], [], [], 0

        def chunk():
            nonlocal n, ids, flags, sizes, parts, tokens
            coded = pa.concat_arrays(parts).dictionary_encode()
            codes, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
            held, size = np.concatenate(flags), np.concatenate(sizes)
            counts = np.bincount(codes[np.repeat(~held, size)], minlength=len(words))
            endings = np.fromiter(map(ending, words.to_pylist()), np.int32, len(words))
            row = [(task << 24) + n, np.concatenate(ids), held.astype(np.uint8).tobytes(), size.astype(np.int32).tobytes(),
                   _planes(codes), None, endings.tobytes(), counts.astype(np.int32)]
            n, ids, flags, sizes, parts, tokens = n + 1, [], [], [], [], 0
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.int32())]
            cols = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            cols[5] = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "ids", "held", "sizes", "codes", "words", "endings", "counts"])

        for batch in batches:
            part = np.cumsum(pc.binary_length(batch.column(2)).fill_null(0).to_numpy().astype(np.int64)) // PART_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for b in (batch.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)):
                words, size = split_words(b.column(2))
                row_ids, held = (c.to_pylist() for c in b.columns[:2])
                ends, lo, first = np.cumsum(size), 0, 0
                while lo < len(size):
                    # the text that fills the chunk is its last
                    hi = min(len(size), lo + int(np.searchsorted(np.cumsum(size[lo:] + 1), CHUNK_TOKENS - tokens)) + 1)
                    last = int(ends[hi - 1])
                    ids.append(np.array(row_ids[lo:hi], object))
                    flags.append(np.array(held[lo:hi], bool))
                    sizes.append(size[lo:hi])
                    parts.append(words.slice(first, last - first))
                    tokens += last - first + hi - lo
                    lo, first = hi, last
                    if tokens >= CHUNK_TOKENS:
                        yield chunk()
        if ids:
            yield chunk()

    rows = docs.select(F.col(id_col), F.coalesce(crc_mod(id_col, modulus) == held, F.lit(False)), F.col(text_col))
    return written(rows.mapInArrow(pack, CHUNK_KIND), "lm-chunks")


def word_counts(packed: DataFrame) -> DataFrame:
    """(word, c): the training count of every word of the training text; written."""
    pairs = packed.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        F.col("x.words").alias("word"), F.col("x.counts").alias("n")).where("n > 0")
    return written(pairs.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")


def frequent_words(counts: DataFrame, most: int = BROADCAST_WORDS) -> dict[bytes, int]:
    """The words of the highest counts, ``most`` at most: those from the lowest
    step of a logarithmic scale on which so few words lie (a top-k would send the
    driver k rows from every task)."""
    step = F.floor(F.log("c") * 16)
    steps = counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect()
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            break
        least = r["s"]
    if least is None:
        return {}
    return {bytes(r["word"]): r["c"] for r in counts.where(step >= least).collect()}


def _planes(codes: np.ndarray) -> bytes:
    """int32 codes byte plane by byte plane: mostly small numbers, so the upper planes compress to little."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)


def _rows(batch: pa.RecordBatch):
    """Its rows, the words of each as they lie in Arrow's memory."""
    for i in range(batch.num_rows):
        yield {k: c[i].values if k == "words" else c[i].as_py() for k, c in zip(batch.schema.names, batch.columns, strict=True)}


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["held"], np.uint8).astype(bool), np.frombuffer(row["sizes"], np.int32).astype(np.int64),
            _from_planes(row["codes"]))


def _with_ends(values: np.ndarray, sizes: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Token values with an end after each text, and the texts' starts."""
    starts = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int((sizes + 1).sum()), end, values.dtype)
    inside = np.ones(len(out), bool)
    inside[starts + sizes] = False
    out[inside] = values
    return out, starts


def contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; END stands before a text."""
    one = np.concatenate([[END], classes[:-1]]).astype(np.int64)
    one[starts] = END
    two = np.concatenate([[END], one[:-1]])
    two[starts] = END
    return one, two


class Tree:
    """Classes and leaves of the vocabulary.

    ``leaf`` numbers the modelled words, those of a class in a row: class ``k``
    has the leaves from ``first[k]`` to before ``first[k + 1]``."""

    def __init__(self, frequent: dict[bytes, int]):
        n = max(LEAST_CLASSES, math.ceil(math.sqrt(len(frequent))))
        by_count = sorted(frequent, key=lambda w: (-frequent[w], w))
        self.n_top = min(n // 2, len(by_count))
        self.n_shared = n - self.n_top
        self.n = 1 + n
        self.top = {w: i + 1 for i, w in enumerate(by_count[:self.n_top])}
        of = {w: self.class_of(w) for w in by_count}
        words = sorted(by_count, key=lambda w: (of[w], -frequent[w], w))
        self.leaf = {w: i for i, w in enumerate(words)}
        self.modelled = pa.array(words, pa.binary())
        self.leaf_class = np.array([of[w] for w in words], np.int64)
        self.leaf_count = np.array([frequent[w] for w in words], np.int64)
        self.first = np.searchsorted(self.leaf_class, np.arange(self.n + 1))

    def class_of(self, word: bytes) -> int:
        """A top word's own class, or one of the shared classes by its ending."""
        return self.top.get(word) or 1 + self.n_top + ending(word) % self.n_shared

    def classes(self, leaves: np.ndarray, endings: np.ndarray) -> np.ndarray:
        """The same for words given by their leaves and endings."""
        out = 1 + self.n_top + endings.astype(np.int64) % self.n_shared
        own = leaves >= 0
        out[own] = self.leaf_class[leaves[own]]
        return out

    def leaves(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """Leaf of each word, -1 for a rare one."""
        at = pc.index_in(words if isinstance(words, pa.Array) else pa.array(words, pa.binary()), value_set=self.modelled)
        return at.fill_null(-1).to_numpy().astype(np.int64)

    def fill(self, tokens: np.ndarray, distinct: np.ndarray, ends: int) -> None:
        """Shares by counts: ``tokens`` and ``distinct`` words of training by class."""
        self.ends = ends
        self.tokens, self.distinct = tokens.copy(), distinct.copy()
        self.tokens[END] = ends
        self.total = int(self.tokens.sum())
        self.vocabulary = int(distinct.sum()) + int(ends > 0)
        self.unigram = (self.tokens + 1) / (self.total + self.n)
        of_leaves = np.bincount(self.leaf_class, self.leaf_count, self.n)
        n_leaves = np.diff(self.first)
        # rare words of a class: their counts, each and a word not seen smoothed by one
        self.rare_size = tokens - of_leaves + distinct - n_leaves + 1
        whole = tokens + distinct + 1
        single = np.arange(self.n) <= self.n_top
        self.rare_share = np.where(single, 0.0, self.rare_size / whole)
        self.leaf_share = np.where(single[self.leaf_class], 1.0, (self.leaf_count + 1) / whole[self.leaf_class])


def class_totals(counts: DataFrame, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words by class, a row a class and task."""
    def count(batches):
        tokens, distinct = np.zeros(tree.n, np.int64), np.zeros(tree.n, np.int64)
        for b in batches:
            words = b.column(0).to_pylist()
            of = tree.classes(tree.leaves(words), np.fromiter(map(ending, words), np.int64, len(words)))
            tokens += np.bincount(of, b.column(1).to_numpy(), tree.n).astype(np.int64)
            distinct += np.bincount(of, minlength=tree.n)
        at = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(tokens[at]), pa.array(distinct[at])], names=["class", "c", "n"])

    found = counts.select("word", "c").mapInArrow(count, "class long, c long, n long").groupBy("class").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"))
    tokens, distinct = np.zeros(tree.n, np.int64), np.zeros(tree.n, np.int64)
    for r in found.collect():
        tokens[r["class"]], distinct[r["class"]] = r["c"], r["n"]
    return tokens, distinct


def _training(row: dict, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes and leaves of a chunk's training tokens with their ends, and the texts' starts."""
    held, sizes, codes = _arrays(row)
    codes, sizes = codes[np.repeat(~held, sizes)], sizes[~held]
    leaves = tree.leaves(row["words"])
    classes, starts = _with_ends(tree.classes(leaves, np.frombuffer(row["endings"], np.int32))[codes], sizes, END)
    leaves, _ = _with_ends(leaves[codes], sizes, -1)
    return classes, leaves, starts


def pair_totals(packed: DataFrame, tree: Tree) -> np.ndarray:
    """Training pairs (class, class after it); row END has the first classes of texts."""
    def count(batches):
        total = np.zeros(tree.n ** 2, np.int64)
        for b in batches:
            for row in _rows(b):
                classes, _, starts = _training(row, tree)
                if len(starts):
                    one, _ = contexts(classes, starts)
                    total += np.bincount(one * tree.n + classes, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    found = packed.select("held", "sizes", "codes", "words", "endings").mapInArrow(count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")).toPandas()
    return np.bincount(found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.float64), tree.n ** 2).reshape(tree.n, tree.n)


def topic_scores(pairs: np.ndarray, topics: int = TOPICS) -> np.ndarray:
    """Log-probability of each class in each topic: classes are clustered by what
    follows them (spherical k-means from the farthest first), and a topic is what
    follows its classes."""
    n = len(pairs)
    rows = np.sqrt(pairs / np.maximum(1, pairs.sum(1, keepdims=True)))
    weight = pairs.sum(1)
    centres = rows[[int(weight.argmax())]]
    while len(centres) < min(topics, n):
        far = (1 - (rows @ centres.T).max(1)) * np.sqrt(weight)
        centres = np.concatenate([centres, rows[[int(far.argmax())]]])
    for _ in range(20):
        of = (rows @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, rows * weight[:, None])
        centres = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1, keepdims=True))
    follow = np.zeros((len(centres), n))
    np.add.at(follow, of, pairs)
    prior = pairs.sum(0) + 1
    follow += prior / prior.sum() * 10  # a topic says little of classes it has hardly met
    scores = np.log(follow / follow.sum(1, keepdims=True)).T
    return np.pad(scores, ((0, 0), (0, topics - scores.shape[1])), constant_values=-1e9)


def topics_so_far(classes: np.ndarray, sizes: np.ndarray, starts: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Per token the likeliest topic of its text up to the last multiple of
    ``TOPIC_TOKENS``; ``TOPICS`` for a text's first tokens."""
    parts = -(-(sizes + 1) // TOPIC_TOKENS)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(starts, parts) + nth * TOPIC_TOKENS
    sums, left = scores.take(classes[begin], 0), np.diff(np.append(begin, len(classes)))
    for i in range(1, TOPIC_TOKENS):  # the i-th tokens of all parts that have one
        at = np.flatnonzero(left > i)
        if len(at) == len(begin):
            sums += scores.take(classes[begin + i], 0)
        else:
            sums[at] += scores.take(classes[begin[at] + i], 0)
    before = np.cumsum(sums, axis=0) - sums
    before -= np.repeat(before[np.cumsum(parts) - parts], parts, axis=0)
    topic = np.where(nth == 0, scores.shape[1], before.argmax(1))
    return np.repeat(topic, left)


def _by_row(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that brings equal rows together, where each begins in it, and the distinct rows."""
    # 16-bit numbers are sorted by their digits, to the same order
    order = np.argsort(at.astype(np.uint16) if len(at) and at.max() < 1 << 16 else at, kind="stable")
    rows = at[order]
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    return order, first, rows[first]


def _sums(by_row: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order, first, rows = by_row
    return rows, np.add.reduceat(values.take(order, 0), first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.clip(x, -30, 30)
    np.exp(np.negative(y, out=y), out=y)
    y += 1
    return np.divide(1, y, out=y)


class Params:
    """Arrays that are trained by AdaGrad, some rows a step."""

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = [x.astype(np.float32) for x in arrays]
        self.seen = [np.full_like(x, 1e-6) for x in self.arrays]

    def step(self, i: int, rows: np.ndarray | slice, gradient: np.ndarray, rate: float) -> None:
        """Uses up ``gradient``."""
        squares = gradient * gradient
        self.seen[i][rows] += squares
        gradient *= np.float32(rate)
        gradient /= np.sqrt(self.seen[i][rows], out=squares)
        self.arrays[i][rows] -= gradient

    def scatter(self, i: int, at: np.ndarray, gradients: np.ndarray, rate: float) -> None:
        self.step(i, *_sums(_by_row(at), gradients), rate)


class LogBilinear:
    """Vectors of the classes as context, of the topics, and of the classes and
    the leaves as prediction; position weights and biases."""

    def __init__(self, tree: Tree, scores: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.tree, self.scores = tree, scores
        self.context = rng.normal(0, 0.3, (tree.n, VECTOR)).astype(np.float32)
        self.topic = rng.normal(0, 0.3, (TOPICS + 1, VECTOR)).astype(np.float32)
        self.position = np.ones((3, VECTOR), np.float32)
        self.target = np.zeros((tree.n, VECTOR), np.float32)
        self.bias = np.log(tree.unigram).astype(np.float32)
        self.word = np.zeros((len(tree.leaf_class), VECTOR), np.float32)

    PARTS = ("context", "topic", "position", "target", "bias")

    def flat(self, params: Params) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in params.arrays])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for name in self.PARTS:
            x = getattr(self, name)
            setattr(self, name, values[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size

    def params(self) -> Params:
        return Params([getattr(self, name) for name in self.PARTS])

    def learn_classes(self, p: Params, one, two, topic, target, rng, rate: float) -> None:
        """A step: these tokens' classes against ``NOISE`` classes drawn for all of them."""
        r, q, pos, u, b = p.arrays
        noise = np.searchsorted(self.cumulative, rng.random(NOISE), "right")
        parts = r.take(one, 0), r.take(two, 0), q.take(topic, 0)
        h = (r * pos[0]).take(one, 0)
        h += (r * pos[1]).take(two, 0)
        h += (q * pos[2]).take(topic, 0)
        log_noise = np.log(NOISE * self.tree.unigram).astype(np.float32)
        met = u.take(target, 0)
        g = _sigmoid((h * met).sum(1) + b[target] - log_noise[target]) - 1
        gn = h @ u[noise].T
        gn += b[noise]
        gn -= log_noise[noise]
        gn = _sigmoid(gn)
        dh = g[:, None] * met
        dh += gn @ u[noise]
        rows = _by_row(np.concatenate([target, noise]))
        p.step(3, *_sums(rows, np.concatenate([g[:, None] * h, gn.T @ h])), rate)
        p.step(4, *_sums(rows, np.concatenate([g, gn.sum(0)])), rate / 4)
        p.scatter(0, np.concatenate([one, two]), np.concatenate([dh * pos[0], dh * pos[1]]), rate)
        p.scatter(1, topic, dh * pos[2], rate)
        p.step(2, slice(None), np.stack([(x * dh).sum(0) for x in parts]), rate / 4)

    def learn_words(self, met: np.ndarray, rng) -> np.ndarray:
        """The leaves' vectors for ``met``, how often each occurred in each topic:
        told from ``WORD_NOISE`` times as many words drawn from their classes, by
        full steps over the counts.  A draw of n words from shares is a Poisson
        number of each."""
        tree = self.tree
        of_class = np.add.reduceat(np.pad(met, ((0, 1), (0, 0))), tree.first[:-1], axis=0) * (np.diff(tree.first) > 0)[:, None]
        noise = rng.poisson(WORD_NOISE * of_class[tree.leaf_class] * tree.leaf_share[:, None]).astype(np.float32)
        met = met.astype(np.float32)
        q = self.topic * self.position[2]
        p = Params([self.word])
        for step in range(WORD_STEPS):
            told = _sigmoid(p.arrays[0] @ q.T - np.float32(math.log(WORD_NOISE)))
            p.step(0, slice(None), ((told - 1) * met + told * noise) @ q, RATE / (1 + step / 20))
        return p.arrays[0]

    def prepare(self) -> None:
        self.cumulative = np.cumsum(self.tree.unigram)
        self.cumulative[-1] = 1.0

    def tables(self) -> dict[str, np.ndarray]:
        """Exponentials of the parts of every logit, by matrix products: by the class
        before, the one before that and the topic, for classes; by the topic, for
        leaves, with each class's sum over its leaves."""
        u = self.target.astype(np.float64).T
        one, two = (np.exp((self.context * w) @ u) for w in self.position[:2].astype(np.float64))
        three = np.exp((self.topic * self.position[2].astype(np.float64)) @ u + self.bias)
        leaf = np.exp((self.topic * self.position[2]).astype(np.float64) @ self.word.astype(np.float64).T) * self.tree.leaf_share
        sums = np.concatenate([np.zeros((TOPICS + 1, 1)), np.cumsum(leaf, axis=1)], axis=1)
        inside = sums[:, self.tree.first[1:]] - sums[:, self.tree.first[:-1]] + self.tree.rare_share
        return {"one": one.astype(np.float32), "two": two.astype(np.float32), "three": three.astype(np.float32),
                "leaf": np.log10(np.maximum(leaf, 1e-300)), "inside": np.log10(np.where(inside > 0, inside, 1.0))}


#: Distinct contexts whose sums over the classes are taken at once.
CONTEXTS_AT_ONCE = 4096


def class_logs(tables: dict, one: np.ndarray, two: np.ndarray, topic: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 of the normalised probability of each class in its context."""
    a, b, c = tables["one"], tables["two"], tables["three"]
    n = len(a)
    key = (one * n + two) * (TOPICS + 1) + topic
    met = np.zeros(n * n * (TOPICS + 1), bool)
    met[key] = True
    context = np.flatnonzero(met)
    place = np.empty(len(met), np.int32)
    place[context] = np.arange(len(context))
    at = place[key]
    total = np.empty(len(context))
    for lo in range(0, len(context), CONTEXTS_AT_ONCE):
        part = context[lo:lo + CONTEXTS_AT_ONCE]
        pair, z = part // (TOPICS + 1), part % (TOPICS + 1)
        x = a[pair // n]
        x *= b[pair % n]
        total[lo:lo + len(part)] = np.einsum("ij,ij->i", x, c[z], dtype=np.float64)
    wish = a[one, target].astype(np.float64) * b[two, target] * c[topic, target]
    return np.log10(wish / total[at])


def _task_seed(row: dict) -> int:
    return SEED + int(row["chunk"]) % (1 << 31)


def _average_classes(packed: DataFrame, model: LogBilinear) -> np.ndarray | None:
    """The tasks' class parameters after their part of the text, averaged by tokens."""
    spark = packed.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def learn(batches):
        m = shared.value
        m.prepare()
        p, seen = m.params(), 0
        for b in batches:
            for row in _rows(b):
                classes, _, starts = _training(row, m.tree)
                if not len(starts):
                    continue
                one, two = contexts(classes, starts)
                topic = topics_so_far(classes, np.diff(np.append(starts, len(classes))) - 1, starts, m.scores)
                rng = np.random.default_rng(_task_seed(row))
                for turn in range(max(1, LEAST_TRAINED // len(classes))):
                    order = rng.permutation(len(classes))
                    for lo in range(0, len(order), STEP):
                        x = order[lo:lo + STEP]
                        m.learn_classes(p, one[x], two[x], topic[x], classes[x], rng, RATE / (1 + turn / 4))
                seen += len(classes)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([(m.flat(p) * np.float32(seen)).tobytes()])],
                                             names=["n", "sums"])

    def add(batches):
        n, total = 0.0, None
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(x, np.float32).astype(np.float64)
                n, total = n + k, x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()])], names=["n", "sums"])

    # a row of some 100 kB a task: added up in a few tasks, so the driver gets a few
    rows = written(packed.select("chunk", "held", "sizes", "codes", "words", "endings").mapInArrow(learn, "n double, sums binary"), "lm-classes")
    few = rows.repartition(8).mapInArrow(add, "n double, sums binary").collect()
    if not few:
        return None
    return sum(np.frombuffer(r["sums"], np.float64) for r in few) / sum(r["n"] for r in few)


def _average_words(packed: DataFrame, model: LogBilinear) -> np.ndarray:
    """The leaves' vectors likewise, each averaged over the tasks that met it by how often they did."""
    shared = packed.sparkSession.sparkContext.broadcast(model)
    names = [f"v{i}" for i in range(VECTOR)]

    def learn(batches):
        m = shared.value
        m.prepare()
        met, seed = np.zeros((len(m.word), TOPICS + 1)), SEED
        for b in batches:
            for row in _rows(b):
                classes, leaves, starts = _training(row, m.tree)
                if not len(starts):
                    continue
                topic = topics_so_far(classes, np.diff(np.append(starts, len(classes))) - 1, starts, m.scores)
                mine = np.flatnonzero((leaves >= 0) & (classes > m.tree.n_top))  # a top word is all of its class
                met += np.bincount(leaves[mine] * (TOPICS + 1) + topic[mine], minlength=met.size).reshape(met.shape)
                seed = seed * 31 % (1 << 31) + _task_seed(row)
        n = met.sum(1)
        at = np.flatnonzero(n)
        if len(at):
            sums = (m.learn_words(met, np.random.default_rng(seed))[at] * n[at, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), *[pa.array(sums[:, i]) for i in range(VECTOR)]],
                                             names=["leaf", "n", *names])

    kind = "leaf long, n double, " + ", ".join(f"{v} float" for v in names)
    found = packed.select("chunk", "held", "sizes", "codes", "words", "endings").mapInArrow(learn, kind)
    sums = found.groupBy("leaf").agg(F.sum("n").alias("n"), *[F.sum(v).cast("float").alias(v) for v in names]).toPandas()
    out = np.zeros_like(model.word)  # BROADCAST_WORDS rows at most
    out[sums["leaf"].to_numpy(np.int64)] = sums[names].to_numpy(np.float32) / sums[["n"]].to_numpy(np.float32)
    return out


def train(packed: DataFrame, counts: DataFrame) -> LogBilinear:
    """The model of the training documents of ``packed`` and their words' ``counts``."""
    tree = Tree(frequent_words(counts, BROADCAST_WORDS))
    tokens, distinct = class_totals(counts, tree)
    ends = packed.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("held")), lambda i: F.substring("held", i, 1))).alias("h"))
    tree.fill(tokens, distinct, ends.where(F.col("h") == F.lit(b"\x00")).count())
    pairs = pair_totals(packed, tree)
    model = LogBilinear(tree, topic_scores(pairs))
    learnt = _average_classes(packed, model) if tree.total else None
    if learnt is not None:
        model.set_flat(learnt)
        if len(tree.leaf_class):
            model.word = _average_words(packed, model)
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text."""
    packed = chunks(docs, id_col, text_col, modulus, held)
    counts = word_counts(packed)
    return score_with(packed, counts, train(packed, counts))


def score_with(packed: DataFrame, counts: DataFrame, model: LogBilinear) -> DataFrame:
    """``score`` of packed documents by a trained model."""
    tree = model.tree
    shared = packed.sparkSession.sparkContext.broadcast({
        "tree": tree, "scores": model.scores, "tables": model.tables(), "base": np.log10(tree.total + tree.vocabulary + 1),
        "rare_log": np.log10(np.where(tree.rare_share > 0, tree.rare_share, 1.0)), "rare_size": np.log10(np.maximum(tree.rare_size, 1))})

    def ask(batches):
        """The words of a chunk whose counts aren't broadcast."""
        tree = shared.value["tree"]
        for b in batches:
            for row in _rows(b):
                at = pa.array(np.flatnonzero(tree.leaves(row["words"]) < 0).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["chunk"])), at, row["words"].take(at)],
                                                 names=["chunk", "place", "word"])

    asked = packed.select("chunk", "words").mapInArrow(ask, "chunk long, place int, word binary")
    told = asked.join(counts, "word").select(F.col("chunk").alias("of_chunk"), "place", "c")

    def slim(batches):
        """A chunk with its words' classes and leaves in place of the words."""
        tree = shared.value["tree"]
        for b in batches:
            for row in _rows(b):
                leaves = tree.leaves(row.pop("words"))
                row["classes"] = tree.classes(leaves, np.frombuffer(row.pop("endings"), np.int32)).astype(np.int16).tobytes()
                row["leaves"] = leaves.astype(np.int32).tobytes()
                kinds = [pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    slimmed = packed.drop("counts").mapInArrow(
        slim, "chunk long, ids array<long>, held binary, sizes binary, codes binary, classes binary, leaves binary")

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        tree, tables = m["tree"], m["tables"]
        row = left.to_pylist()[0]
        flags, sizes, codes = _arrays(row)
        of_word = np.frombuffer(row["classes"], np.int16).astype(np.int64)
        leaf = np.frombuffer(row["leaves"], np.int32).astype(np.int64)
        c = np.where(leaf >= 0, tree.leaf_count[leaf], 0) if len(tree.leaf_count) else np.zeros(len(leaf), np.int64)
        c[right.column("place").to_numpy()] = right.column("c").to_numpy()
        classes, starts = _with_ends(of_word[codes], sizes, END)
        base, _ = _with_ends(np.log10(c + 1)[codes], sizes, np.log10(tree.ends + 1))
        seen, _ = _with_ends((c > 0).astype(np.int64)[codes], sizes, int(tree.ends > 0))
        one, two = contexts(classes, starts)
        topic = topics_so_far(classes, sizes, starts, m["scores"])
        log_p = class_logs(tables, one, two, topic, classes)
        # the word in its class: its leaf's share, or that of the rare words times its own among them
        leaves, _ = _with_ends(leaf[codes], sizes, -1)
        rare, _ = _with_ends((np.log10(c + 1) + (m["rare_log"] - m["rare_size"])[of_word])[codes], sizes, 0.0)
        own = np.flatnonzero(leaves >= 0)
        rare[own] = tables["leaf"][topic[own], leaves[own]]
        inside = np.where(classes == END, 0.0, rare - tables["inside"][topic, classes])
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(flags), "n_tokens": pa.array(sizes + 1),
            "n_known": np.add.reduceat(seen, starts), "train_tokens": pa.array(np.full(len(sizes), tree.total)),
            "base_score": np.add.reduceat(base, starts) - (sizes + 1) * m["base"], "score": np.add.reduceat(log_p + inside, starts)})

    return slimmed.groupBy("chunk").cogroup(told.groupBy("of_chunk")).applyInArrow(
        rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
