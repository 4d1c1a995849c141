"""SimHash near-dedup over a Gray-order hierarchical index.

A text's fingerprint sets a bit if over half of its shingles' XXH64 hashes do.
Documents of one fingerprint are one class; classes within ``max_bits`` link,
and links chain into components.  The distinct fingerprints are sorted by Gray
rank, in rotations, and dealt in runs that share their top bits; each task's
hierarchy of shared masked bits finds the partners, and a run that is too large
for one task is cut into blocks whose shared bits are the upper nodes.  A task
hands on a spanning forest of its links, never all pairs.

Defined results: a NULL or empty text, or one of blanks only, has fingerprint
zero and is linked like any other; a text of fewer words than a shingle has one
shingle, the whole sequence.  Repeated rows get equal rows back.  A NULL doc_id
never is a component's id unless no other id is in it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import numbered, remembered, table, words_of, written
from pricebasket.llm.components import connected_components
from pricebasket.llm.gray_index import Forest, GrayIndex, bit_count, gray_rank

SEED = 42
#: Fingerprints a search task indexes, about; larger runs are cut.
BLOCK = 50_000
#: Rows of one text whose 16-bit lane sums can't overflow.
LANE_ROWS = 65_535


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    w = words_of(text)
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([digest(b" ".join(w), SEED)] if w else [], np.uint64)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(w) - words + 1)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text (``sizes`` hashes each, in order) the bits set in over half of
    its hashes.  Four bits are counted at once in 16-bit lanes; longer texts
    are summed in parts."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    ends = np.cumsum(sizes[full])
    starts = ends - sizes[full]
    parts = -(-sizes[full] // LANE_ROWS)
    text = np.repeat(np.arange(len(full)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    cut = starts[text] + nth * LANE_ROWS
    lane = np.uint64(0x0001000100010001)
    first = np.flatnonzero(nth == 0)
    for shift in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & lane, cut)
        for k in range(4):
            bit = shift + 16 * k
            count = np.add.reduceat((sums >> np.uint64(16 * k)) & np.uint64(0xFFFF), first)
            out[full] |= (2 * count > sizes[full]).astype(np.uint64) << np.uint64(bit)
    return out


def _prints(texts: pa.Array, words: int) -> pa.Array:
    """Fingerprints of a column of texts as signed 64-bit integers."""
    remembered("simhash")  # nothing, but other operators' things go
    lists = [shingle_hashes(t, words) for t in texts.to_pylist()]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    return pa.array(majority(flat, sizes).view(np.int64))


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed 64-bit integer."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), _prints(b.column(1), words)], schema=schema)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def _rotated(fp: np.ndarray, shift: int) -> np.ndarray:
    x = fp.view(np.uint64)
    return (x << np.uint64(shift) | x >> np.uint64(64 - shift)) if shift else x


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(rotation that brings it to the top, bits) of max_bits + 1 segments:
    fingerprints within max_bits agree on all of at least one."""
    cuts = [round(64 * i / (max_bits + 1)) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _forest(table: pa.Table, members: str, asks: str, max_bits: int) -> pa.Table:
    """Links between the rows marked ``asks`` and those marked ``members`` of
    one rotation that agree on its top segment, as a forest."""
    remembered("simhash")
    rotated, prefix = table.column("rfp").to_numpy().view(np.uint64), np.uint64(table.column("prefix")[0].as_py() % (1 << 64))
    marks = [np.asarray(table.column(c).to_numpy(zero_copy_only=False), bool) for c in (members, asks)]
    prints, at = np.unique(rotated, return_inverse=True)
    inside, queries = (np.unique(at[m]) for m in marks)
    index, forest = GrayIndex(prints[inside]), Forest(len(prints))
    for q, m in index.search(prints[queries], max_bits, prefix):
        a, b = queries[q], inside[m]
        forest.join(a[a != b], b[a != b])
    edges = np.array(forest.edges, np.int64).reshape(-1, 2)
    shift = (64 - table.column("shift")[0].as_py()) % 64
    plain = _rotated(prints, shift).view(np.int64)
    return pa.table({"a": plain[edges[:, 0]], "b": plain[edges[:, 1]]})


def _gray_order(rfp: pd.Series) -> pd.Series:
    """Gray rank, unsigned order as a signed integer."""
    rank = gray_rank(rfp.to_numpy(np.int64).view(np.uint64)) ^ np.uint64(1 << 63)
    return pd.Series(rank.view(np.int64))


def _hot_links(runs: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Links within runs too large for one task (columns shift, rfp, prefix,
    run): each run is cut into blocks in Gray order, and the bits a block
    shares, the index's upper nodes, tell each fingerprint which later blocks
    of its run can hold a partner."""
    rank = F.pandas_udf(_gray_order, "long")
    n = runs.count()
    parts = max(1, math.ceil(n / block))
    place = written(runs.withColumn("gray", rank("rfp")).repartitionByRange(parts, "shift", "run", "gray")
                    .withColumn("part", F.spark_partition_id()), "simhash-blocks")
    # one row a block and run: (fingerprints / block) plus the runs of over a block, which are fewer still
    nodes = place.groupBy("shift", "run", "part").agg(
        F.bit_and("rfp").alias("value"), F.bit_or("rfp").alias("any")).orderBy("shift", "run", "part").collect()
    of_run: dict[tuple[int, int], list] = {}
    for r in nodes:
        shared = ~(r["value"] ^ r["any"]) % (1 << 64)
        of_run.setdefault((r["shift"], r["run"]), []).append((r["part"], np.uint64(r["value"] % (1 << 64)), np.uint64(shared)))
    schema = pa.schema([("shift", pa.int32()), ("run", pa.int64()), ("part", pa.int32()), ("rfp", pa.int64()),
                        ("prefix", pa.int64()), ("own", pa.bool_())])

    def route(batches):
        for b in batches:
            shift, run, rfp, prefix, part = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for key in set(zip(shift.tolist(), run.tolist(), strict=True)):
                own_run = (shift == key[0]) & (run == key[1])
                asks = rfp[own_run].view(np.uint64)
                for target, value, shared in of_run[key]:
                    near = (part[own_run] <= target) & (bit_count((asks ^ value) & shared) <= max_bits)
                    k = int(near.sum())
                    if k:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(k, key[0]), pa.int32()), pa.array(np.full(k, key[1]), pa.int64()),
                             pa.array(np.full(k, target), pa.int32()), pa.array(rfp[own_run][near]),
                             pa.array(prefix[own_run][near]), pa.array(part[own_run][near] == target)], schema=schema)

    routed = written(place.select("shift", "run", "rfp", "prefix", "part").mapInArrow(
        route, "shift int, run long, part int, rfp long, prefix long, own boolean"), "simhash-routed")
    keys = ["shift", "run", "part"]
    # a block that many ask is searched in several tasks, each with all its members
    splits = routed.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(2 * block)).alias("n"))
    wide = routed.join(splits, keys)
    tasks = wide.select(*keys, "rfp", "prefix", "own", F.lit(True).alias("asks"), F.pmod(F.xxhash64("rfp"), F.col("n")).alias("salt"))
    copies = wide.where("own and n > 1").select(*keys, "rfp", "prefix", "own", F.lit(False).alias("asks"),
                                                F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"))
    return tasks.unionByName(copies).groupBy(*keys, "salt").applyInArrow(
        lambda t: _forest(t, "own", "asks", max_bits), "a long, b long")


def links(classes: DataFrame, max_bits: int = 2, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``classes`` (column fp)
    within ``max_bits``; a forest per search task, whose union has exactly the
    components of all links.

    The index is kept in max_bits + 1 rotations, each with another segment of
    the bits on top.  Linked fingerprints agree on one segment at least, so in
    that rotation they lie in one run of the Gray order: runs are dealt over
    the tasks, and each task indexes and searches its own.
    """
    n = classes.count()
    parts = max(1, math.ceil((max_bits + 1) * n / block))
    turned = []
    for shift, bits in _segments(max_bits):
        left = F.shiftleft("fp", shift).bitwiseOR(F.shiftrightunsigned("fp", 64 - shift)) if shift else F.col("fp")
        turned.append(F.struct(F.lit(shift).alias("shift"), left.alias("rfp"), F.shiftrightunsigned(left, 64 - bits).alias("run"),
                               F.lit(-(1 << (64 - bits))).cast("long").alias("prefix")))
    runs = classes.select(F.explode(F.array(*turned)).alias("t")).select("t.*")
    hot = written(runs.groupBy("shift", "run").count().where(F.col("count") > block).select("shift", "run"), "simhash-hot")
    rest, more = runs, None
    if hot.count():
        rest = runs.join(hot, ["shift", "run"], "left_anti")
        more = _hot_links(written(runs.join(hot, ["shift", "run"], "left_semi"), "simhash-hot-runs"), max_bits, block)
    rest = rest.withColumn("task", F.pmod(F.xxhash64("shift", "run"), F.lit(parts))).withColumn("all", F.lit(True))
    found = rest.groupBy("shift", "task").applyInArrow(lambda t: _forest(t, "all", "all", max_bits), "a long, b long")
    return found.unionByName(more) if more is not None else found


def near_dup_components(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    prints = written(fingerprints(docs, words, id_col, text_col), "simhash-prints")
    rooted = _rooted(prints, max_bits)
    # the smallest id of a component: per root over its classes, then per class
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first_id, root) per distinct fingerprint of ``prints`` (doc_id, fp)."""
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = connected_components(links(classes, max_bits))
    return written(classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def drop_near_dups(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` (all columns) with exactly one row of each component: that of the
    smallest doc_id, a NULL one last, and of equal ids the text of the smallest
    hash.  Of rows equal in id and text any one stays.

    A row is told by its id and two hashes of its text, so rows that share an id,
    or have none, are decided each for itself, and texts move once, to where the
    kept keys are."""
    names = docs.columns
    rows = numbered(docs)
    id_, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    keyed = rows.withColumns({"k_id": id_.cast("long"), "k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)})
    # a row's print and its key, side by side
    prints = written(_keyed_prints(keyed.select("k_id", "k1", "k2", text.alias("text")), words), "simhash-prints")
    rooted = _rooted(prints.select(F.col("k_id").alias("doc_id"), "fp"), max_bits).select("fp", "root")
    best = F.min(F.struct(F.col("k_id").isNull().alias("none"), F.col("k_id"), F.col("k1"), F.col("k2"))).alias("best")
    kept = written(prints.join(rooted, "fp").groupBy("root").agg(best).select("best.*"), "simhash-kept").select(
        *[F.col(c).alias(f"b_{c}") for c in ("k_id", "k1", "k2")])
    same = F.col("k_id").eqNullSafe(F.col("b_k_id")) & (F.col("k1") == F.col("b_k1")) & (F.col("k2") == F.col("b_k2"))
    out = keyed.join(kept, same, "left_semi")
    repeats = prints.join(kept, same, "left_semi").groupBy("k_id", "k1", "k2").count().where("count > 1")
    if not repeats.isEmpty():  # rows equal in id and text: partial aggregates leave one a task
        out = out.dropDuplicates(["k_id", "k1", "k2"])
    return out.select(*rows.columns).toDF(*names)


def _keyed_prints(keyed: DataFrame, words: int) -> DataFrame:
    """(k_id, k1, k2, fp) of rows (k_id, k1, k2, text)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _prints(b.column(3), words)], names=["k_id", "k1", "k2", "fp"])

    return keyed.mapInArrow(run, "k_id long, k1 long, k2 long, fp long")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    return near_dup_components(table(spark, sf_dir, "documents"))
