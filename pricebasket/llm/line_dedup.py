"""Line dedup that can be undone: sharded cuckoo filters in front of exact
reference counts.

``LineIndex`` keeps three tables, each a DataFrame written to the shared folder:

* ``postings`` (key, doc_id, text_hash): which document holds which line key;
* ``refs`` (key, shard, n_docs, first_doc, last_doc): the exact reference counts;
* ``filters`` (shard, filter): per shard of the key space a cuckoo filter with
  one tag per live key.

``insert`` asks the filters first: a key that its shard's filter has not seen
is new for certain, and its counts become a row of ``refs`` as they are.  Only
the others are looked up in the exact table and added to what is there
(``looked_up``).  ``delete`` takes documents out again: counts go down,
``first_doc`` moves on, and keys nobody holds any more leave their filter.  An
index that has grown past its shards gets more, with filters built from ``refs``.

A key is 16 bytes (MD5) of the line with ``[\\x20\\x09-\\x0D]`` stripped at both
ends and A-Z lower-cased; keys of fewer than ``min_chars`` code points are not
indexed.  Defined results: a NULL or empty text is one empty line; rows of one
doc_id count as one document and all keep a line that is theirs; of equal texts
the smallest doc_id keeps its lines.  Rows without a doc_id come after every
other, and each of their texts is a document of its own (ids of 2^62 and more
are taken for such).  Which lines a row loses is held by its id and text, so no
id gathers more than one text's keys.  Other columns of the input, whatever
their names, pass through untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import BLANKS, numbered, remembered, table, utf8, written
from pricebasket.llm.cuckoo import CuckooFilter

#: Keys per shard: a shard's keys and its filter, which has room for them all from
#: the start (1 MB), fit in one task.
SHARD_KEYS = 250_000
#: Ids from here on stand for the texts of rows without one.
NO_ID = 1 << 62
#: Batches of documents in which an index of a whole table is built.
BATCHES = 3


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Key of one line of a text already lower-cased in A-Z, or None if too short."""
    line = line.strip(BLANKS)
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return hashlib.md5(line, usedforsecurity=False).digest()


def _row_key(id_: Column, text: Column) -> tuple[Column, Column]:
    """(document, hash of the text) of a row: what it loses depends on both."""
    text_hash = F.xxhash64(text)
    own = F.lit(NO_ID) + text_hash.bitwiseAND(F.lit(NO_ID - 1))
    return F.coalesce(id_.cast("long"), own), text_hash


def postings(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, text_hash): each line key of each document, once a row of ``docs``."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("line_dedup")  # nothing, but other operators' things go
        for b in batches:
            keys, sizes = [], []
            for text in b.column(2).to_pylist():
                own = {line_key(x, min_chars) for x in utf8(text).lower().split(b"\n")}
                own.discard(None)
                keys.extend(own)
                sizes.append(len(own))
            of = np.repeat(np.arange(b.num_rows), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column(0).take(pa.array(of)),
                                              b.column(1).take(pa.array(of))], schema=schema)

    doc, text_hash = _row_key(F.col(id_col), F.col(text_col))
    return docs.select(doc.alias("doc_id"), text_hash.alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(
        run, POSTS)


def _hashes(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The last eight bytes of each key, as the filters' hashes."""
    return np.frombuffer(b"".join(k[8:] for k in keys.to_pylist()), "<u8")


def _counted(post: DataFrame, shards: int) -> DataFrame:
    """Exact counts of ``post``: partial sums per task meet per key, so a line
    that every document holds costs one row a task."""
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    return post.groupBy("key").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"),
                                   F.max("doc_id").alias("last_doc")).withColumn("shard", shard)


POSTS = "key binary, doc_id long, text_hash long"
REFS = "key binary, shard long, n_docs long, first_doc long, last_doc long"


class LineIndex:
    def __init__(self, refs: DataFrame, posts: DataFrame, filters: DataFrame, shards: int, min_chars: int,
                 looked_up: DataFrame | None = None):
        self.refs, self.posts, self.filters, self.shards, self.min_chars = refs, posts, filters, shards, min_chars
        #: keys of the last insert that the filters could not tell to be new
        self.looked_up = looked_up

    @classmethod
    def empty(cls, spark, expected_keys: int = 0, min_chars: int = 10) -> LineIndex:
        """An index with shards for about ``expected_keys`` distinct lines; it gets more as it grows."""
        return cls(spark.createDataFrame([], REFS), spark.createDataFrame([], POSTS),
                   spark.createDataFrame([], "shard long, filter binary"),
                   max(1, math.ceil(expected_keys / SHARD_KEYS)), min_chars)

    def insert(self, post: DataFrame) -> LineIndex:
        """With the documents of ``post`` (``postings``; documents not in the index yet) added."""
        post = post.distinct()
        probe = pa.schema([("key", pa.binary()), ("n_docs", pa.int64()), ("first_doc", pa.int64()),
                           ("last_doc", pa.int64()), ("shard", pa.int64()), ("known", pa.bool_()),
                           ("filter", pa.binary())])

        def add(new: pa.Table, old: pa.Table) -> pa.Table:
            remembered("line_dedup")
            stored = old.column("filter").to_pylist()
            cuckoo = CuckooFilter.from_bytes(stored[0]) if stored else CuckooFilter(max(new.num_rows, SHARD_KEYS))
            hashes = _hashes(new.column("key"))
            known = cuckoo.contains(hashes) if stored else np.zeros(len(hashes), bool)
            cuckoo.insert(hashes[~known])
            shard = (new if new.num_rows else old).column(4 if new.num_rows else 0)[0].as_py()
            cols = [new.column(f.name) for f in list(probe)[:5]] + [pa.array(known), pa.nulls(len(known), pa.binary())]
            last = [pa.array([None], f.type) for f in list(probe)[:4]]
            last += [pa.array([shard]), pa.array([None], pa.bool_()), pa.array([cuckoo.to_bytes()], pa.binary())]
            return pa.concat_tables([pa.table(cols, schema=probe), pa.table(last, schema=probe)])

        found = written(
            _counted(post, self.shards).groupBy("shard").cogroup(
                self.filters.toDF("of_shard", "filter").groupBy("of_shard")).applyInArrow(
                add, "key binary, n_docs long, first_doc long, last_doc long, shard long, known boolean, filter binary"),
            "line-probe")
        cols = ["key", "shard", "n_docs", "first_doc", "last_doc"]
        fresh = found.where("not known").select(*cols)
        # a known tag may belong to another key: the exact table decides
        before = self.refs.select("key", *[F.col(c).alias(f"old_{c}") for c in cols[2:]])
        looked = written(found.where("known").select(*cols).join(before, "key", "left"), "line-looked")
        # a key the exact table does not have is live now and needs a tag of its own
        filters = self._tags(found.where("filter is not null").select("shard", "filter"),
                             looked.where("old_n_docs is null"), "insert")
        added = looked.select("key", "shard", (F.col("n_docs") + F.coalesce("old_n_docs", F.lit(0))).alias("n_docs"),
                              F.least("first_doc", "old_first_doc").alias("first_doc"),
                              F.greatest("last_doc", "old_last_doc").alias("last_doc"))
        untouched = self.refs.select(*cols).join(looked.where("old_n_docs is not null").select("key"), "key", "left_anti")
        refs = written(fresh.unionByName(added).unionByName(untouched), "line-refs")
        return LineIndex(refs, self.posts.unionByName(post), filters, self.shards, self.min_chars, looked.select("key"))._grown()

    def _grown(self) -> LineIndex:
        """With more shards if those it has are half as large again as they should
        be: a filter has room for that, beyond it insertions would be slow."""
        n = self.refs.count()
        if 2 * n <= 3 * self.shards * SHARD_KEYS:
            return self
        shards = math.ceil(n / SHARD_KEYS)
        refs = self.refs.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        schema = pa.schema([("shard", pa.int64()), ("filter", pa.binary())])

        def build(keys: pa.Table) -> pa.Table:
            remembered("line_dedup")
            cuckoo = CuckooFilter(max(keys.num_rows, SHARD_KEYS))
            cuckoo.insert(_hashes(keys.column("key")))
            return pa.table([keys.column("shard").slice(0, 1), pa.array([cuckoo.to_bytes()], pa.binary())], schema=schema)

        filters = refs.select("shard", "key").groupBy("shard").applyInArrow(build, "shard long, filter binary")
        return LineIndex(refs, self.posts, written(filters, "line-filters"), shards, self.min_chars, self.looked_up)

    def _tags(self, filters: DataFrame, keys: DataFrame, change: str) -> DataFrame:
        """``filters`` with the tags of ``keys`` (distinct keys) inserted or deleted."""
        schema = pa.schema([("shard", pa.int64()), ("filter", pa.binary())])

        def apply(old: pa.Table, keys: pa.Table) -> pa.Table:
            remembered("line_dedup")
            cuckoo = CuckooFilter.from_bytes(old.column("filter")[0].as_py())
            getattr(cuckoo, change)(_hashes(keys.column("key")))
            return pa.table([old.column("shard"), pa.array([cuckoo.to_bytes()], pa.binary())], schema=schema)

        keys = keys.select("shard", "key").toDF("of_shard", "key")
        return written(filters.groupBy("shard").cogroup(keys.groupBy("of_shard")).applyInArrow(
            apply, "shard long, filter binary"), "line-filters")

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents of ``doc_ids`` (one column); ids it does not hold
        change nothing, NULL takes out every document without an id."""
        ids = doc_ids.select(F.coalesce(F.col(doc_ids.columns[0]), F.lit(NO_ID)).alias("gone_id")).distinct()
        gone_ = F.least(F.col("doc_id"), F.lit(NO_ID)) == F.col("gone_id")
        kept = written(self.posts.join(ids, gone_, "left_anti").select(*self.posts.columns), "line-postings")
        hit = self.posts.join(ids, gone_, "left_semi").select("key").distinct()
        old = self.refs.join(hit, "key", "left_semi")
        now = _counted(kept.join(hit, "key", "left_semi"), self.shards)
        gone = written(old.join(now.select("key"), "key", "left_anti"), "line-gone")
        refs = written(self.refs.join(hit, "key", "left_anti").unionByName(now.select(*self.refs.columns)), "line-refs")
        return LineIndex(refs, kept, self._tags(self.filters, gone, "delete"), self.shards, self.min_chars)

    def duplicates(self) -> DataFrame:
        """(doc_id, text_hash, keys): the line keys each text loses."""
        shared = self.refs.where("first_doc != last_doc").select("key", "first_doc")
        return (self.posts.join(shared, "key").where("doc_id != first_doc")
                .groupBy("doc_id", "text_hash").agg(F.collect_list("key").alias("keys")))


def drop_lines(docs: DataFrame, dups: DataFrame, min_chars: int = 10, id_col: str = "doc_id",
               text_col: str = "text", report: bool = False) -> DataFrame:
    """``docs`` without the lines of ``dups``; every other column stays.  With
    ``report``, (doc_id, kept_text, n_lines, n_dropped) instead."""
    names = docs.columns
    rows = numbered(docs)
    i_id, i_text = names.index(id_col), names.index(text_col)
    dups = dups.select(F.col("doc_id").alias("dup_id"), F.col("text_hash").alias("dup_text"), F.col("keys").alias("dup_keys"))
    doc, text_hash = _row_key(F.col(f"c{i_id}"), F.col(f"c{i_text}"))
    both = rows.join(dups, (doc == F.col("dup_id")) & (text_hash == F.col("dup_text")), "left").drop("dup_id", "dup_text")
    if report:
        both = both.select(F.col(f"c{i_id}"), F.col(f"c{i_text}"), "dup_keys")
        out = f"{id_col} long, kept_text string, n_lines long, n_dropped long"
    else:
        out = ", ".join(f"c{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(names)))

    def keep(text: str | None, dup: list[bytes] | None) -> tuple[str | None, int, int]:
        if not dup:
            return text, utf8(text).count(b"\n") + 1, 0
        lines, dup = utf8(text).split(b"\n"), set(dup)
        left = [x for x in lines if line_key(x.lower(), min_chars) not in dup]
        return b"\n".join(left).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("line_dedup")
        for b in batches:
            cols = list(b.columns)
            dup = cols.pop().to_pylist()
            at = 1 if report else i_text
            done = [keep(t, d) for t, d in zip(cols[at].to_pylist(), dup, strict=True)]
            text = pa.array([x[0] for x in done], cols[at].type)
            if report:
                yield pa.RecordBatch.from_arrays(
                    [cols[0], text, pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())],
                    names=[id_col, "kept_text", "n_lines", "n_dropped"])
            else:
                cols[at] = text
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    done = both.mapInArrow(run, out)
    return done if report else done.toDF(*names)


def build_index(docs: DataFrame, min_chars: int = 10, batches: int = BATCHES, **cols) -> LineIndex:
    """The index of all lines of ``docs``, whose documents are inserted in batches
    by a hash of their ids: from the second on, the filters spare new lines the
    look-up."""
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    post = written(postings(docs, min_chars, **cols).withColumn("batch", batch), "line-postings", ("batch",))
    index = LineIndex.empty(docs.sparkSession, post.count(), min_chars)
    for b in range(batches):
        index = index.insert(post.where(F.col("batch") == b).drop("batch"))
    return index


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` (all columns) without repeated lines: a line stays in the smallest doc_id holding it."""
    return drop_lines(docs, build_index(docs, min_chars).duplicates(), min_chars)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_lines(docs, build_index(docs).duplicates(), report=True)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce(F.encode("kept_text", "utf-8"), F.lit(b"")), 256).alias("kept_sha256"))


ORACLE_OP9 = """
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), shared AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines,
       CAST(count(*) FILTER (WHERE s.key IS NOT NULL AND l.doc_id <> s.first_doc) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE s.key IS NULL OR l.doc_id = s.first_doc), '')) AS kept_sha256
FROM lines l LEFT JOIN shared s ON l.key = s.key
GROUP BY doc_id
"""
