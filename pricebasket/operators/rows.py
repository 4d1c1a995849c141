"""Row-level operators: top-1 per key, labelling, null-safe delete, dedupe.

Top-1 per key is ``row_number() = 1`` over a window; Catalyst plans it with
a partial ``WindowGroupLimit`` before the shuffle, so a hot key is cut to one
row per map task before it is exchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import col, non_empty, null_safe_true
from ..session import cut_lineage


def _as_cols(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col(c) for c in cs]


def top_n_per_key(df: DataFrame, keys, order, n: int = 1, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key under ``order`` (a total order:
    callers append tie-breakers).  ``order`` items must carry their null
    ordering explicitly (``asc_nulls_last()`` etc.)."""
    tmp = rank_col or "__rn"
    w = Window.partitionBy(*_as_cols(keys)).orderBy(*_as_cols(order))
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= n)
    return out if rank_col else out.drop(tmp)


def latest_per_key(df: DataFrame, keys, date, tie_breakers=(), non_empty_cols=()) -> DataFrame:
    """Newest row per key.  Rows whose key or listed columns are NULL/'' are
    dropped first, and so are rows without a date: a NULL date never counts
    as the latest."""
    cond = col(date).isNotNull()
    for c in list(_as_cols(keys)) + _as_cols(non_empty_cols):
        cond = cond & non_empty(c)
    order = [col(date).desc_nulls_last()] + _as_cols(tie_breakers)
    return top_n_per_key(df.filter(cond), keys, order, 1)


def classify(df: DataFrame, out_col: str, rules: Sequence[tuple], match_cols: Sequence[str],
             default: str) -> DataFrame:
    """Label rows by rules; first match wins.

    Each rule is ``(v1, v2, ..., label)`` with one value per ``match_cols``;
    a ``None`` value matches anything.  Values are compared as text so that
    numeric ids given as numbers match string columns."""
    expr = None
    for rule in rules:
        *values, label = rule
        cond = F.lit(True)
        for c, v in zip(match_cols, values):
            if v is not None:
                cond = cond & (F.col(c).cast("string") == F.lit(str(v)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out_col, expr)


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """``DELETE FROM df WHERE cond``: rows whose condition is NULL stay."""
    return df.filter(~null_safe_true(cond))


def dedupe_by_score(df: DataFrame, keys, score: Column, order, score_col: str = "score",
                    rank_col: str | None = None) -> DataFrame:
    """Best row per key: lowest ``score`` first, then ``order``."""
    scored = df.withColumn(score_col, score)
    return top_n_per_key(scored, keys, [F.col(score_col).asc_nulls_last()] + _as_cols(order), 1,
                         rank_col)


def union_all(dfs: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name (all inputs must have the same columns)."""
    dfs = list(dfs)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def rank_within(df: DataFrame, keys, order, out_col: str, hot_rows: int | None = None) -> DataFrame:
    """``row_number()`` per key under ``order`` (callers spell out NULL
    placement, e.g. ``asc_nulls_last``, and append tie-breakers).

    A window holds all rows of a key in one task.  With ``hot_rows`` (``keys``
    then are column names), keys of more rows, NULL included, are ranked in
    ranges: see ``rank_in_ranges``."""
    w = Window.partitionBy(*_as_cols(keys)).orderBy(*_as_cols(order))

    def ranked(rows):
        return rows.withColumn(out_col, F.row_number().over(w))

    if hot_rows is None:
        return ranked(df)
    names = [keys] if isinstance(keys, str) else list(keys)
    cold, hot = split_hot(df, names, hot_rows)
    if hot is None:
        return ranked(df)
    return ranked(cold).unionByName(rank_in_ranges(hot, names, order, out_col, hot_rows))


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int, counts: DataFrame | None = None
              ) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the other keys, rows of the keys with more than ``hot_rows`` rows);
    None for the latter if there is no such key.  The counts are summed per task
    first; there are fewer hot keys than rows / ``hot_rows``.  ``counts`` counts
    the keys in other rows than ``df``, e.g. in a smaller table under it."""
    hot = cut_lineage((df if counts is None else counts).groupBy(*keys).count().filter(F.col("count") > hot_rows)
                      .select(*[F.col(k).alias(f"__hot_{k}") for k in keys]), "hot_keys")
    if hot.isEmpty():
        return df, None
    same = _same(keys, "__hot_")
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def rank_in_ranges(df: DataFrame, keys: Sequence[str], order, out_col: str, range_rows: int = R.HOT_ROWS) -> DataFrame:
    """``row_number()`` per key without a task that holds a key.

    The rows are dealt in ranges of (keys, order) of about half ``range_rows``
    each and sorted within them, so a row's number in its key is its number in its
    range plus the key's rows in the ranges before.  Those are counted from the
    written ranges: a row a key and range."""
    order = _as_cols(order)
    parts = max(2, math.ceil(2 * df.count() / range_rows))
    ranges = cut_lineage(df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
                         .withColumns({"__at": F.monotonically_increasing_id(), "__range": F.spark_partition_id()}), "ranges")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    begins = (ranges.groupBy(*keys, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
              .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
              .select(*[F.col(k).alias(f"__b_{k}") for k in keys], F.col("__range").alias("__of"), "__first", "__before"))
    numbered = ranges.join(begins, _same(keys, "__b_") & (F.col("__range") == F.col("__of")))
    return numbered.select(*df.columns, (F.col("__at") - F.col("__first") + F.col("__before") + 1).cast("int").alias(out_col))


def with_neighbours(df: DataFrame, keys: Sequence[str], order, taken: dict[str, tuple[str, int]],
                    hot_rows: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """``df`` with columns of the row before (-1) or after (1) within its key:
    ``taken`` is new column -> (column, -1 or 1); LAG and LEAD.

    With ``hot_rows``, keys of more rows are cut in pieces of that many by their
    rank, each with a copy of the last row of the piece before and of the first
    row of the piece after, so every row has its neighbours at hand and no task
    has the key.  ``counts``: see ``split_hot``."""
    def looked(rows, w):
        return rows.withColumns({out: (F.lag if step < 0 else F.lead)(c).over(w) for out, (c, step) in taken.items()})

    whole = Window.partitionBy(*keys).orderBy(*_as_cols(order))
    if hot_rows is None:
        return looked(df, whole)
    cold, hot = split_hot(df, keys, hot_rows, counts)
    if hot is None:
        return looked(df, whole)
    ranked = rank_in_ranges(hot, keys, order, "__rank", hot_rows)
    piece = F.expr(f"(__rank - 1) div {hot_rows}")
    ends = F.when(F.col("__rank") % hot_rows == 0, piece + 1)
    begins = F.when(((F.col("__rank") - 1) % hot_rows == 0) & (piece > 0), piece - 1)
    copies = ranked.withColumn("__piece", piece).withColumn(
        "__of", F.explode(F.filter(F.array("__piece", ends, begins), lambda x: x.isNotNull())))
    out = looked(copies, Window.partitionBy(*keys, "__of").orderBy("__rank")).filter("__of = __piece")
    return looked(cold, whole).unionByName(out.drop("__rank", "__piece", "__of"))
