"""Dense daily history (S19-S28): days x items, first known row, backfill at
the start date, carry the last known row forward, flag the selected items.

Only the *known points* move: the observed rows, plus one start-date point per
item that was not observed on that day.  One window over the item key gives
each point its first-known values and the next point.  The days that occur in
the facts are numbered (a calendar-bounded table), so a point answers for a
range of day numbers; it emits them with one ``explode`` after the last
exchange.  The grid - items x days, often many times the facts - is made where
it is written, never shuffled, and only of days that occur: one stray far date
adds one day.

Observed rows must be unique per (item, day); S15 upstream guarantees it.  Of
two on one day, each keeps its own row and one of them is carried on.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import cut_lineage

ITEM_KEYS = ("itemName", "it_product_id_array")
# attributes taken from the fact row, else (on the start date) the first known row
COALESCED = ("csu_main_category", "csu_subcategory", "csu_product", "csu_product_id", "csu_amount",
             "csu_unit", "csu_weight", "nove_poradi", "itemId_given_day", "itemUrl_given_day",
             "itemImage_given_day", "package_amount", "package_unit", "price_per_unit", "unit",
             "country")
# attributes only ever taken from the fact row
FACT_ONLY = ("currentPrice", "originalPrice")
# prices: from the fact row, else (start date) the first known row's
PRICES = ("csuRelevantPrice", "basePrice")


#: Days made by a task where they are written: its time goes with them, not with the bytes of its points.
PART_ROWS = 2_000_000

SELECTION_KEYS = ("csu_product", "itemName", "it_product_id_array")
SELECTION_COLS = ("items_in_category", "days_in_history", "avg_csuRelevantPrice", "min_csuRelevantPrice",
                  "max_csuRelevantPrice", "mean_coef_var", "order_cheapest")


def days_of(facts: DataFrame, date: str = "date") -> DataFrame:
    """(day_no, grid_date), the dates of the facts numbered from 0; a row
    a calendar day that occurs."""
    return facts.agg(F.array_sort(F.collect_set(date)).alias("days")).select(
        F.posexplode("days").alias("day_no", "grid_date"))


def days_table(facts: DataFrame, date: str = "date") -> DataFrame:
    """``days_of``, written once: a fill reads it several times."""
    return cut_lineage(days_of(facts, date), "days")


def first_known(facts: DataFrame, keys: Sequence[str] = ITEM_KEYS, date: str = "date",
                epoch: _dt.date = R.HISTORY_EPOCH, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Per item key, the first date and the fact row at that date
    (attributes NULL when the item has no dated fact), plus the start date."""
    w = Window.partitionBy(*keys).orderBy(F.col(date).asc_nulls_last(),
                                          *[F.col(t).asc_nulls_last() for t in tie_breakers])
    ranked = facts.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    has = F.col(date).isNotNull()
    other = [c for c in facts.columns if c not in keys]
    return ranked.select(*keys, F.col(date).alias("first_date"),
                         *[F.when(has, F.col(c)).alias(c) for c in other if c != date],
                         F.lit(epoch).alias("first_date_of_data"))


class _History:
    """The known points of a fact table and the days they answer for."""

    def __init__(self, facts: DataFrame, epoch: _dt.date | None, keys: Sequence[str], date: str, cols: Sequence[str],
                 as_of: _dt.date | None = None, days: DataFrame | None = None, part_rows: int | None = None):
        self.keys, self.date, self.epoch = list(keys), date, epoch
        self.types = {f.name: f.dataType for f in facts.schema.fields}
        days = days_table(facts, date) if days is None else days
        self.days = F.broadcast(days)
        # one row: the last day's number, that of the last day before as_of, whether the start date occurs
        known = days.agg(F.max("day_no").alias("last"), F.max(F.when(F.col("grid_date") < F.lit(as_of), F.col("day_no"))).alias("before"),
                         F.max(F.col("grid_date") == F.lit(epoch)).alias("occurs")).first()
        self.last_no, self.before = F.lit(known["last"]).cast("int"), F.lit(-1 if known["before"] is None else known["before"])
        keys_ok = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in self.keys])
        row = F.struct(*[F.col(c) for c in cols])
        obs = facts.filter(F.col(date).isNotNull() & keys_ok).select(
            *self.keys, F.col(date).alias("__d"), row.alias("__row"), F.lit(True).alias("__obs"))
        # one pass over the keys: which items have a dated row, which one on the start date
        at_start = F.lit(False) if epoch is None else F.coalesce(F.col(date) == F.lit(epoch), F.lit(False))
        items = facts.groupBy(*self.keys).agg(F.max(F.col(date).isNotNull()).alias("__dated"), F.max(at_start).alias("__seen"))
        pts, bare = obs, ~keys_ok | ~F.col("__dated")
        if epoch is not None:
            start = (items.filter(keys_ok & ~F.col("__seen")).select(
                *self.keys, F.lit(epoch).alias("__d"), F.lit(None).cast(obs.schema["__row"].dataType).alias("__row"),
                F.lit(False).alias("__obs")))
            pts = obs.unionByName(start)
            bare = ~keys_ok | (~F.col("__dated") & F.lit(not known["occurs"]))
        # a start date that never occurs is no grid day: the join drops its points
        numbered = self.days.select(F.col("grid_date").alias("__d"), F.col("day_no").alias("__no"))
        numbered = pts.join(F.broadcast(numbered), "__d").withColumn("__hash", F.xxhash64(*self.keys))
        parts = _parts(facts, self.keys, known["last"], part_rows) if part_rows else None
        if parts is not None:
            numbered = numbered.repartition(parts, "__hash", *self.keys)
        # a hash before the keys: rows are sorted by a number, not by names of which many begin alike
        w = Window.partitionBy("__hash", *self.keys).orderBy("__d", F.col("__obs").desc())
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # a point that was not observed has no row, so the first row there is is an observed one
        self.points = numbered.withColumns({
            "__first": F.first("__row", ignorenulls=True).over(whole),
            "__next": F.lead("__d").over(w), "__next_no": F.lead("__no").over(w),
            "__leads": F.row_number().over(w) == 1})
        #: items without a point: NULL keys, or nothing known
        self.bare = items.filter(bare).select(*self.keys)

    def emit(self, points: DataFrame) -> DataFrame:
        """A row per point and day it answers for: its own day, those up to the
        next point and, for an item's first point, those before it.  Adds
        ``__no_of_day`` and ``grid_date``."""
        last = F.when(F.col("__next_no").isNull(), F.col("__last")).otherwise(F.greatest(F.col("__next_no") - 1, F.col("__no")))
        first = F.when(F.col("__leads"), F.lit(0)).otherwise(F.col("__no"))
        rows = points.withColumn("__last", self.last_no).withColumn("__of", F.explode(F.sequence(first, last)))
        return rows.join(self.days, F.col("__of") == F.col("day_no")).drop("day_no", "__last")

    def bare_days(self) -> DataFrame:
        rows = self.bare.withColumn("__last", self.last_no).filter(F.col("__last").isNotNull())
        rows = rows.withColumn("__of", F.explode(F.sequence(F.lit(0), F.col("__last"))))
        return rows.join(self.days, F.col("__of") == F.col("day_no")).select("grid_date", *self.keys)

    def own(self) -> Column:
        """Whether the emitted day is an observed one."""
        return F.col("__obs") & (F.col("__of") == F.col("__no"))

    def null(self, c: str, name: str | None = None) -> Column:
        return F.lit(None).cast(self.types[c]).alias(name or c)


def _parts(facts: DataFrame, keys: Sequence[str], last_no: int | None, part_rows: int) -> int | None:
    """Tasks for days made in parts of about ``part_rows``: an item has as many days
    as any other, however few bytes its points are, so parts of equal bytes are too
    few and uneven.  At least the shuffle's partitions, so a join needs no other
    deal; None where there are too few days for that, which is then left to AQE."""
    items = facts.agg(F.approx_count_distinct(F.xxhash64(*keys)).alias("n")).first()["n"]
    wanted = math.ceil(items * ((-1 if last_no is None else last_no) + 1) / part_rows)
    least = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, least) if wanted > 1 and 8 * wanted >= least else None


def densify(facts: DataFrame, keys: Sequence[str] = ITEM_KEYS, date: str = "date") -> DataFrame:
    """Every (date occurring in facts) x (item key) with the fact row of
    that cell: ``grid_date``, ``grid_<key>``, every fact column (NULL on an
    unobserved cell), ``__observed``."""
    h = _History(facts, None, keys, date, facts.columns)
    own = h.own()
    grid_keys = [F.col(k).alias(f"grid_{k}") for k in keys]
    seen = h.emit(h.points).select("grid_date", *grid_keys, *[F.when(own, F.col(f"__row.`{c}`")).alias(c) for c in facts.columns],
                                   own.alias("__observed"))
    return seen.unionByName(h.bare_days().select("grid_date", *grid_keys, *[h.null(c) for c in facts.columns],
                                                 F.lit(False).alias("__observed")))


def backfill(facts: DataFrame, epoch: _dt.date = R.HISTORY_EPOCH, keys: Sequence[str] = ITEM_KEYS, date: str = "date",
             coalesced: Sequence[str] = COALESCED, fact_only: Sequence[str] = FACT_ONLY,
             prices: Sequence[str] = PRICES) -> DataFrame:
    """The grid with the first known row's attributes and prices
    (``first_<price>``) on the start date."""
    carried = (*coalesced, *fact_only, *prices)
    h = _History(facts, epoch, keys, date, carried)
    own, start = h.own(), F.col("grid_date") == F.lit(epoch)
    grid_keys = [F.col(k).alias(f"grid_{k}") for k in keys]
    cols = ["grid_date", *grid_keys]
    cols += [F.coalesce(F.when(own, F.col(f"__row.{c}")), F.when(start, F.col(f"__first.{c}"))).alias(c) for c in coalesced]
    cols += [F.when(own, F.col(f"__row.{c}")).alias(c) for c in fact_only]
    cols += [F.when(own, F.col("__d")).alias(date)]
    cols += [F.when(own, F.col(f"__row.{c}")).alias(c) for c in prices]
    cols += [F.when(start, F.col(f"__first.{c}")).alias(f"first_{c}") for c in prices]
    cols += [F.when(start, F.lit(epoch)).alias("first_date_of_data")]
    empty = ["grid_date", *grid_keys, *[h.null(c) for c in (*coalesced, *fact_only)], h.null(date),
             *[h.null(c) for c in prices], *[h.null(c, f"first_{c}") for c in prices],
             F.lit(None).cast("date").alias("first_date_of_data")]
    return h.emit(h.points).select(*cols).unionByName(h.bare_days().select(*empty))


def fill_spans(facts: DataFrame, as_of: _dt.date, epoch: _dt.date = R.HISTORY_EPOCH,
               keys: Sequence[str] = ITEM_KEYS, date: str = "date",
               coalesced: Sequence[str] = COALESCED, fact_only: Sequence[str] = FACT_ONLY,
               prices: Sequence[str] = PRICES, labels=(R.FILLED_LABEL, R.ORIGINAL_LABEL),
               selection: DataFrame | None = None, selection_keys: Sequence[str] = SELECTION_KEYS,
               selection_cols: Sequence[str] = SELECTION_COLS, days: DataFrame | None = None,
               part_rows: int | None = None) -> DataFrame:
    """S19-S27, with ``selection`` also S28, without the grid: a row per point and
    run of days on which it gives the same row, at most four a point.  Columns
    are those of ``fill_history`` but the date, and ``first_no``, ``last_no``,
    the run's first and last number among the days that occur.

    S28 joins the points: a day on which a point's state applies has the point's
    product and keys, so the selection is one row an item with an array of its
    attributes, and those of the point's product are exploded on those runs only
    (it repeats a run if the selection has a key more than once).  Joined by the
    item, the points stay as the window has dealt and sorted them.  Days from
    ``as_of`` on are left out then.  ``days``: ``days_table`` of the facts, if it is
    there already; ``part_rows``: days a task makes, see ``_parts``."""
    k = list(keys)
    h = _History(facts, epoch, keys, date, (*coalesced, *fact_only, *prices), as_of, days, part_rows)
    start = F.col("__d") == F.lit(epoch)
    # the state a point carries: its row, on the start date else the first known one
    state = [F.coalesce(F.col(f"__row.{c}"), F.when(start, F.col(f"__first.{c}"))).alias(c) for c in (*coalesced, *prices)]
    state += [F.col(f"__row.{c}").alias(c) for c in fact_only]
    own_prices = [F.col(f"__row.{p}").alias(f"__own_{p}") for p in prices]
    pts = h.points.select("__hash", *k, "__d", "__no", "__obs", "__next", "__next_no", "__leads", *state, *own_prices)
    extra, bare_extra = [], []
    if selection is not None:
        types = {f.name: f.dataType for f in selection.schema.fields}
        # equal values of two types have two hashes: those are compared as they are
        by_item = set(k) <= set(selection_keys) and all(types[c] == h.types[c] for c in k)
        on = k if by_item else list(selection_keys)
        others = [c for c in selection_keys if c not in on]
        keyed = selection.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in selection_keys]))
        chosen = keyed.select(*([F.xxhash64(*k).alias("__s___hash")] if by_item else []), *[F.col(c).alias(f"__s_{c}") for c in on],
                             F.struct(*[F.col(c).alias(f"__of_{c}") for c in others], *selection_cols).alias("__sel"))
        on = [*(["__hash"] if by_item else []), *on]
        chosen = chosen.groupBy(*[f"__s_{c}" for c in on]).agg(F.collect_list("__sel").alias("__chosen"))
        match = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__s_{c}") for c in on])
        pts = pts.join(chosen, match, "left").drop(*[f"__s_{c}" for c in on])
        if others:
            pts = pts.withColumn("__chosen", F.filter("__chosen", lambda s: reduce(
                lambda x, y: x & y, [s[f"__of_{c}"] == F.col(c) for c in others])))
    final = h.before if selection is not None else h.last_no
    rows = pts.withColumns({"__last": h.last_no, "__before": h.before, "__final": final})
    rows = rows.withColumn("__span", F.explode(_runs_of_a_point()))
    own, applies = F.col("__span.own"), F.col("__span.applies")
    if selection is not None:
        rows = rows.withColumn("__hit", F.explode_outer(F.when(applies, F.col("__chosen"))))
        extra = [F.col(f"__hit.{c}").alias(c) for c in selection_cols] + [F.col("__hit").isNotNull().cast("int").alias("to_include")]
        bare_extra = [F.lit(None).cast(types[c]).alias(c) for c in selection_cols] + [F.lit(0).alias("to_include")]
    out = [*[F.col(c) for c in k], *[F.when(applies, F.col(c)).alias(c) for c in (*coalesced, *fact_only)]]
    out += [F.when(own, F.col(f"__own_{p}")).when(applies, F.col(p)).alias(f"filled_{p}") for p in prices]
    out += [F.when(applies & ~own, F.coalesce(F.col("__next"), F.lit(as_of))).alias("filled_end_date"),
            F.when(own, F.lit(labels[1])).otherwise(F.lit(labels[0])).alias("filled")]
    span = [F.col("__span.first").alias("first_no"), F.col("__span.last").alias("last_no")]
    bare = h.bare.withColumn("last_no", final).filter(F.col("last_no") >= 0).select(
        *k, *[h.null(c) for c in (*coalesced, *fact_only)], *[h.null(p, f"filled_{p}") for p in prices],
        F.lit(None).cast("date").alias("filled_end_date"), F.lit(labels[0]).alias("filled"), *bare_extra,
        F.lit(0).alias("first_no"), "last_no")
    return rows.select(*out, *extra, *span).unionByName(bare)


def _runs_of_a_point() -> Column:
    """The days a point answers for as runs (first, last, own, applies): those
    before an item's first point, an observed day itself, the days on which its
    state is carried on (up to the next point, else to before ``as_of``) and,
    after an item's last point, the days from ``as_of`` on."""
    no, own_day, until_next = F.col("__no"), F.col("__obs"), F.col("__next_no").isNotNull()
    last = F.when(until_next, F.greatest(F.col("__next_no") - 1, no)).otherwise(F.col("__last"))
    carried_to = F.when(until_next, last).otherwise(F.least(F.col("__last"), F.col("__before")))
    after = F.when(own_day, no + 1).otherwise(no)

    def run(first, to, own: bool, applies: bool) -> Column:
        return F.struct(first.cast("int").alias("first"), F.least(to, F.col("__final")).cast("int").alias("last"),
                        F.lit(own).alias("own"), F.lit(applies).alias("applies"))

    # an empty run ends before it begins
    runs = F.array(run(F.lit(0), F.when(F.col("__leads"), no - 1).otherwise(F.lit(-1)), False, False),
                   run(no, F.when(own_day, no).otherwise(F.lit(-1)), True, True),
                   run(after, carried_to, False, True),
                   run(F.greatest(after, carried_to + 1), last, False, False))
    return F.filter(runs, lambda r: r["first"] <= r["last"])


def expand_spans(spans_: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """A row per day of each span: ``date``, then the other columns.  ``days`` is
    ``days_of`` the facts."""
    names = [c for c in spans_.columns if c not in ("first_no", "last_no")]
    rows = spans_.withColumn("__of", F.explode(F.sequence("first_no", "last_no")))
    return rows.join(F.broadcast(days), F.col("__of") == F.col("day_no")).select(F.col("grid_date").alias(date), *names)


def fill_history(facts: DataFrame, as_of: _dt.date, epoch: _dt.date = R.HISTORY_EPOCH, date: str = "date",
                 per_span: Callable[[DataFrame], DataFrame] | None = None, **kw) -> DataFrame:
    """The dense, filled daily history; with ``selection`` also S28.

    Output: date, item keys, coalesced attributes, fact-only attributes,
    ``filled_<price>`` per price, ``filled_end_date``, ``filled``; one row per
    (date occurring in the facts) x (item key).  The days are made from
    ``fill_spans`` (same parameters) after its last exchange.  ``per_span`` adds or
    changes columns of the spans that don't depend on the day: worked out once a
    run of days, not once a day."""
    days = days_table(facts, date)
    found = fill_spans(facts, as_of, epoch, date=date, days=days, **kw)
    return expand_spans(per_span(found) if per_span else found, days, date)


def fill_and_flag(facts: DataFrame, selection: DataFrame, as_of: _dt.date,
                  epoch: _dt.date = R.HISTORY_EPOCH, **kw) -> DataFrame:
    """The filled history before ``as_of`` with the selection's
    attributes and ``to_include``."""
    return fill_history(facts, as_of, epoch, selection=selection, **kw)


def history_spans(facts: DataFrame, as_of: _dt.date, epoch: _dt.date = R.HISTORY_EPOCH, date: str = "date", **kw) -> DataFrame:
    """``spans`` of the filled history without making it: the runs of the points,
    equal ones that touch joined.  Only points are shuffled, never days, and once
    for that: by a hash of all columns but floating ones, of which equal numbers
    can differ in bits.  It also leads the sort, which so seldom compares texts."""
    days = days_table(facts, date)
    found = fill_spans(facts, as_of, epoch, date=date, days=days, **kw)
    names = [c for c in found.columns if c not in ("first_no", "last_no")]
    hashed = F.xxhash64(*[f.name for f in found.schema.fields if f.name in names and not isinstance(f.dataType, (T.FloatType, T.DoubleType))])
    found = found.withColumn("__hash", hashed).repartition("__hash")
    w = Window.partitionBy("__hash", *names).orderBy("first_no", "last_no")
    reached = F.max("last_no").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first_no") <= reached + 1, 0).otherwise(1)
    runs = found.withColumn("__begins", begins).withColumn("__run", F.sum("__begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = runs.groupBy("__hash", *names, "__run").agg(F.min("first_no").alias("first_no"), F.max("last_no").alias("last_no"),
                                               F.sum(F.col("last_no") - F.col("first_no") + 1).alias("n_days"))
    ends = [F.broadcast(days.select(F.col("day_no").alias(f"{e}_no"), F.col("grid_date").alias(f"{e}_day"))) for e in ("first", "last")]
    return joined.join(ends[0], "first_no").join(ends[1], "last_no").select(*names, "first_day", "last_day", "n_days")


def spans(history: DataFrame, facts: DataFrame, date: str = "date") -> DataFrame:
    """The same rows with each unbroken run of days as one: all columns but the
    date, then ``first_day``, ``last_day`` and ``n_days``.  Lossless: the days
    of a span are the days of ``facts`` from first to last."""
    names = [c for c in history.columns if c != date]
    numbered = history.join(F.broadcast(days_of(facts, date)), F.col(date) == F.col("grid_date")).drop("grid_date")
    # equal rows share a key; runs are told apart by day number minus rank
    w = Window.partitionBy(*names).orderBy("day_no")
    runs = numbered.withColumn("__run", F.col("day_no") - F.dense_rank().over(w))
    return runs.groupBy(*names, "__run").agg(F.min(date).alias("first_day"), F.max(date).alias("last_day"),
                                             F.count("*").alias("n_days")).drop("__run")
