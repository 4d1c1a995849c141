"""Published aggregates (S29-S33): the weighted basket index and the
averages by category level."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Above every weight in millionths (decimal(12,6)); stands for none.
NO_WEIGHT = 10**12
PRICE = "filled_csuRelevantPrice"
LEVELS = ("csu_main_category", "csu_subcategory", "csu_product", "itemName")
LEVEL_NAMES = ("main", "sub", "product", "item")


def _index_rows(hist: DataFrame, as_of: _dt.date, price: str = PRICE, product: str = "csu_product") -> DataFrame:
    """The rows the index may use: priced, with a product, dated before as_of."""
    return hist.filter(F.col(price).isNotNull() & F.col(product).isNotNull() & (F.col(product) != "")
                       & F.col("date").isNotNull() & (F.col("date") < F.lit(as_of)))


#: Price and weight in one whole number, see ``with_packed_price``.
PACKED = "__packed"


def _packed(price: str, weight: str) -> Column:
    units = (F.col(price).cast("decimal(20,6)") * F.lit(Decimal(10**6))).cast("decimal(20,0)")
    parts = (F.col(weight).cast("decimal(12,6)") * F.lit(Decimal(10**6))).cast("decimal(12,0)")
    packed = units * F.lit(Decimal(NO_WEIGHT * 10)) + F.coalesce(parts, F.lit(Decimal(NO_WEIGHT)).cast("decimal(14,0)"))
    return packed.cast("decimal(38,0)")


def with_packed_price(rows: DataFrame, price: str = PRICE, weight: str = "csu_weight") -> DataFrame:
    """``rows`` with what ``cheapest_per_product_day`` takes the minimum of.  A
    filled history may bring it: made once a run of days (``per_span`` of
    ``history.fill_history``), not once a day."""
    return rows.withColumn(PACKED, _packed(price, weight))


def cheapest_per_product_day(hist: DataFrame, as_of: _dt.date, price: str = PRICE,
                             weight: str = "csu_weight", product: str = "csu_product") -> DataFrame:
    """(product, date, price, weight) of the cheapest filled row per product and
    day - of every row, not only the selected ones; of equal prices the one with
    the smallest weight, NULL last.

    Price and weight are packed into one whole number, so the minimum is a hash
    aggregate whose partial sums leave each task with one row a product and day:
    the grid is not shuffled or sorted."""
    rows = _index_rows(hist, as_of, price, product)
    packed = F.col(PACKED) if PACKED in hist.columns else _packed(price, weight)
    least = rows.groupBy(product, "date").agg(F.min(packed).alias("__least"))
    whole = F.lit(Decimal(NO_WEIGHT * 10)).cast("decimal(14,0)")
    part = F.pmod(F.col("__least"), whole)
    return least.select(
        product, "date",
        (((F.col("__least") - part) / whole).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("decimal(20,6)").alias(price),
        F.when(part < F.lit(Decimal(NO_WEIGHT)),
               part.cast("decimal(12,0)") * F.lit(Decimal("0.000001"))).cast("decimal(12,6)").alias(weight))


def weighted_index(hist: DataFrame, as_of: _dt.date, price: str = PRICE,
                   weight: str = "csu_weight", rank_by: str = "daily") -> DataFrame:
    """Per date, sum of cheapest price x weight (4 decimals) and its
    relative difference to the value on the last date.

    ``rank_by="daily"``: the cheapest filled price per product and day (the
    window the original names ``order_cheapest`` in this statement);
    ``"selection"``: the other reading of that name - rows whose selection
    rank by average price (``order_cheapest`` of the full history) is 1."""
    if rank_by == "daily":
        cheap = cheapest_per_product_day(hist, as_of, price, weight)
    elif rank_by == "selection":
        cheap = _index_rows(hist, as_of, price).filter(F.col("order_cheapest") == 1)
    else:
        raise ValueError(f"rank_by must be 'daily' or 'selection', not {rank_by!r}")
    # price (< 10^14) x weight (< 10^6) as decimal(20,6) x decimal(12,6): the
    # product keeps all 12 places; wider operands would make Spark round each
    # product to 7 places before the sum (precision-loss rule)
    product = F.col(price).cast("decimal(20,6)") * F.col(weight).cast("decimal(12,6)")
    daily = cheap.groupBy("date").agg(F.round(F.sum(product), 4).cast("decimal(38,4)").alias("vazena_suma"))
    # The per-date sums hold one row per calendar day (a few thousand rows
    # for years of history), so the last day's value is read with a frame
    # over that small table in the same pass; a scalar subquery would
    # evaluate the whole chain under ``daily`` a second time.
    days = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.last(F.struct(F.col("date").alias("d"), F.col("vazena_suma").alias("v"))).over(days)
    with_last = daily.withColumn("__last", last).select(
        "date", "vazena_suma", F.col("__last.d").alias("last_date"),
        F.col("__last.v").alias("vazena_suma_last_date"))
    return with_last.withColumn(
        "perc_diff_last_day",
        F.try_divide((F.col("vazena_suma") - F.col("vazena_suma_last_date")).cast("double"),
                     F.col("vazena_suma_last_date").cast("double")))


def _included(hist: DataFrame, price: str) -> DataFrame:
    return hist.filter((F.col("to_include") == 1) & F.col(price).isNotNull())


def rollup_avg(hist: DataFrame, depth: int, price: str = PRICE, out: str = "csuRelevantPrice",
               levels: Sequence[str] = LEVELS) -> DataFrame:
    """Average filled price by date and the first ``depth`` levels,
    over included rows with a price."""
    cols = ["date", *levels[:depth]]
    return _included(hist, price).groupBy(*cols).agg(F.avg(price).alias(out))


def rollup_all_levels(hist: DataFrame, price: str = PRICE, out: str = "csuRelevantPrice",
                      levels: Sequence[str] = LEVELS) -> DataFrame:
    """S30-S33 in one pass; ``level`` = how many category levels the row is
    grouped by (1 main ... 4 item).

    The history is summed once, to (date, all levels); the four levels come
    from those sums and counts (grouping sets over them, not over the grid),
    so the averages are exact.  Levels are told apart by ``grouping_id``
    because the category columns can be NULL themselves."""
    items = _included(hist, price).groupBy("date", *levels).agg(
        F.sum(F.col(price).cast("decimal(24,6)")).alias("__sum"), F.count(price).alias("__n"))
    sets = [["date", *levels[:d]] for d in range(1, len(levels) + 1)]
    # the sums in 32 digits leave the quotient room for its places
    mean = F.sum(F.col("__sum").cast("decimal(28,6)")).cast("decimal(32,6)") / F.sum("__n").cast("decimal(20,0)")
    g = (items.groupingSets([[F.col(c) for c in s] for s in sets], "date", *levels)
         .agg(mean.cast("decimal(28,10)").alias(out), F.grouping_id().alias("__gid")))
    # grouping_id() spans date too, but date is in every set: its bit is 0
    depth = F.lit(len(levels))
    for i in range(len(levels) + 1):
        depth = depth - F.col("__gid").bitwiseAND(1 << i).cast("boolean").cast("int")
    return g.withColumn("level", depth.cast("int")).drop("__gid")


def split_levels(all_levels: DataFrame, out: str = "csuRelevantPrice", levels: Sequence[str] = LEVELS,
                 ) -> list[DataFrame]:
    """The four average tables from one ``rollup_all_levels`` result."""
    return [all_levels.filter(F.col("level") == d).select("date", *levels[:d], out)
            for d in range(1, len(levels) + 1)]
