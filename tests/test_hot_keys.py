"""Keys with most of the rows: ranks, neighbours and statistics equal the plain
windows', and no task holds the key."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricebasket import session
from pricebasket.operators import identity as I
from pricebasket.operators import prices as P
from pricebasket.operators import rows as R
from pricebasket.operators import selection as S


def rows_of(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def skewed(spark, seed, n=400, hot=None):
    """(key, day, id): nine tenths of the rows have the hot key."""
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(hot if rng.random() < 0.9 else rng.choice(["a", "b", "c"]), rng.choice([None, *range(30)]), i) for i in range(n)],
        "key string, day int, id int").repartition(5)


def order():
    return [F.col("day").asc_nulls_last(), F.col("id").asc()]


@pytest.mark.parametrize("hot", [None, "h"])
@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_ranks_equal_the_window(spark, hot, limit):
    df = skewed(spark, limit, hot=hot)
    cuts = {}
    with session.watch_cuts(lambda name, cut: cuts.setdefault(name, cut)):
        got = R.rank_within(df, "key", order(), "rank", hot_rows=limit)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order())))
    assert got.schema["rank"].dataType == want.schema["rank"].dataType and got.columns == want.columns
    assert rows_of(got, want.columns) == rows_of(want, want.columns)
    assert ("ranges" in cuts) == (limit < 400)
    if limit == 50:  # ranges hold about half the limit, never the key
        assert cuts["ranges"].groupBy("__range").count().agg(F.max("count")).first()[0] <= 2 * limit


@pytest.mark.parametrize("limit", [1, 2, 13, 100])
@pytest.mark.parametrize("hot", [None, "h"])
def test_neighbours_equal_the_window(spark, hot, limit):
    df = skewed(spark, 3 * limit, hot=hot)
    w = Window.partitionBy("key").orderBy(*order())
    want = df.withColumns({"p": F.lag("id").over(w), "n": F.lead("id").over(w), "pd": F.lag("day").over(w)})
    got = R.with_neighbours(df, ["key"], order(), {"p": ("id", -1), "n": ("id", 1), "pd": ("day", -1)}, limit)
    assert got.columns == want.columns
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_rerank_of_hits_without_a_line(spark):
    """90 % of the candidates have no basket line."""
    rng = random.Random(5)
    cands = spark.createDataFrame(
        [(None if rng.random() < 0.9 else "MILK", rng.choice([None, *range(8)]), f"{i}_x", i, None) for i in range(300)],
        "csu_nazev string, poradi int, productId_csuId_ident string, productId long, productId_alt long")
    want = I.rerank(cands)
    assert rows_of(I.rerank(cands, hot_rows=20), want.columns) == rows_of(want, want.columns)


@pytest.mark.parametrize("by_counts", [False, True])
def test_stale_discount_of_a_hot_item(spark, by_counts):
    rng = random.Random(9)
    data = []
    for i in range(500):
        item = 7 if rng.random() < 0.8 else rng.choice([None, 1, 2])
        data.append((item, dt.date(2020, 1, 1) + dt.timedelta(i), rng.choice(["", "", "30", None]), Decimal(rng.randint(1, 99)), "x", f"{i}"))
    daily = spark.createDataFrame(data, "itemId_given_day long, date date, originalPrice string, ppu_final decimal(18,2), "
                                        "productId_csuId_ident string, p_key string").repartition(4)
    want = P.fix_stale_discount(daily)
    counts = daily.select("itemId_given_day") if by_counts else None
    got = P.fix_stale_discount(daily, hot_rows=30, counts=counts)
    assert got.columns == want.columns and rows_of(got, want.columns) == rows_of(want, want.columns)
    assert got.filter("price_per_unit is null").count() == 0


FACTS = ("csu_product string, itemName string, it_product_id_array string, country string, nove_poradi int, "
         "unit string, package_amount decimal(18,4), package_unit string, csu_unit string, "
         "csu_amount decimal(18,4), date date, csuRelevantPrice decimal(24,6)")


def facts(spark, seed=2, items=60):
    rng = random.Random(seed)
    data = []
    for i in range(items):
        product = None if rng.random() < 0.7 else rng.choice(["Milk", "Rye"])
        for _ in range(rng.randint(1, 12)):
            day = rng.choice([None, dt.date(1950, 1, 1), dt.date(3019, 5, 5), *(dt.date(2020, 1, 1 + rng.randrange(9)) for _ in range(6))])
            price = None if rng.random() < 0.2 else Decimal(rng.randint(1, 40))
            data.append((product, f"i{i}", f"[{i}]", None, 1, "l", Decimal(1), "ks", "l", Decimal(1), day, price))
    return spark.createDataFrame(data, FACTS)


def test_selection_of_a_hot_product(spark):
    f = facts(spark)
    want = S.select_products(f, 2, ())
    cuts = []
    with session.watch_cuts(lambda name, cut: cuts.append(name)):
        got = S.select_products(f, 2, (), materialize=lambda g: session.cut_lineage(g, "items"), hot_rows=5)
    assert cuts[0] == "items" and "ranges" in cuts
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_days_by_bitmap_are_the_distinct_days(spark):
    """Repeated, missing and stray days (outside the bitmap's years) included."""
    f = facts(spark, 4)
    got = f.groupBy("itemName").agg(S.distinct_days().alias("days"))
    want = f.groupBy("itemName").agg(F.count_distinct("date").alias("days"))
    assert rows_of(got, want.columns) == rows_of(want, want.columns)
    edge = [S.BITMAP_FIRST + dt.timedelta(d) for d in (-1, 0, 1, S.BITMAP_DAYS - 1, S.BITMAP_DAYS, S.BITMAP_DAYS)]
    assert spark.createDataFrame([(d,) for d in edge], "date date").agg(S.distinct_days()).first()[0] == 5
    plan = f.groupBy("itemName").agg(S.distinct_days())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_whole_number_reading_is_a_parameter(spark):
    from pricebasket.functions.cells import to_number_whole

    df = spark.createDataFrame([("70.4",), ("70.5",), ("",), ("x",)], "p string")
    assert [r[0] for r in df.select(to_number_whole("p") > 70).collect()] == [False, True, None, None]
    assert [r[0] for r in df.select(to_number_whole("p", round_first=False) > 70).collect()] == [True, True, None, None]
