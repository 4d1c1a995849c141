"""Product selection (F11) and the weighted index."""

import datetime as dt
from decimal import Decimal

import pytest

from pricebasket.operators import index as X
from pricebasket.operators import selection as S

FACTS = ("csu_product string, itemName string, it_product_id_array string, country string, nove_poradi int, "
         "unit string, package_amount decimal(18,4), package_unit string, csu_unit string, "
         "csu_amount decimal(18,4), date date, csuRelevantPrice decimal(24,6)")


def _row(item, day, price, product="Mléko"):
    return (product, item, f"[{len(item)}]", None, 1, "l", Decimal(1), "ks", "l", Decimal(1),
            dt.date(2020, 1, day), Decimal(price))


def test_selection_statistics(spark):
    # averages 10, 12, 14 -> stddev 2, mean 12, coef 1/6, distances -2 0 2, ranks 1 2 3
    rows = [_row("a", 1, 9), _row("a", 2, 11), _row("b", 1, 12), _row("b", 2, 12), _row("c", 1, 14),
            _row("c", 2, 14), _row("z", 1, 1)]
    out = sorted(S.select_products(spark.createDataFrame(rows, FACTS), min_days=2, unwanted_items=()).collect(),
                 key=lambda r: r.order_cheapest)
    assert [r.itemName for r in out] == ["a", "b", "c"]  # z has one day: below min_days
    assert [float(r.avg_csuRelevantPrice) for r in out] == [10, 12, 14]
    assert out[0].stddev_avg_csuRelevantPrice == pytest.approx(2)
    assert out[0].mean_coef_var == pytest.approx(1 / 6)
    assert [r.diff_from_mean for r in out] == pytest.approx([-2, 0, 2])
    assert [r.avg_price_diff_from_prev for r in out] == [None, 10, 12]
    assert {r.items_in_category for r in out} == {3}


def test_selection_single_item_and_unwanted(spark):
    rows = [_row("sušené droždí", 1, 5, "Droždí"), _row("kostka", 1, 7, "Droždí")]
    out = S.select_products(spark.createDataFrame(rows, FACTS), min_days=1).collect()
    assert [r.itemName for r in out] == ["kostka"]
    assert out[0].stddev_avg_csuRelevantPrice is None and out[0].mean_coef_var is None


def test_weighted_index(spark):
    # day 1 -> 9*2 + 4 = 22, day 2 -> 10*2 + 5 = 25; relative to the last day
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    rows = [("P", d1, "i1", 10, 2), ("P", d1, "i2", 9, 2), ("Q", d1, "i3", 4, 1),
            ("P", d2, "i1", 10, 2), ("Q", d2, "i3", 5, 1), ("Q", dt.date(2020, 1, 9), "i3", 99, 1)]
    hist = spark.createDataFrame(
        [(p, d, i, "[1]", Decimal(v), Decimal(w)) for p, d, i, v, w in rows],
        "csu_product string, date date, itemName string, it_product_id_array string, "
        "filled_csuRelevantPrice decimal(24,6), csu_weight decimal(18,6)")
    out = {r.date: r for r in X.weighted_index(hist, as_of=dt.date(2020, 1, 5)).collect()}
    assert float(out[d1].vazena_suma) == 22 and float(out[d2].vazena_suma) == 25
    assert out[d1].perc_diff_last_day == pytest.approx(-0.12) and out[d2].perc_diff_last_day == 0
    assert out[d1].last_date == d2


def test_weighted_index_selection_reading(spark):
    # The rank filter read as the selection's average-price rank
    d1 = dt.date(2020, 1, 1)
    rows = [("P", d1, "cheap-on-average", 10, 2, 1), ("P", d1, "cheap-today", 9, 2, 2), ("Q", d1, "q", 4, 1, None)]
    hist = spark.createDataFrame(
        [(p, d, i, "[1]", Decimal(v), Decimal(w), o) for p, d, i, v, w, o in rows],
        "csu_product string, date date, itemName string, it_product_id_array string, "
        "filled_csuRelevantPrice decimal(24,6), csu_weight decimal(18,6), order_cheapest int")
    daily = X.weighted_index(hist, as_of=dt.date(2020, 1, 5)).collect()[0]
    sel = X.weighted_index(hist, as_of=dt.date(2020, 1, 5), rank_by="selection").collect()[0]
    assert float(daily.vazena_suma) == 9 * 2 + 4 and float(sel.vazena_suma) == 10 * 2


def test_split_levels_equals_separate_rollups(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    rows = [(d1, "M", "S", "P", "i1", 10, 1), (d1, "M", "S", "P", "i2", 20, 1), (d1, "M", None, "P", "i3", 5, 1),
            (d2, "M", "S", "Q", "i4", 7, 1), (d2, None, "S", "Q", "i5", 3, 0), (d2, "M", "S", "Q", "i6", None, 1)]
    hist = spark.createDataFrame(
        [(d, m, s, p, i, None if v is None else Decimal(v), t) for d, m, s, p, i, v, t in rows],
        "date date, csu_main_category string, csu_subcategory string, csu_product string, itemName string, "
        "filled_csuRelevantPrice decimal(24,6), to_include int")
    for depth, part in enumerate(X.split_levels(X.rollup_all_levels(hist)), start=1):
        want = X.rollup_avg(hist, depth)
        assert part.columns == want.columns
        assert sorted(part.collect(), key=str) == sorted(want.collect(), key=str)
