"""Price normalisation: worked examples F4-F8."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from pricebasket.operators import prices as P

DET = ("itemId long, price_new string, package_amount string, unit_price_per_unit string, "
       "package_unit string, title string")


def test_unit_price_examples(spark):
    # F4
    facts = spark.createDataFrame([
        ("a", [1], 1, "30", ""), ("b", [2], 2, "30", ""), ("c", [3], 3, "30", ""),
        ("d", [7], 7, "70.4", ""), ("e", [8], 8, "70.5", ""), ("f", [4], 4, "10", "9.90")],
        "tag string, found_product_ids array<long>, itemId_given_day long, basePrice string, originalPrice string")
    details = spark.createDataFrame([
        (1, "100", "1.5", "kg", "", "x"), (2, "100", "0", "", "ks", "x"), (3, "100", "", None, "ks", "x"),
        (7, "100", "1", "", "", "x"), (8, "100", "0.5", "", "", "x"), (4, "2", "0.25", "", "", "x")], DET)
    out = {r.tag: r for r in P.unit_price(facts, details, per_kilo_items=(7, 8)).collect()}
    assert out["a"].price_per_unit == Decimal("20.00") and out["a"].unit == "kg"
    assert out["b"].price_per_unit == Decimal("0.00") and out["b"].unit == "ks"
    assert out["c"].price_per_unit is None and out["c"].unit is None
    assert out["d"].price_per_unit == Decimal("70.40")
    assert out["e"].price_per_unit == Decimal("70.50")
    assert out["f"].price_per_unit == Decimal("40.00") and out["f"].flag == 5
    assert out["f"].ppu_final == Decimal("9.90")


def test_either_id_details_keep_multiplicity(spark):
    facts = spark.createDataFrame([([1, 2], 1, "10", ""), ([5], 5, "10", "")],
                                  "found_product_ids array<long>, itemId_given_day long, basePrice string, originalPrice string")
    details = spark.createDataFrame([(1, "1", "1", "", "", "t1"), (2, "1", "2", "", "", "t2")], DET)
    out = P.unit_price(facts, details).collect()
    assert sorted((r.itemId_given_day, r.title) for r in out if r.itemId_given_day == 1) == [(1, "t1"), (1, "t2")]
    assert [(r.itemId, r.title) for r in out if r.itemId_given_day == 5] == [(None, None)]


def _stale(spark, rows):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, d), o, Decimal(p), "x", None) for d, o, p in rows],
        "itemId_given_day long, date date, originalPrice string, ppu_final decimal(18,2), "
        "productId_csuId_ident string, flag double")
    return [r.price_per_unit for r in P.fix_stale_discount(df).orderBy("date").collect()]


def test_stale_discount(spark):
    # '' next and non-empty previous -> previous final price; a missing next row is not ''
    assert _stale(spark, [(1, "20", "10"), (2, "", "5"), (3, "", "10")]) == [10, 10, 10]
    assert _stale(spark, [(1, "20", "10"), (2, "", "5")]) == [10, 5]


def test_placeholder_dedupe(spark):
    # F6
    df = spark.createDataFrame([([1], dt.date(2020, 1, 1), "Do not use", Decimal(1), "a", 1),
                                ([1], dt.date(2020, 1, 1), "Milk", Decimal(9), "a", 1)],
                               "found_product_ids array<long>, date date, title string, "
                               "price_per_unit decimal(18,2), productId_csuId_ident string, itemId_given_day long")
    assert [r.title for r in P.dedupe_placeholders(df).collect()] == ["Milk"]


def test_basket_price_rules(spark):
    # F7
    df = spark.createDataFrame([
        ("Kiwi", "ks", "kg", "3", "0", "1"), ("X", "ks", "g", "200", "0", "150"),
        ("X", "ks", "bal.", "0", "15.90", "1"), ("X", "ks", "kg", "3", "0", "2")],
        "product string, pu string, bu string, ppu string, base string, amount string")
    dec = lambda c, t="decimal(18,2)": F.col(c).cast(t)
    out = df.select(P.basket_price(F.col("product"), F.col("pu"), F.col("bu"), dec("ppu"), dec("base"),
                                   dec("amount", "decimal(18,4)")).alias("p")).collect()
    assert [float(r.p) for r in out] == [37.5, 30.0, 15.9, 6.0]


def test_product_names(spark):
    # F8
    df = spark.createDataFrame([("ČESNEK SUCHÝ",), ("FERNET STOCK",), ("PRAVÝ ITALSKÝ VERMUT",)], "n string")
    assert [r.p for r in df.select(P.product_name(F.col("n")).alias("p")).collect()] == [
        "Česnek suchý", "Fernet Stock", "Pravý italský Vermut"]
