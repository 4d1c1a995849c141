"""The pipeline's fixed values, through the operators' default rules."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from pricebasket.functions import rules as R
from pricebasket.operators import candidates as C
from pricebasket.operators import prices as P


def test_search_labels(spark):
    hits = spark.createDataFrame(
        [("KAKAOVÝ PRÁŠEK", 2005100242357, 1), ("KAKAOVÝ PRÁŠEK", 2005100241989, 2),
         ("KAKAOVÝ PRÁŠEK", 2005100241989, 1), ("MLÉKO", 1, 1), ("KAKAOVÝ PRÁŠEK", 2005100242357, 1)],
        "itesco_nazev string, productId long, poradi int")
    out = C.label_search_type(hits).collect()
    assert len(out) == 4  # distinct first
    got = {(r.productId, r.poradi, r.itesco_nazev): r.searchType for r in out}
    assert got[(2005100242357, 1, "KAKAOVÝ PRÁŠEK")] == "stringSearch"
    assert got[(2005100241989, 2, "KAKAOVÝ PRÁŠEK")] == "stringSearch"
    assert got[(2005100241989, 1, "KAKAOVÝ PRÁŠEK")] == "urlSearch"
    assert got[(1, 1, "MLÉKO")] == "stringSearch"


def test_hand_picked_products(spark):
    d = dt.date
    hist = spark.createDataFrame(
        [(2001020257049, "Okurky old", "u1", d(2020, 1, 1)), (2001020257049, "Okurky", "u2", d(2020, 1, 2)),
         (2001019074868, "Broskve", "u3", d(2020, 1, 1)), (2001020091629, "Rama", "u4", d(2020, 1, 1)),
         (12345, "Other", "u5", d(2020, 1, 1))],
        "itemId long, itemName string, itemUrl string, date date")
    out = {r.productId: r for r in C.manual_supplement(hist, C.manual_rules_frame(spark)).collect()}
    assert set(out) == {2001020257049, 2001019074868, 2001020091629}
    r = out[2001020257049]
    assert (r.productId_csuId_ident, r.csu_nazev, r.itesco_nazev, r.itemName, r.searchType, r.csu_id, r.poradi) == (
        "2001020257049_E01_173_02", "STERILOVANÉ OKURKY", "NAKLÁDANÉ OKURKY", "Okurky", "manualSearch",
        "E01_173_02", None)
    assert out[2001019074868].csu_nazev == "KOMPOT MERUŇKOVÝ (EVENT. BROSKVOVÝ)"
    assert out[2001020091629].itesco_nazev == "MARGARÍN"
    assert sum(len(ids) for *_, ids in R.MANUAL_PRODUCTS) == 23


def test_known_duplicate_and_blocklist(spark):
    cands = spark.createDataFrame(
        [("2005100242357_E01_213_01", "stringSearch", 2005100242357), ("2005100242357_E01_213_01", "urlSearch", 2005100242357),
         ("7_E01_111_01", "stringSearch", 7), ("8_E01_111_01", "stringSearch", 8)],
        "productId_csuId_ident string, searchType string, productId long")
    for c in C.CANDIDATE_COLUMNS:
        if c not in cands.columns:
            cands = cands.withColumn(c, F.lit(None).cast("int" if c == "poradi" else "string"))
    bl = C.clean_blocklist(spark.createDataFrame([(" 8_E01_111_01 ",)], "id string"))
    out = sorted((r.productId_csuId_ident, r.searchType) for r in C.clean_candidates(cands, bl, []).collect())
    assert out == [("2005100242357_E01_213_01", "urlSearch"), ("7_E01_111_01", "stringSearch")]


def test_per_kilo_item_and_piece_rules(spark):
    facts = spark.createDataFrame([([2001120571270], 2001120571270, "75", ""), ([2001120571270], 2001120571270, "70.4", "")],
                                  "found_product_ids array<long>, itemId_given_day long, basePrice string, originalPrice string")
    det = spark.createDataFrame([(2001120571270, "1", "0.5", "", "kg")],
                                "itemId long, price_new string, package_amount string, unit_price_per_unit string, package_unit string")
    ppu = sorted(r.price_per_unit for r in P.unit_price(facts, det).collect())
    assert ppu == [Decimal("75.00"), Decimal("140.80")]  # above 70: kept as a per-kilo price
    df = spark.createDataFrame([("Česnek suchý", "ks", "kg"), ("Okurky salátové", "ks", "kg"), ("Kiwi", "kg", "kg")],
                               "p string, pu string, bu string")
    one = F.lit(1).cast("decimal(18,2)")
    got = [float(r.x) for r in df.select(P.basket_price(F.col("p"), F.col("pu"), F.col("bu"), one, one,
                                                        F.lit(1).cast("decimal(18,4)")).alias("x")).collect()]
    assert got == [20.0, 3.6, 1.0]
