"""Row operators and the semantic traps of SURVEY 1.4."""

import datetime as dt

from pyspark.sql import functions as F

from pricebasket.functions.cells import div0, initcap_first, initcap_words, to_number_whole
from pricebasket.operators import rows as RW


def test_null_position_ranks_last(spark):
    # positions a=2, b=NULL, c=1 in one basket line -> c=1, a=2, b=3
    df = spark.createDataFrame([("L", "a", 2), ("L", "b", None), ("L", "c", 1)],
                               "line string, name string, pos int")
    out = RW.rank_within(df, "line", [F.col("pos").asc_nulls_last(), F.col("name")], "rk")
    assert {r.name: r.rk for r in out.collect()} == {"c": 1, "a": 2, "b": 3}


def test_latest_per_key_skips_null_dates_and_empty_names(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(1, "old", d(2020, 1, 1)), (1, "new", d(2020, 1, 2)), (1, "none", None), (1, "", d(2020, 1, 3)),
         (2, None, d(2020, 1, 1)), (None, "x", d(2020, 1, 5))],
        "itemId long, itemName string, date date")
    out = RW.latest_per_key(df, "itemId", "date", [F.col("itemName")], non_empty_cols=["itemName"])
    assert [(r.itemId, r.itemName) for r in out.collect()] == [(1, "new")]


def test_drop_where_keeps_null_predicates(spark):
    # (match, stringSearch) goes; (match, urlSearch) and (NULL, stringSearch) stay
    df = spark.createDataFrame([("X", "stringSearch"), ("X", "urlSearch"), (None, "stringSearch")],
                               "ident string, st string")
    out = RW.drop_where(df, (F.col("ident") == "X") & (F.col("st") == "stringSearch"))
    assert sorted(out.collect(), key=str) == sorted([("X", "urlSearch"), (None, "stringSearch")], key=str)


def test_classify_first_match_wins(spark):
    rules = (("K", 5, 1, "stringSearch"), ("K", 6, 2, "stringSearch"), ("K", None, None, "urlSearch"))
    df = spark.createDataFrame([("K", 5, 1), ("K", 6, 2), ("K", 5, 2), ("M", 5, 1)],
                               "itesco_nazev string, productId long, poradi int")
    out = RW.classify(df, "searchType", rules, ["itesco_nazev", "productId", "poradi"], "stringSearch")
    got = {(r.itesco_nazev, r.productId, r.poradi): r.searchType for r in out.collect()}
    assert got == {("K", 5, 1): "stringSearch", ("K", 6, 2): "stringSearch",
                   ("K", 5, 2): "urlSearch", ("M", 5, 1): "stringSearch"}


def test_top_n_per_key_total_order(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    out = RW.top_n_per_key(df, "k", [F.col("v").asc()], 2)
    assert sorted(out.collect()) == [("a", 1), ("a", 2), ("b", 5)]


def test_cells(spark):
    df = spark.createDataFrame(
        [("30", "1.5"), ("30", "0"), (None, "2"), ("70.4", "1"), ("70.5", "1")], "a string, b string")
    a, b = F.col("a").try_cast("decimal(18,2)"), F.col("b").try_cast("decimal(18,4)")
    out = df.select(div0(a, b).cast("decimal(18,2)").alias("q"), to_number_whole("a").alias("n")).collect()
    assert [r.q for r in out][:3] == [20, 0, None]
    assert [int(r.n) for r in out if r.n is not None][-2:] == [70, 71]
    names = spark.createDataFrame([("ČESNEK SUCHÝ",), ("FERNET STOCK",)], "n string")
    r = names.select(initcap_first("n").alias("f"), initcap_words("n").alias("w")).collect()
    assert r[0].f == "Česnek suchý" and r[1].w == "Fernet Stock"


def test_more_traps(spark):
    from pricebasket.functions.cells import safe_div
    from pricebasket.operators import candidates as C
    from pricebasket.operators import identity as I

    # A zero divisor gives NULL, not an error
    assert spark.range(1).select(safe_div(F.lit(1.0), F.lit(0.0)).alias("x")).first().x is None
    # A short URL gives '' as barcode, a legitimate key
    r = spark.createDataFrame([("https://a/b",)], "u string").select(I.barcode_from_url("u").alias("k")).first()
    assert r.k == ""
    # A NULL line id makes a NULL ident, which no block-list entry removes
    hits = spark.createDataFrame([("T", 5, 1)], "itesco_nazev string, productId long, poradi int")
    res = spark.createDataFrame([("T", None, "Line", None)],
                                "itesco_nazev string, csu_id string, csu_nazev string, itesco_notes string")
    names = spark.createDataFrame([], "itemId long, itemName string, itemUrl string")
    cands = C.build_candidates(C.label_search_type(hits), res, names)
    bl = spark.createDataFrame([("5_",)], "id string")
    out = C.apply_blocklist(cands, bl).collect()
    assert len(out) == 1 and out[0].productId_csuId_ident is None
