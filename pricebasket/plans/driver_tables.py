"""The operators run on the driver's generated tables.

Each query maps driver tables onto the column names an operator expects,
calls the operator, and projects a comparable result.  The matching DuckDB
SQL is in ``oracle.py``.  Every query reads whole tables.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import initcap_first
from ..operators import candidates as C
from ..operators import history as H
from ..operators import identity as I
from ..operators import index as X
from ..operators import prices as P
from ..operators import rows as RW
from ..operators import selection as S
from ..session import cut_lineage

AS_OF = _dt.date(2024, 1, 31)
EPOCH = _dt.date(2024, 1, 1)
TOP = 4
MIN_DAYS_PARTS = 30
MIN_DAYS_USERS = 27
# driver-table stand-ins for the rule lists (data of the test, not of the pipeline)
SEGMENT_LINES = (("AUTOMOBILE", 0), ("BUILDING", 1), ("FURNITURE", 2))
UNWANTED_PARTS = (("Brand#13", "%ring%"), ("Brand#13", "%BOLT%"))
UNWANTED_USERS = (("Building", "%00001%"), ("Building", "%9"))
PLACEHOLDER_KINDS = ("error", "signup")
ORDER_RULES = (("1-URGENT", "F", "stringSearch"), ("1-URGENT", "O", "stringSearch"),
               ("1-URGENT", None, "urlSearch"))
# basket-product names given to (return flag, line status) of lineitem
FLAG_NAMES = (("A", "F", "ČESNEK SUCHÝ"), ("A", "O", "KIWI"), ("N", "F", "OKURKY SALÁTOVÉ"),
              ("N", "O", "FERNET STOCK"), ("R", "F", "PRAVÝ ITALSKÝ VERMUT"),
              ("R", "O", "KARLOVARSKÁ BECHEROVKA"))
BASKET_UNITS = (("ECONOMY", "kg"), ("SMALL", "g"), ("STANDARD", "bal."), ("PROMO", "ks"),
                ("MEDIUM", "l"))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def dec2_text(c):
    return c.cast("decimal(18,2)").cast("string")


def scaled(c, factor: str):
    """A 2-decimal amount times an exact decimal factor (no float rounding;
    operand types stay narrow so Spark never trims the product's scale)."""
    return c.cast("decimal(18,2)") * F.lit(Decimal(factor))


# ---------------------------------------------------------------- shared views

def price_points(spark: SparkSession, d: str) -> DataFrame:
    """px: latest event per (user, day) -> item, d, price, kind, event_id."""
    ev = table(spark, d, "events").withColumn("d", F.to_date("ts"))
    last = RW.latest_per_key(ev, ["user_id", "d"], "ts", tie_breakers=[F.col("event_id").desc()])
    return last.select(F.col("user_id").alias("item"), "d", F.col("value").alias("price"),
                       F.col("event_type").alias("kind"), "event_id", "props")


def price_facts(spark: SparkSession, d: str) -> DataFrame:
    """The daily fact table over px: users are items, market segment the
    basket product, nation / region the categories, nation the weight."""
    px = price_points(spark, d)
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (px.join(c, px["item"] == c["c_custkey"], "left")
           .join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
           .join(r, F.col("n_regionkey") == r["r_regionkey"], "left"))
    price = F.col("price").cast("decimal(18,2)")
    unit = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("l")).otherwise(F.lit("kg"))
    return j.select(
        initcap_first("r_name").alias("csu_main_category"),
        initcap_first("n_name").alias("csu_subcategory"),
        initcap_first("c_mktsegment").alias("csu_product"),
        F.concat(F.lit("E."), F.col("n_nationkey").cast("string")).alias("csu_product_id"),
        F.lit(1).cast("decimal(18,4)").alias("csu_amount"),
        unit.alias("csu_unit"),
        ((F.col("n_nationkey") + 1) / 100).cast("decimal(18,6)").alias("csu_weight"),
        F.to_json(F.array(F.col("item"))).alias("it_product_id_array"),
        F.col("c_name").alias("itemName"),
        F.col("c_nationkey").alias("nove_poradi"),
        F.col("event_id").cast("string").alias("p_key"),
        F.col("item").alias("itemId_given_day"),
        F.col("kind").alias("itemUrl_given_day"),
        dec2_text(F.col("price")).alias("currentPrice"),
        F.when(F.col("kind") == "purchase", dec2_text(F.col("price"))).otherwise(F.lit("")).alias("originalPrice"),
        F.col("d").alias("date"),
        F.col("props").alias("itemImage_given_day"),
        price.alias("basePrice"),
        price.cast(P.BASKET_PRICE).alias("csuRelevantPrice"),
        F.lit(1).cast("decimal(18,4)").alias("package_amount"),
        F.lit("ks").alias("package_unit"),
        price.alias("price_per_unit"),
        unit.alias("unit"),
        F.when(F.col("c_acctbal") < 0, F.lit("CZ")).alias("country"))


def lineitem_history(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as daily price rows of parts (string-typed prices)."""
    li = table(spark, d, "lineitem")
    cur = dec2_text(scaled(F.col("l_extendedprice"), "0.001"))
    return li.select(
        F.col("l_partkey").alias("itemId"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("p_key"),
        F.col("l_returnflag").alias("itemUrl"),
        cur.alias("currentPrice"),
        F.when(F.col("l_discount") >= 0.05, dec2_text(scaled(F.col("l_extendedprice"), "0.001")
                                                        * (F.lit(1) + F.col("l_discount").cast("decimal(4,2)")).cast("decimal(5,2)")))
         .otherwise(F.lit("")).alias("originalPrice"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_linestatus").alias("itemImage"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus")


def part_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    key = F.concat_ws("-", "p_brand", "p_type", F.col("p_size").cast("string"))
    return I.pair_ids_by_key(I.keyed_items(p.withColumnRenamed("p_partkey", "itemId"), None, key))


def part_candidates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    cands = p.select(F.col("p_partkey").alias("productId"), F.col("p_name").alias("itemName"),
                     F.concat(F.col("p_partkey").cast("string"), F.lit("_"), F.col("p_type")).alias("productId_csuId_ident"),
                     F.col("p_brand").alias("csu_nazev"), F.col("p_size").alias("poradi"))
    return I.with_alt_id(cands, part_pairs(spark, d))


# ---------------------------------------------------------------- queries

def q_latest_per_key(spark, d):
    ev = table(spark, d, "events").withColumn("d", F.to_date("ts"))
    out = RW.latest_per_key(ev, "user_id", "d",
                            tie_breakers=[F.col("ts").desc(), F.col("event_id").desc()],
                            non_empty_cols=["event_type"])
    return out.select("user_id", "event_id", "event_type", "value", "d")


def q_classify_distinct(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus").distinct()
    return RW.classify(o, "searchType", ORDER_RULES, ["o_orderpriority", "o_orderstatus"],
                       R.DEFAULT_SEARCH_TYPE)


def _hits_results(spark, d):
    li = table(spark, d, "lineitem")
    hits = C.label_search_type(
        li.select(F.col("l_orderkey").cast("string").alias("itesco_nazev"),
                  F.col("l_partkey").alias("productId"), F.col("l_linenumber").alias("poradi")),
        rules=(), default=R.DEFAULT_SEARCH_TYPE)
    o = table(spark, d, "orders")
    results = o.select(
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("."), F.substring("o_orderpriority", 1, 1),
                 F.lit(" ")).alias("csu_id"),
        F.col("o_orderpriority").alias("csu_nazev"),
        F.col("o_orderkey").cast("string").alias("itesco_nazev"),
        F.when(F.col("o_totalprice") > 400000, F.lit("big")).alias("itesco_notes"))
    p = table(spark, d, "part")
    names = p.select(F.col("p_partkey").alias("itemId"), F.col("p_name").alias("itemName"),
                     F.col("p_type").alias("itemUrl"))
    return hits, results, names


def q_candidates_outer_topk(spark, d):
    hits, results, names = _hits_results(spark, d)
    return C.build_candidates(hits, results, names, TOP)


def _customer_blocklist(spark, d):
    c = table(spark, d, "customer").filter(F.col("c_acctbal") < 0)
    ident = F.concat(F.col("c_custkey").cast("string"), F.lit("_"), F.col("c_mktsegment"))
    raw = c.select(F.concat(F.lit(" "), ident, F.lit("  ")).alias("id")).unionByName(c.select(ident.alias("id")))
    return C.clean_blocklist(raw)


def q_clean_blocklist(spark, d):
    return _customer_blocklist(spark, d)


def _segment_rules(spark, d):
    c = table(spark, d, "customer")
    lines = spark.createDataFrame(
        [(seg, R.MANUAL_PRODUCTS[i][0], R.MANUAL_PRODUCTS[i][1], R.MANUAL_PRODUCTS[i][2])
         for seg, i in SEGMENT_LINES],
        "c_mktsegment string, csu_id string, csu_nazev string, itesco_nazev string")
    return c.join(F.broadcast(lines), "c_mktsegment").select(
        F.col("c_custkey").alias("itemId"), "csu_id", "csu_nazev", "itesco_nazev")


def q_manual_supplement(spark, d):
    o = table(spark, d, "orders")
    hist = o.select(F.col("o_custkey").alias("itemId"), F.col("o_orderpriority").alias("itemName"),
                    F.col("o_orderstatus").alias("itemUrl"), F.to_date("o_orderdate").alias("date"))
    return C.manual_supplement(hist, _segment_rules(spark, d))


def q_blocklist_anti(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("productId_csuId_ident"))
    c = table(spark, d, "customer").filter(F.col("c_acctbal") < 0)
    bl = C.clean_blocklist(c.select(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("id")))
    return C.apply_blocklist(o, bl)


def q_union_all_sources(spark, d):
    s = table(spark, d, "supplier")
    c = table(spark, d, "customer")

    def shape(df, key, name, nation, tag, pos, stype):
        return df.select(
            F.concat(F.col(key).cast("string"), F.lit(tag)).alias("productId_csuId_ident"),
            F.col(name).alias("csu_nazev"), F.lit(None).cast("string").alias("itesco_notes"),
            F.col(name).alias("itemName"), F.lit(None).cast("string").alias("itemUrl"),
            F.col(nation).cast("string").alias("itesco_nazev"), F.col(key).cast("long").alias("productId"),
            pos.alias("poradi"), F.lit(stype).alias("searchType"), F.lit(None).cast("string").alias("csu_id"))

    return RW.union_all([
        shape(s, "s_suppkey", "s_name", "s_nationkey", "_S", F.col("s_nationkey").cast("int"), "stringSearch"),
        shape(c, "c_custkey", "c_name", "c_nationkey", "_C", F.lit(None).cast("int"), R.MANUAL_SEARCH_TYPE)])


def q_delete_null_safe(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id",
                                          F.nullif(F.col("event_type"), F.lit("click")).alias("kind"), "value")
    return RW.drop_where(ev, (F.col("kind") != "view") & (F.col("value") > 20))


def q_pair_ids(spark, d):
    return part_pairs(spark, d)


def q_url_key_semi(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("itemId"), F.col("url").alias("itemImage"))
    cands = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("productId"))
    return I.keyed_items(pages, cands, I.barcode_from_url("itemImage", 3), I.valid_image("itemImage"))


def q_alt_id_or_join(spark, d):
    return part_candidates(spark, d).select("productId", "itemName", "productId_alt")


def q_history_either_id(spark, d):
    out = I.attach_history(part_candidates(spark, d), lineitem_history(spark, d))
    return out.withColumn("found_product_ids", F.to_json("found_product_ids"))


def q_rerank_nulls_last(spark, d):
    s = table(spark, d, "supplier")
    pos = F.when(F.col("s_acctbal") >= 1000, F.floor(F.col("s_acctbal") / 1000).cast("int"))
    s = s.select("s_suppkey", "s_nationkey", pos.alias("poradi"))
    return RW.rank_within(s, "s_nationkey", [F.col("poradi").asc_nulls_last(), F.col("s_suppkey").asc()],
                          "nove_poradi")


def _part_details(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("itemId"), F.col("p_name").alias("title"),
        F.col("p_type").alias("category1"),
        dec2_text(scaled(F.col("p_retailprice"), "0.01")).alias("price_new"),
        F.when(F.col("p_size") > 45, F.lit("")).otherwise((F.col("p_size") - 1).cast("string")).alias("package_amount"),
        F.when(F.col("p_type") == "SMALL", F.lit("kg")).when(F.col("p_type") == "ECONOMY", F.lit(""))
         .alias("unit_price_per_unit"),
        F.when(F.col("p_size") < 10, F.lit("ks")).otherwise(F.lit("g")).alias("package_unit"),
        F.when(F.col("p_size") > 40, F.lit("")).otherwise(F.lit("CZ")).alias("country_new"))


def _lineitem_daily(spark, d):
    h = lineitem_history(spark, d)
    ids = F.when(F.col("l_linenumber") == 1, F.array("itemId", "l_suppkey")).otherwise(F.array("itemId"))
    base = F.coalesce(F.nullif(F.col("originalPrice"), F.lit("")), F.nullif(F.col("currentPrice"), F.lit("")))
    return h.select(ids.alias("found_product_ids"), F.col("itemId").alias("itemId_given_day"), "p_key",
                    "currentPrice", "originalPrice", base.alias("basePrice"), "date")


def q_unit_price(spark, d):
    out = P.unit_price(_lineitem_daily(spark, d), _part_details(spark, d),
                       per_kilo_items=F.col("category1") == "STANDARD")
    return out.select(
        F.to_json("found_product_ids").alias("found_product_ids"), "itemId_given_day", "p_key", "date",
        "basePrice", "originalPrice", F.col("itemId").alias("detail_itemId"), "package_amount", "price_new",
        "price_per_unit", "unit", F.round(F.col("flag").cast("double"), 6).alias("flag"), "ppu_final")


def _px_daily(spark, d):
    px = price_points(spark, d)
    ppu = F.col("price").cast("decimal(18,2)")
    return px.select(
        F.col("item").alias("itemId_given_day"), F.col("d").alias("date"),
        F.col("item").cast("string").alias("productId_csuId_ident"),
        F.when(F.col("kind").isin("purchase", "view"), dec2_text(F.col("price"))).otherwise(F.lit(""))
         .alias("originalPrice"),
        ppu.alias("ppu_final"))


def q_stale_discount(spark, d):
    return P.fix_stale_discount(_px_daily(spark, d)).select(
        "itemId_given_day", "date", "originalPrice", "price_per_unit")


def q_placeholder_dedupe(spark, d):
    ev = table(spark, d, "events").select(
        F.array("user_id").alias("found_product_ids"), F.col("user_id"), F.to_date("ts").alias("date"),
        F.col("event_type").alias("title"), F.col("value").cast("decimal(18,2)").alias("price_per_unit"),
        F.col("event_id").cast("string").alias("productId_csuId_ident"),
        F.col("event_id").alias("itemId_given_day"))
    out = P.dedupe_placeholders(ev, PLACEHOLDER_KINDS)
    return out.select("user_id", "date", "title", "price_per_unit", F.col("itemId_given_day").alias("event_id"),
                      "old_item_fix")


def q_basket_price(spark, d):
    li = lineitem_history(spark, d)
    name = None
    for flag, status, n in FLAG_NAMES:
        cond = (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)
        name = (F.when if name is None else name.when)(cond, F.lit(n))
    name = name.otherwise(F.concat("l_returnflag", "l_linestatus"))
    facts = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_P_"), F.lpad(F.col("itemId").cast("string"), 8, "0"))
         .alias("productId_csuId_ident"),
        name.alias("csu_nazev"), F.array("itemId").alias("found_product_ids"),
        F.col("l_returnflag").alias("itemName"), F.col("l_linenumber").alias("nove_poradi"), "p_key",
        F.col("itemId").alias("itemId_given_day"), F.col("itemUrl").alias("itemUrl_given_day"),
        "currentPrice", "originalPrice", "date", F.col("itemImage").alias("itemImage_given_day"),
        F.col("currentPrice").alias("basePrice"),
        dec2_text(F.col("l_quantity")).alias("package_amount"),
        F.when(F.col("l_quantity") < 10, F.lit("ks")).otherwise(F.lit("kg")).alias("package_unit"),
        scaled(F.col("l_extendedprice"), "0.001").cast("decimal(18,2)").alias("price_per_unit"),
        F.lit("kg").alias("unit"),
        F.when(F.col("l_quantity") > 40, F.lit("")).otherwise(F.col("l_returnflag")).alias("country_new"))
    p = table(spark, d, "part")
    unit = None
    for t, u in BASKET_UNITS:
        unit = (F.when if unit is None else unit.when)(F.col("p_type") == t, F.lit(u))
    tax = p.select(
        F.upper("p_type").alias("nazev_hlavni_kategorie"), F.upper("p_brand").alias("nazev_nadkategorie"),
        F.concat(F.lit("P."), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("ecoicop"),
        (F.col("p_size").cast("decimal(18,4)") * F.lit(Decimal("0.1"))).cast("decimal(18,4)").alias("merna_jednotka"),
        unit.otherwise(F.lit("kus")).alias("empty"),
        scaled(F.col("p_retailprice"), "0.0001").cast("decimal(18,6)").alias("Vaha"))
    return P.to_basket_price(facts, tax)


def _part_facts(spark, d):
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "left")
    return j.select(
        F.col("p_brand").alias("csu_product"), F.col("p_name").alias("itemName"),
        F.to_json(F.array("l_partkey")).alias("it_product_id_array"),
        F.when(F.col("p_size") > 40, F.lit("CZ")).alias("country"),
        F.col("p_size").alias("nove_poradi"), F.lit("kg").alias("unit"),
        F.col("p_size").cast("decimal(18,4)").alias("package_amount"), F.lit("ks").alias("package_unit"),
        F.when(F.col("p_type") == "SMALL", F.lit("l")).otherwise(F.lit("kg")).alias("csu_unit"),
        F.lit(1).cast("decimal(18,4)").alias("csu_amount"),
        F.to_date("l_shipdate").alias("date"),
        scaled(F.col("l_extendedprice"), "0.001").cast(P.BASKET_PRICE).alias("csuRelevantPrice"))


SELECTION_DOUBLES = ("stddev_avg_csuRelevantPrice", "avg_avg_csuRelevantPrice", "mean_coef_var",
                     "diff_from_mean")


def _round_doubles(df, cols, n=6):
    return df.select(*[F.round(F.col(c), n).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_select_products(spark, d):
    s = S.select_products(_part_facts(spark, d), MIN_DAYS_PARTS, UNWANTED_PARTS,
                          materialize=lambda g: cut_lineage(g, "selection_items"))
    return _round_doubles(s, SELECTION_DOUBLES)


def q_densify(spark, d):
    rows = H.densify(cut_lineage(price_facts(spark, d), "px_facts"))
    return rows.select("grid_date", "grid_itemName", "grid_it_product_id_array", "date",
                       "csuRelevantPrice", "currentPrice", "originalPrice", "itemId_given_day", "csu_product")


def q_first_known(spark, d):
    fk = H.first_known(price_facts(spark, d), epoch=EPOCH)
    return fk.select("itemName", "it_product_id_array", "first_date", "csu_product", "itemId_given_day",
                     "csuRelevantPrice", "basePrice", "currentPrice", "originalPrice", "first_date_of_data")


def q_backfill(spark, d):
    return H.backfill(cut_lineage(price_facts(spark, d), "px_facts"), EPOCH)


def q_fill_forward(spark, d):
    return H.fill_history(cut_lineage(price_facts(spark, d), "px_facts"), AS_OF, EPOCH)


def px_full_history(spark, d):
    # the fact view feeds the selection and every branch of the fill: written
    # once to the checkpoint folder, as the whole refresh does
    facts = cut_lineage(price_facts(spark, d), "px_facts")
    sel = S.selection_final(S.select_products(facts, MIN_DAYS_USERS, UNWANTED_USERS))
    return H.fill_and_flag(facts, sel, AS_OF, EPOCH)


def q_flag_selected(spark, d):
    return _round_doubles(px_full_history(spark, d), ("mean_coef_var",))


def q_weighted_index(spark, d):
    w = X.weighted_index(px_full_history(spark, d), AS_OF)
    return w.withColumn("perc_diff_last_day", F.round("perc_diff_last_day", 10))


def _avg_out(df):
    return df.withColumn("csuRelevantPrice", F.round(F.col("csuRelevantPrice"), 6).cast("double"))


def q_rollup_main(spark, d):
    return _avg_out(X.rollup_avg(px_full_history(spark, d), 1))


def q_rollup_sub(spark, d):
    return _avg_out(X.rollup_avg(px_full_history(spark, d), 2))


def q_rollup_product(spark, d):
    return _avg_out(X.rollup_avg(px_full_history(spark, d), 3))


def q_rollup_item(spark, d):
    return _avg_out(X.rollup_avg(px_full_history(spark, d), 4))


def q_rollup_all_levels(spark, d):
    return _avg_out(X.rollup_all_levels(px_full_history(spark, d)))


QUERIES = {
    "latest_per_key": q_latest_per_key,
    "classify_distinct": q_classify_distinct,
    "candidates_outer_topk": q_candidates_outer_topk,
    "clean_blocklist": q_clean_blocklist,
    "manual_supplement": q_manual_supplement,
    "blocklist_anti": q_blocklist_anti,
    "union_all_sources": q_union_all_sources,
    "delete_null_safe": q_delete_null_safe,
    "pair_ids": q_pair_ids,
    "url_key_semi": q_url_key_semi,
    "alt_id_or_join": q_alt_id_or_join,
    "history_either_id": q_history_either_id,
    "rerank_nulls_last": q_rerank_nulls_last,
    "unit_price": q_unit_price,
    "stale_discount": q_stale_discount,
    "placeholder_dedupe": q_placeholder_dedupe,
    "basket_price": q_basket_price,
    "select_products": q_select_products,
    "densify": q_densify,
    "first_known": q_first_known,
    "backfill": q_backfill,
    "fill_forward": q_fill_forward,
    "flag_selected": q_flag_selected,
    "weighted_index": q_weighted_index,
    "rollup_main": q_rollup_main,
    "rollup_sub": q_rollup_sub,
    "rollup_product": q_rollup_product,
    "rollup_item": q_rollup_item,
    "rollup_all_levels": q_rollup_all_levels,
}
