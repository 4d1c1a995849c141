"""Price normalisation (S13-S16): unit price, stale discounts, placeholder
dedupe, conversion to the basket's unit."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import div0, empty_to_null, initcap_first, initcap_words, parse_decimal, \
    safe_div, to_number_whole
from .identity import left_join_any_id
from .rows import dedupe_by_score, with_neighbours

PRICE = "decimal(18,2)"
AMOUNT = "decimal(18,4)"
BASKET_PRICE = "decimal(24,6)"


def unit_price(facts: DataFrame, details: DataFrame, per_kilo_items=R.PER_KILO_ITEMS,
               per_kilo_limit=R.PER_KILO_PRICE_LIMIT, flag_limit=R.FLAG_LIMIT,
               ids_col: str = "found_product_ids", id_lists: DataFrame | None = None, round_first: bool = True) -> DataFrame:
    """Attach product details under either id and compute the unit price.

    * ``price_per_unit`` = DIV0(basePrice, package_amount) to 2 decimals,
      except listed per-kilo items (ids, or a predicate Column) whose whole-number base price is above
      the limit: those keep the base price;
    * ``unit`` = listed unit if non-empty, else the package unit if non-empty;
    * ``flag`` = ppu / price_new * package_amount (NULL on a zero divisor);
    * ``ppu_final`` = originalPrice when flag > limit and originalPrice is
      non-empty, else ppu.

    ``id_lists``: the distinct id lists of ``facts`` when a smaller table
    (the candidates) already knows them - saves a pass over the history."""
    return price_units(attach_details(facts, details, ids_col, id_lists), per_kilo_items, per_kilo_limit, flag_limit,
                       round_first)


def attach_details(rows: DataFrame, details: DataFrame, ids_col: str = "found_product_ids",
                   id_lists: DataFrame | None = None) -> DataFrame:
    """S13's join: product details under either id of ``ids_col``."""
    return left_join_any_id(rows, F.col(ids_col), details, "itemId", ids_col=ids_col, right_is_large=False,
                            id_lists=id_lists)


def price_units(j: DataFrame, per_kilo_items=R.PER_KILO_ITEMS, per_kilo_limit=R.PER_KILO_PRICE_LIMIT,
                flag_limit=R.FLAG_LIMIT, round_first: bool = True) -> DataFrame:
    """S13's prices, see ``unit_price``.  Raw values are divided and the quotient
    is rounded; the flag is compared by products, so its own rounding decides
    nothing.  ``round_first=False`` compares the per-kilo price with its decimals."""
    base = parse_decimal("basePrice", 20, 6)
    amount = parse_decimal("package_amount", 20, 6)
    price_new = parse_decimal("price_new", 18, 2)
    listed = (per_kilo_items if isinstance(per_kilo_items, Column)
              else F.col("itemId_given_day").isin(list(per_kilo_items)))
    per_kilo = listed & (to_number_whole("basePrice", round_first) > F.lit(per_kilo_limit))
    ppu = F.when(per_kilo, base).otherwise(div0(base, amount)).cast(PRICE)
    upu, pu = F.col("unit_price_per_unit"), F.col("package_unit")
    unit = F.when(upu != "", upu).when((upu == "") & (pu != ""), pu)
    flag = safe_div(F.col("price_per_unit"), price_new) * amount
    worth, limit = F.col("price_per_unit") * amount, price_new * F.lit(flag_limit)
    stale = F.when(price_new > 0, worth > limit).when(price_new < 0, worth < limit)
    final = F.when(stale & (F.col("originalPrice") != ""),
                   parse_decimal("originalPrice", 18, 2)).otherwise(F.col("price_per_unit")).cast(PRICE)
    return (j.withColumn("price_per_unit", ppu).withColumn("unit", unit)
             .withColumn("flag", flag).withColumn("ppu_final", final))


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


# total order among rows of one item and day: the candidate, the detail row
# it matched (either id can match), the history row
ROW_TIES = ("productId_csuId_ident", "itemId", "p_key", "csu_nazev", "nove_poradi")


def fix_stale_discount(df: DataFrame, item: str = "itemId_given_day", date: str = "date",
                       tie_breakers=ROW_TIES, hot_rows: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One-day glitch after a discount ends.

    If the next row of the item has no original price ('' - a missing next
    row is NULL and does not count) and the previous row has one, take the
    previous row's final price; else the row's own.  Rows without an item
    (no history) all fall in the NULL partition in the original, where the
    result is always their own price; here they are spread by a hash of their
    ids (never NULL), so they do not pile up in one task.

    With ``hot_rows`` an item of more rows is looked at in pieces
    (``rows.with_neighbours``); ``counts`` (a column named like ``item``) counts
    the items in a smaller table than ``df``."""
    tie_breakers = _present(df, tie_breakers)
    spread = F.when(F.col(item).isNull(), F.xxhash64(*_present(df, (*tie_breakers, "found_product_ids"))))
    if counts is not None:
        counts = counts.filter(F.col(item).isNotNull()).select(item, F.lit(None).cast("long").alias("__spread"))
    near = with_neighbours(
        df.withColumn("__spread", spread), [item, "__spread"],
        [F.col(date).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie_breakers]],
        {"__next": ("originalPrice", 1), "__prev": ("originalPrice", -1), "__prev_final": ("ppu_final", -1)}, hot_rows, counts)
    fixed = F.when((F.col("__next") == "") & (F.col("__prev") != ""), F.col("__prev_final")).otherwise(F.col("ppu_final"))
    return near.withColumn("price_per_unit", fixed).drop("flag", "ppu_final", "__spread", "__next", "__prev", "__prev_final")


def dedupe_placeholders(df: DataFrame, titles=R.PLACEHOLDER_TITLES, ids_col: str = "found_product_ids",
                        tie_breakers=("productId_csuId_ident", "itemId_given_day", "itemId", "p_key", "csu_nazev", "nove_poradi")
                        ) -> DataFrame:
    """One row per (first id, date): regular titles before placeholder
    ones, then the lowest unit price."""
    score = F.when(F.col("title").isin(list(titles)), F.lit(R.PLACEHOLDER_SCORE)).otherwise(
        F.lit(R.REGULAR_SCORE))
    keys = [F.get(F.col(ids_col), 0), F.col("date")]
    order = [F.col("price_per_unit").asc_nulls_last()] + [
        F.col(t).asc_nulls_last() for t in _present(df, tie_breakers)]
    return dedupe_by_score(df, keys, score, order, score_col="old_item_fix")


def product_name(name: Column, per_word=R.NAMES_PER_WORD, fixed=R.NAMES_FIXED) -> Column:
    """Basket product name casing: listed names per word, fixed spellings,
    all others first letter only."""
    expr = None
    for n in per_word:
        expr = (F.when if expr is None else expr.when)(name == n, initcap_words(name))
    for n, spelled in fixed:
        expr = (F.when if expr is None else expr.when)(name == n, F.lit(spelled))
    return initcap_first(name) if expr is None else expr.otherwise(initcap_first(name))


def basket_price(product: Column, package_unit: Column, basket_unit: Column, ppu: Column,
                 base: Column, amount: Column, piece_factors=R.PIECE_FACTORS) -> Column:
    """S16 ``csuRelevantPrice``; first matching rule wins (see SURVEY 2.6)."""
    ppu = ppu.cast(PRICE)
    expr = None
    for prod, unit, factor in piece_factors:
        cond = (product == prod) & (package_unit == unit)
        val = F.lit(factor).cast("decimal(10,4)") * ppu * amount
        expr = (F.when if expr is None else expr.when)(cond, val)
    expr = (F.when if expr is None else expr.when)(basket_unit.isin(*R.UNITS_PRICED_PER_UNIT), ppu * amount)
    # per gram: ppu / 1000 * amount, as one exact product rounded once below
    expr = expr.when(basket_unit == R.UNIT_PER_GRAM, ppu * amount * F.lit(Decimal("0.001")))
    for unit in R.UNITS_PRICED_PER_PIECE:
        expr = expr.when(basket_unit == unit, base * amount)
    expr = expr.otherwise(ppu * amount)
    return expr.cast(BASKET_PRICE)


def to_basket_price(df: DataFrame, taxonomy: DataFrame, rules: R.BasketRules = R.BasketRules()) -> DataFrame:
    """Attach the basket taxonomy on the ident's last 10 characters and
    convert to the basket unit.

    What the result takes of a fact is made before the join, so where the
    taxonomy is too large to be broadcast, numbers are shuffled in place of
    their texts, the ident's end in place of the ident, and no more."""
    t = taxonomy.select(
        F.trim(F.replace(F.col("ecoicop"), F.lit("."), F.lit("_"))).alias("__key"),
        initcap_first("nazev_hlavni_kategorie").alias("csu_main_category"),
        initcap_first("nazev_nadkategorie").alias("csu_subcategory"),
        F.col("ecoicop").alias("csu_product_id"),
        F.col("merna_jednotka").cast(AMOUNT).alias("csu_amount"),
        F.col("empty").alias("csu_unit"),
        F.col("Vaha").cast("decimal(18,6)").alias("csu_weight"))
    facts = df.select(
        F.right(F.col("productId_csuId_ident"), F.lit(10)).alias("__ident"),
        product_name(F.col("csu_nazev"), rules.names_per_word, rules.names_fixed).alias("csu_product"),
        F.to_json("found_product_ids").alias("it_product_id_array"),
        "itemName", "nove_poradi", "p_key", "itemId_given_day", "itemUrl_given_day",
        "currentPrice", "originalPrice", "date", "itemImage_given_day",
        parse_decimal("basePrice", 18, 2).alias("basePrice"),
        parse_decimal("package_amount", 18, 4).alias("package_amount"), "package_unit",
        F.col("price_per_unit").cast(PRICE).alias("price_per_unit"), "unit",
        empty_to_null("country_new").alias("country"))
    j = facts.join(t, facts["__ident"] == t["__key"], "left")
    price = basket_price(F.col("csu_product"), F.col("package_unit"), F.col("csu_unit"),
                         F.col("price_per_unit"), F.col("basePrice"),
                         F.col("csu_amount"), rules.piece_factors)
    return j.select(
        "csu_main_category", "csu_subcategory", "csu_product", "csu_product_id", "csu_amount",
        "csu_unit", "csu_weight", "it_product_id_array",
        "itemName", "nove_poradi", "p_key", "itemId_given_day", "itemUrl_given_day",
        "currentPrice", "originalPrice", "date", "itemImage_given_day", "basePrice",
        price.alias("csuRelevantPrice"), "package_amount", "package_unit", "price_per_unit", "unit", "country")
