"""Business constants of the basket pipeline, kept as data.

Every value below is a FIXED VALUE: it must equal what the original
pipeline uses or the published tables change.  Operators never inline
these; they take them as parameters whose defaults point here, so tests
and the driver-table queries can pass rule sets of their own.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# --- fixed values: dates -------------------------------------------------
# First day of the filled daily grid (the backfill date).
HISTORY_EPOCH = _dt.date(2019, 7, 25)

# --- fixed values: search-hit labelling (statement S02) -------------------
# (search text, product id, position) -> label; first match wins; a rule
# with position/product None matches any value; DEFAULT_SEARCH_TYPE otherwise.
SEARCH_TYPE_RULES = (
    ("KAKAOVÝ PRÁŠEK", 2005100242357, 1, "stringSearch"),
    ("KAKAOVÝ PRÁŠEK", 2005100241989, 2, "stringSearch"),
    ("KAKAOVÝ PRÁŠEK", None, None, "urlSearch"),
)
DEFAULT_SEARCH_TYPE = "stringSearch"
MANUAL_SEARCH_TYPE = "manualSearch"

# --- fixed values: hits kept per search text (S03) -----------------------
TOP_POSITIONS = 8

# --- fixed values: hand-picked products (S05, S06, S07) -------------------
# (basket line id, basket line name, search text, item ids)
MANUAL_PRODUCTS = (
    ("E01_173_02", "STERILOVANÉ OKURKY", "NAKLÁDANÉ OKURKY",
     (2001020257049, 2001020280504, 2001120365900, 2001020279094, 2001020279095,
      2001014802596, 2001005130356, 2001120367028, 2001019076381, 2001120351675)),
    ("E01_164_01", "KOMPOT MERUŇKOVÝ (EVENT. BROSKVOVÝ)", "BROSKVE V NÁLEVU",
     (2001019074868, 2001020229952, 2001018528133, 2001019074844, 2001017545049)),
    ("E01_152_01", "ROSTLINNÝ ROZTÍRATELNÝ TUK", "MARGARÍN",
     (2001020091629, 2001020097891, 2001005224567, 2001019454202, 2001005224628,
      2001014461625, 2001009727125, 2001018037413)),
)

# --- fixed values: one known duplicate removed after the union (S09) ------
DUPLICATE_TO_DROP = ("2005100242357_E01_213_01", "stringSearch")

# --- fixed values: image-URL barcode (S10) ---------------------------------
BARCODE_URL_PART = 7            # 1-based piece of the image URL split on '/'
IMAGE_URL_PREFIX = "https"
NO_IMAGE_SUFFIX = "no-image.gif"

# --- fixed values: unit-price exceptions (S13) -----------------------------
# Items whose listed price above the limit is already a per-kilo price.
PER_KILO_ITEMS = (2001120571270,)
PER_KILO_PRICE_LIMIT = 70
# ppu / new price * package amount above this means a per-kilo list price.
FLAG_LIMIT = 3

# --- fixed values: placeholder titles (S15) --------------------------------
PLACEHOLDER_TITLES = ("DO NOT USE - OLD ITEM", "Do not use")
PLACEHOLDER_SCORE = 99
REGULAR_SCORE = 1

# --- fixed values: basket-product name casing (S16) ------------------------
NAMES_PER_WORD = ("KARLOVARSKÁ BECHEROVKA", "FERNET STOCK")
NAMES_FIXED = (("PRAVÝ ITALSKÝ VERMUT", "Pravý italský Vermut"),)

# --- fixed values: pieces converted to a per-kilo basket price (S16) -------
# (basket product, package unit, factor)
PIECE_FACTORS = (
    ("Česnek suchý", "ks", "20"),
    ("Kiwi", "ks", "12.5"),
    ("Okurky salátové", "ks", "3.6"),
)

# --- fixed values: basket units and how the basket price uses them (S16) --
UNITS_PRICED_PER_UNIT = ("kg", "l")     # unit price x amount
UNIT_PER_GRAM = "g"                     # unit price / 1000 x amount
UNITS_PRICED_PER_PIECE = ("bal.", "ks")  # base price x amount

# --- fixed values: product selection (S17) ---------------------------------
# (basket unit, listed unit, unit used): kg and l count as interchangeable
UNIT_SWAPS = (("l", "kg", "kg"), ("kg", "l", "l"))
MIN_DAYS_IN_HISTORY = 365
# (basket product, ILIKE pattern) -> the item is unwanted
UNWANTED_ITEMS = (
    ("Droždí", "%sušené%"),
    ("Droždí", "%7g%"),
)

# --- fixed values: labels of the filled history (S27) ----------------------
FILLED_LABEL = "based_on_previous"
ORIGINAL_LABEL = "original"

#: Rows of a key that one task sorts without trouble.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class BasketRules:
    """All rule tables in one value, so a caller can swap any of them."""

    search_type_rules: tuple = SEARCH_TYPE_RULES
    default_search_type: str = DEFAULT_SEARCH_TYPE
    top_positions: int = TOP_POSITIONS
    manual_products: tuple = MANUAL_PRODUCTS
    duplicate_to_drop: tuple = DUPLICATE_TO_DROP
    per_kilo_items: tuple = PER_KILO_ITEMS
    per_kilo_price_limit: int = PER_KILO_PRICE_LIMIT
    flag_limit: int = FLAG_LIMIT
    placeholder_titles: tuple = PLACEHOLDER_TITLES
    names_per_word: tuple = NAMES_PER_WORD
    names_fixed: tuple = NAMES_FIXED
    piece_factors: tuple = PIECE_FACTORS
    min_days: int = MIN_DAYS_IN_HISTORY
    unwanted_items: tuple = UNWANTED_ITEMS
    epoch: _dt.date = HISTORY_EPOCH
    #: TO_NUMBER with one argument rounds to a whole number before the per-kilo comparison
    round_first: bool = True
    #: a key (basket line, item, product) of more rows is split over tasks; None never splits
    hot_rows: int | None = HOT_ROWS
    #: pair the items whose image URL has no barcode as one product, as the original does
    drop_empty_barcodes: bool = False
