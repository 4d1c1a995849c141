"""Scalar column helpers for semantics Spark does not have built in.

All of them are plain Column expressions (JVM side, whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_empty(c) -> Column:
    """``c IS NOT NULL AND c <> ''`` on a string column."""
    c = col(c)
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def empty_to_null(c) -> Column:
    """``NULLIF(c, '')``."""
    return F.nullif(col(c), F.lit(""))


def parse_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """String -> decimal; '' and unparsable text become NULL (never raise)."""
    return empty_to_null(c).try_cast(f"decimal({precision},{scale})")


def div0(a, b) -> Column:
    """DIV0: 0 when the divisor is 0, NULL when either side is NULL."""
    a, b = col(a), col(b)
    return F.when(b.isNull() | a.isNull(), F.lit(None)).when(b == 0, F.lit(0)).otherwise(
        F.try_divide(a, b))


def safe_div(a, b) -> Column:
    """``a / b`` that gives NULL instead of raising on a zero divisor."""
    return F.try_divide(col(a), col(b))


def to_number_whole(c, round_first: bool = True) -> Column:
    """One-argument TO_NUMBER: the text read as a number without decimals
    (half away from zero), e.g. 70.4 -> 70, 70.5 -> 71.  ``round_first=False``
    is the other reading, that it keeps them."""
    number = col(c).try_cast("decimal(38,6)")
    return F.round(number, 0) if round_first else number


def initcap_first(c) -> Column:
    """INITCAP(x, ''): first letter upper, the rest lower (one 'word')."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def initcap_words(c) -> Column:
    """INITCAP(x): each blank-separated word capitalised."""
    return F.initcap(col(c))


def null_safe_true(cond: Column) -> Column:
    """A predicate where NULL counts as false (what DELETE ... WHERE does)."""
    return F.coalesce(cond, F.lit(False))


def dotted_to_key(c) -> Column:
    """``replace(trim(x), '.', '_')`` - basket line id as used in idents."""
    return F.replace(F.trim(col(c)), F.lit("."), F.lit("_"))
