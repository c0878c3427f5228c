"""Cleaning of raw register text. Every function maps a Column to a Column and stays in codegen.

Bad input becomes NULL through ``try_`` functions, so one dirty cell never fails a job whether or not
the session runs in ANSI mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellmart.schemas import PRICE_TYPE

# Formats of the register.
DATE_PATTERN = "dd/MM/yyyy"
NOT_PRICE_TEXT = "[^0-9.]"
YES = "Yes"


def sale_date(text: Column) -> Column:
    """``dd/MM/yyyy`` with both leading zeros; anything else is NULL."""
    return F.try_to_date(text, DATE_PATTERN)


def price_digits(text: Column) -> Column:
    """Keep digits and dots. Currency signs, separators and also a minus sign go."""
    return F.regexp_replace(text, NOT_PRICE_TEXT, "")


def price(text: Column) -> Column:
    """Price in euro; NULL where the digits do not form a decimal(12,2)."""
    return price_digits(text).try_cast(PRICE_TYPE)


def yes_flag(text: Column) -> Column:
    """True for exactly ``Yes``, NULL for NULL."""
    return text == F.lit(YES)


def tidy_spaces(text: Column) -> Column:
    """One space between words and none around them. Only U+0020 counts: tabs and NBSP stay."""
    # A single space is left as it is: only runs of two and more are rewritten.
    return F.trim(F.regexp_replace(text, " {2,}", " "))
