"""Number rules as Column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

from brandlens.contract import FRANCHISE_STEM, MAX_FOUNDED_YEAR, MIN_FOUNDED_YEAR
from brandlens.functions.text import strip

PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def finite(c: Column) -> Column:
    """NaN and infinities to null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain finite number becomes null."""
    text = strip(c.cast("string"))
    value = F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))
    # A plain number can only overflow; nullif keeps the value from being computed again.
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def _all_digits() -> tuple[str, str]:
    """Decimal digits of all scripts but ASCII, and the ASCII digits of the same values."""
    found = [chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"]
    return "".join(found), "".join(str(unicodedata.decimal(x)) for x in found)


_DIGITS = _all_digits()


def presence_pair(c: Column) -> Column:
    """Own and franchise store counts from free text, as struct(own, franchise)."""
    found = F.regexp_extract_all(F.translate(c, *_DIGITS), F.lit("([0-9]+)"), F.lit(1))
    first = F.try_element_at(found, F.lit(1)).try_cast("double")
    second = F.try_element_at(found, F.lit(2)).try_cast("double")
    franchised = F.lower(c).contains(FRANCHISE_STEM)
    none = F.lit(None).cast("double")
    zero = F.lit(0.0)
    own = (F.when(first.isNull(), none)
           .when(franchised & second.isNull(), zero)
           .otherwise(first))
    franchise = (F.when(first.isNull(), none)
                 .when(franchised, F.coalesce(second, first))
                 .otherwise(zero))
    return F.struct(own.alias("own"), franchise.alias("franchise"))


def known_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")


def decade(c: Column) -> Column:
    return (F.floor(c / 10) * 10).cast("bigint")


def clip(c: Column, low: float = MIN_FOUNDED_YEAR, high: float = MAX_FOUNDED_YEAR) -> Column:
    """Clip to a closed range; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(c, F.lit(float(high)))))


def round_half_even(c: Column) -> Column:
    return F.rint(c).cast("int")


def unit_hash(key: Column) -> Column:
    """Deterministic number in [0, 1) from a string key."""
    return hash32(key) / F.lit(4294967296.0)


def hash32(key: Column) -> Column:
    """First 32 bits of the MD5 of a string key, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
