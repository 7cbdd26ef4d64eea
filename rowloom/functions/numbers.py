"""Numbers and conversions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.nulls import as_col

# Words read as booleans.
_TRUE_WORDS = ("true", "t", "yes", "y", "1")
_FALSE_WORDS = ("false", "f", "no", "n", "0")


def truncate(value: Column | str, digits: int = 0) -> Column:
    """TRUNC for numbers: cut towards zero. Decimals stay decimals, doubles stay doubles.

    Spark rounds doubles by their decimal digits, so 1.15 cut to two digits is 1.15 and not 1.14;
    a value that was rounded away from zero goes back by one step of the last digit.
    """
    value = as_col(value)
    near = F.round(value, digits)
    step = F.lit(Decimal(1).scaleb(-digits).quantize(Decimal(1).scaleb(-max(digits, 0))))
    back = F.round(F.when(value < 0, near + step).otherwise(near - step), digits)
    return F.when(F.abs(near) > F.abs(value), back).otherwise(near)


def convert(value: Column | str, to: str, strict: bool = True) -> Column:
    """CAST and CONVERT, or TRY_CAST when not strict."""
    return as_col(value).cast(to) if strict else as_col(value).try_cast(to)


def to_number(value: Column | str, precision: int = 38, scale: int = 10) -> Column:
    """Text to decimal; null when it is no number."""
    return F.trim(as_col(value)).try_cast(f"decimal({precision},{scale})")


def parse_boolean(value: Column | str) -> Column:
    word = F.lower(F.trim(as_col(value)))
    return F.when(word.isin(*_TRUE_WORDS), True).when(word.isin(*_FALSE_WORDS), False)


def absolute(value: Column | str) -> Column:
    return F.abs(as_col(value))


def rounded(value: Column | str, digits: int = 0) -> Column:
    return F.round(as_col(value), digits)


def ceiling(value: Column | str) -> Column:
    return F.ceil(as_col(value))


def floor(value: Column | str) -> Column:
    return F.floor(as_col(value))


def square_root(value: Column | str) -> Column:
    return F.sqrt(as_col(value))


def random(seed: int = 42) -> Column:
    return F.rand(seed)
