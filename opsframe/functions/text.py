"""Scalar helpers built from JVM-side functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

WHOLE = "decimal(38,0)"


def strip(col: Column) -> Column:
    """Trim whitespace of every kind; Spark's plain ``trim`` removes spaces only."""
    return F.trim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def typed(raw: Column, dtype: T.DataType) -> Column:
    """Cast one raw text cell. Blank or unreadable cells become null.

    An integer column also takes a whole number written as 5.0 or 5e3.
    """
    text = blank_to_null(raw)
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BooleanType):
        return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    if isinstance(dtype, T.DateType):
        return F.try_to_date(text, "yyyy-MM-dd")
    if isinstance(dtype, T.IntegralType):
        number = text.try_cast("decimal(38,18)")
        whole = F.when(number == F.floor(number), number)
        return F.coalesce(text.try_cast(dtype), whole.try_cast(dtype))
    return text.try_cast(dtype)


def doubled(col: Column) -> Column:
    """Strip, read as an integer and double it; null when it is not a number."""
    number = strip(col)
    return F.when(number.rlike("^[+-]?[0-9]+$"), number.try_cast("bigint")) * F.lit(2)


def fixed(col: Column, digits: int = 2) -> Column:
    """Number as text with a fixed number of decimals, halves of its decimal form rounded up."""
    return F.format_string(f"%.{digits}f", col.cast("double"))


def lookup(col: Column, mapping: dict) -> Column:
    """Constant mapping inlined into the projection: no join, no shuffle."""
    if not mapping:
        raise ValueError("empty mapping")
    pairs = [F.lit(part) for entry in mapping.items() for part in entry]
    return F.try_element_at(F.create_map(*pairs), col)


def canonical(col: Column, dtype: T.DataType) -> Column:
    """Form under which equal values of different types compare equal; null stays null.

    5000, 5000.0 and '5000' give the same. Every value, short or long, becomes
    the first 16 bytes of its text's SHA-256, so a shuffle by value never moves
    whole texts and no text can pass for another.
    """
    return F.substring(F.unhex(F.sha2(_plain_text(col, dtype), 256)), 1, 16)


def _plain_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        number = col.cast("double")
        whole = F.when(number == F.rint(number), number.try_cast(WHOLE).cast("string"))
        return F.coalesce(whole, number.cast("string"))
    if isinstance(dtype, T.DecimalType):
        plain = F.rtrim(col.cast("string"), F.lit("0"))
        return F.when(
            col.cast("string").contains("."), F.rtrim(plain, F.lit("."))
        ).otherwise(col.cast("string"))
    return col.cast("string")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_atomic(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
