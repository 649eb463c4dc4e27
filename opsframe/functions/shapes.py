"""Short names for building schemas without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
TEXTS = T.ArrayType(TEXT)


def shape(**fields: T.DataType) -> T.StructType:
    """A record or table with these fields, all nullable."""
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def list_of(dtype: T.DataType) -> T.ArrayType:
    return T.ArrayType(dtype)
