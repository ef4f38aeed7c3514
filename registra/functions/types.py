"""Short ways to write schemas without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, BOOLEAN, DATE, TIMESTAMP = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType()
_KINDS = {"string": STRING, "int": INT, "long": LONG, "boolean": BOOLEAN, "date": DATE, "timestamp": TIMESTAMP}


def fields(text: str) -> T.StructType:
    """A flat schema from "name type, name type"."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in text.split(", "))])


def struct(**kinds: T.DataType) -> T.StructType:
    """A nested schema from names and types."""
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def array(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)
