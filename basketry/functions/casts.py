from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.dates import parse_timestamp


def to_int(value: Column, source: T.DataType | None = None) -> Column:
    """Integer cast that rounds half away from zero, where Spark's own cast truncates."""
    if isinstance(source, T.IntegralType):
        return value.cast("int")
    return F.round(value.cast("decimal(38,9)"), 0).cast("int")


def cast_to(value: Column, target: str, source: T.DataType | None = None) -> Column:
    """Cast to a staged type; bad timestamps become NULL, other bad values raise."""
    if target == "timestamp":
        return parse_timestamp(value)
    if target == "int":
        return to_int(value, source)
    return value.cast(target)
