"""Column-level preparation of raw extracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import parse_timestamp


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def number_duplicate_names(names: list[str]) -> list[str]:
    """``a, b, a`` becomes ``a_1, b, a_2``; names used once stay."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        if names.count(name) == 1:
            result.append(name)
            continue
        seen[name] = seen.get(name, 0) + 1
        result.append(f"{name}_{seen[name]}")
    return result


def repair_duplicate_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*number_duplicate_names(df.columns))


def assert_unique_columns(df: DataFrame) -> DataFrame:
    """Raise if two columns share a name, ignoring case."""
    names = [c.lower() for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"duplicate columns: {doubled}")
    return df


def flatten(df: DataFrame) -> DataFrame:
    """Structs become ``parent_child`` columns at every depth; arrays become JSON text."""

    def leaves(column: Column, name: str, kind: T.DataType) -> list[Column]:
        if isinstance(kind, T.StructType):
            found = []
            for field in kind.fields:
                found += leaves(column.getField(field.name), f"{name}_{field.name}", field.dataType)
            return found
        if isinstance(kind, T.ArrayType):
            return [F.to_json(column).alias(name)]
        return [column.alias(name)]

    selected: list[Column] = []
    for field in df.schema.fields:
        selected += leaves(F.col(f"`{field.name}`"), field.name, field.dataType)
    return df.select(*selected)


def is_date_name(name: str) -> bool:
    return "date" in name.lower() or name.lower().endswith("_at")


def normalise_dates(df: DataFrame, as_text: bool = True) -> DataFrame:
    """Every column named like a date becomes a timestamp (or its text form); what
    cannot be read becomes NULL."""
    selected = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if is_date_name(name):
            column = parse_timestamp(column)
            if as_text:
                column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        selected.append(column.alias(name))
    return df.select(*selected)


def nan_to_null(df: DataFrame) -> DataFrame:
    selected = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        selected.append(column.alias(field.name))
    return df.select(*selected)


def stamp(df: DataFrame, data_source: str, batch_id: str, loaded_at: datetime) -> DataFrame:
    """Load metadata as literals: the same on every task and every retry."""
    return df.withColumns(
        {
            "data_source": F.lit(data_source),
            "batch_id": F.lit(batch_id),
            "loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
        }
    )
