"""Staging: raw extract in, explicitly typed columns out. No shuffle, no action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import cast_to
from basketry.schemas import TABLES


def stage(raw: DataFrame, table: str) -> DataFrame:
    """Cast a raw table to its staged columns; other raw columns are dropped.

    Raw names are matched without regard to case (text extracts are upper-case).
    """
    by_name = {f.name.lower(): f for f in raw.schema.fields}
    selected = []
    for name, kind in TABLES[table].staged.items():
        if name not in by_name:
            raise ValueError(f"raw table {table} lacks column {name}")
        field = by_name[name]
        selected.append(cast_to(F.col(f"`{field.name}`"), kind, field.dataType).alias(name))
    return raw.select(*selected)
