"""Keep one row per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key. The ``row_number() = 1`` filter is also applied before the
    shuffle (window group limit), so a hot key sends one row per map task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def drop_duplicate_keys(
    df: DataFrame, key: str, date_column: str | None = None, metadata: bool = True
) -> DataFrame:
    """Ingest dedup: newest load wins, then the latest extract, then the newer date.

    A frame without the key column is returned unchanged. NULLs in a descending
    order come first, as in the warehouse the results must match.
    """
    present = {c.lower(): c for c in df.columns}
    if key.lower() not in present:
        return df
    order: list[Column] = []
    if metadata and "loaded_at" in present:
        order.append(F.col(present["loaded_at"]).desc_nulls_first())
    if metadata and "data_source" in present:
        order.append((F.col(present["data_source"]) == "latest").desc_nulls_last())
    if date_column and date_column.lower() in present:
        order.append(F.col(present[date_column.lower()]).desc_nulls_last())
    # the whole row as last tie-break, so the winner never depends on the partitioning
    order += [F.col(c).asc_nulls_first() for c in df.columns]
    return keep_first(df, [present[key.lower()]], order)
