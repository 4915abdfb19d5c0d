"""Joining a historic and a latest extract of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trim_historic(historic: DataFrame, latest: DataFrame, date_column: str) -> DataFrame:
    """Historic rows dated before the first latest row.

    Only where both ranges overlap: with no overlap, or no dated latest row, the
    historic side stays whole. In an overlap undated historic rows drop out too.
    Both bounds are scalar subqueries over one column, so nothing reaches the driver.
    """
    first_latest = latest.agg(F.min(date_column)).scalar()
    last_historic = historic.agg(F.max(date_column)).scalar()
    overlap = F.coalesce(last_historic >= first_latest, F.lit(False))
    before = F.coalesce(F.col(date_column) < first_latest, F.lit(False))
    return historic.filter(~overlap | before)


def combine(historic: DataFrame, latest: DataFrame) -> DataFrame:
    """Union of both sides by column name; a column one side lacks is NULL there."""
    return historic.unionByName(latest, allowMissingColumns=True)


def order_for_write(df: DataFrame, key: str, date_column: str | None = None) -> DataFrame:
    """Range-partitioned by key and sorted inside, so files follow one another in order."""
    order = [key] + ([date_column] if date_column and date_column != key else [])
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
