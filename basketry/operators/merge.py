"""Upsert of a batch into a snapshot, and append past a high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.dedup import drop_duplicate_keys
from basketry.schemas import METADATA_COLUMNS


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    date_column: str | None = None,
) -> DataFrame:
    """New snapshot of ``target`` after merging ``source`` on ``key``.

    Matched rows take every source column, but only if some non-metadata column
    differs (NULL-safe); unmatched source rows are inserted; nothing is deleted.
    ``target`` holds each non-NULL key once. NULL keys never match a key: target rows with one
    are passed by the join, which also keeps them off a single task, and a source row with
    one is inserted unless the target holds the same row (metadata aside), so that a batch
    merged twice is merged once.
    """
    columns = target.columns
    metadata = {c.lower() for c in METADATA_COLUMNS}
    newest = drop_duplicate_keys(source, key, date_column).select(*columns)

    content = [c for c in columns if c.lower() not in metadata]
    whole_row = F.struct(*[F.col(c) for c in content])
    unkeyed = target.filter(F.col(key).isNull())
    held = unkeyed.select(whole_row.alias("_row")).distinct()
    new_unkeyed = newest.filter(F.col(key).isNull()).withColumn("_row", whole_row)
    new_unkeyed = new_unkeyed.join(held, "_row", "left_anti").select(*columns)

    keyed = target.filter(F.col(key).isNotNull()).withColumn("_in_target", F.lit(True)).alias("t")
    batch = newest.filter(F.col(key).isNotNull()).withColumn("_in_source", F.lit(True)).alias("s")
    joined = keyed.join(batch, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")

    changed: Column = F.lit(False)
    for column in columns:
        if column != key and column.lower() not in metadata:
            changed = changed | ~F.col(f"t.{column}").eqNullSafe(F.col(f"s.{column}"))
    take_source = F.col("_in_source").isNotNull() & (F.col("_in_target").isNull() | changed)
    merged = joined.select(
        *[
            F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in columns
        ]
    )
    return merged.unionByName(unkeyed).unionByName(new_unkeyed)


def newer_than_target(batch: DataFrame, column: str, target: DataFrame, mark: str) -> DataFrame:
    """Rows of ``batch`` past the newest ``mark`` in ``target``; all if it is empty.

    The mark is a scalar subquery: computed once on the cluster, pushed to the scan.
    """
    newest = target.agg(F.max(mark)).scalar()
    return batch.filter(newest.isNull() | (F.col(column) > newest))


def append_increment(
    batch: DataFrame, column: str, target: DataFrame, mark: str | None = None
) -> DataFrame:
    """Target plus the rows past its high-water mark."""
    fresh = newer_than_target(batch, column, target, mark or column)
    return target.unionByName(fresh.select(*target.columns))
