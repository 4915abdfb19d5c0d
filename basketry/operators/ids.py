"""Checks and repairs of key columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir


def fill_missing_key(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Add a dense ``start, start + 1, …`` key column if the frame has none.

    Rows are numbered per partition and shifted by the rows of the partitions
    before it, so no task sees more than its own rows. The checkpoint fixes which
    row sits in which partition between the count and the numbering.
    """
    if key in df.columns:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    per_partition = F.shiftright("_row", 33)  # upper bits hold the partition id
    sizes = tagged.groupBy(per_partition.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    in_partition = F.col("_row") - F.shiftleft("_part", 33)
    return (
        tagged.withColumn("_part", per_partition)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(key, in_partition + F.col("_offset") + F.lit(start))
        .drop("_row", "_part", "_offset")
    )


def lost_ids(before: DataFrame, after: DataFrame, key: str, after_key: str | None = None) -> DataFrame:
    """Distinct keys of ``before`` that ``after`` no longer has."""
    kept = after.select(F.col(after_key or key).alias(key)).distinct()
    return before.select(key).distinct().join(kept, key, "left_anti")


def key_range(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key, one row."""
    return df.agg(F.min(key).alias("min_id"), F.max(key).alias("max_id"))


def id_gaps(df: DataFrame, key: str, block_bits: int = 20) -> DataFrame:
    """Ranges of missing ids between the smallest and the largest one.

    Ids are made distinct, then compared with their successor inside blocks of
    ``2 ** block_bits`` consecutive ids. What is left is one range per block; those are compared
    inside blocks of as many blocks, and so on until 64 bits are used up. A task sorts at most
    ``2 ** block_bits`` rows, however sparse the ids; the last level has a few rows.
    """
    ids = df.select(F.col(key).cast("bigint").alias("low")).filter("low is not null").distinct()
    level, pairs, shift = ids.withColumn("high", F.col("low")), None, block_bits
    while True:
        last = shift >= 64
        blocked = level.withColumn("block", F.lit(0) if last else F.shiftright("low", shift))
        following = F.lead("low").over(Window.partitionBy("block").orderBy("low"))
        found = blocked.select(F.col("high").alias("id"), following.alias("next_id"))
        pairs = found if pairs is None else pairs.unionByName(found)
        if last:
            break
        level = blocked.groupBy("block").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        level, shift = level.drop("block"), shift + block_bits
    return pairs.filter(F.col("next_id") - F.col("id") > 1).select(
        (F.col("id") + 1).alias("gap_start"),
        (F.col("next_id") - 1).alias("gap_end"),
        (F.col("next_id") - F.col("id") - 1).alias("missing_ids"),
    )


def gap_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: range, distinct ids, and how many are missing in between."""
    ids = df.select(F.col(key).cast("bigint").alias("id"))
    return ids.agg(
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.countDistinct("id").alias("distinct_ids"),
    ).withColumn("missing_ids", F.col("max_id") - F.col("min_id") + 1 - F.col("distinct_ids"))


def first_missing_ids(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` smallest missing ids, for the load report."""
    reach = F.least(F.col("gap_end"), F.col("gap_start") + (n - 1))
    return (
        id_gaps(df, key)
        .select(F.explode(F.sequence("gap_start", reach)).alias("missing_id"))
        .orderBy("missing_id")
        .limit(n)
    )
