"""Repeatable samples: a row is in or out by the hash of its key, on every retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 15
_BITS = 4 * _DIGITS
_SLOT_BITS = 16


def key_hash(key: str, seed: int) -> Column:
    """The first 60 bits of an MD5 over seed and key, which any engine can compute; NULL for NULL."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the keys, with all their rows; no shuffle. NULL keys are left out."""
    return df.filter(key_hash(key, seed) < F.lit(int(fraction * (1 << _BITS))))


def sample_keys(df: DataFrame, key: str, n: Column | int, seed: int = 42) -> DataFrame:
    """All rows of exactly ``n`` distinct keys (all keys if there are fewer), NULL left out.

    The keys of least hash are taken, so the sample is a filter up to the n-th one. That one
    is found by counting keys per hash slot (a fixed 65,536 rows) and ranking the keys of
    the one slot it lies in; nothing is sorted globally and no row is joined.
    """
    wanted = F.lit(n) if isinstance(n, int) else n
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    keys = keys.withColumn("_hash", key_hash(key, seed))
    slot = F.shiftright("_hash", _BITS - _SLOT_BITS)
    sizes = keys.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_size"))
    upto = F.sum("_size").over(Window.orderBy("_slot"))
    edge = (
        sizes.withColumn("_upto", upto)
        .filter(F.col("_upto") >= wanted)
        .agg(F.min(F.struct("_slot", (wanted - (F.col("_upto") - F.col("_size"))).alias("_room"))).alias("edge"))
    )
    ranked = (
        keys.filter(slot == edge.select("edge._slot").scalar())
        .withColumn("_rank", F.row_number().over(Window.orderBy("_hash", key)))
        .filter(F.col("_rank") == edge.select("edge._room").scalar())
    )
    last = ranked.agg(F.max(F.struct("_hash", F.col(key).alias("_key"))).alias("last"))
    last_hash, last_key = last.select("last._hash").scalar(), last.select("last._key").scalar()
    mine = key_hash(key, seed)
    upto_last = (mine < last_hash) | ((mine == last_hash) & (F.col(key) <= last_key))
    return df.filter(F.col(key).isNotNull() & (wanted > 0) & F.coalesce(upto_last, F.lit(True)))


def refresh_sampled(
    existing: DataFrame,
    fresh: DataFrame,
    key: str,
    fraction: float,
    overrides: dict[str, Column],
    seed: int = 42,
) -> DataFrame:
    """A sample of existing rows with some columns overwritten, joined by the new rows."""
    returning = sample_fraction(existing, key, fraction, seed).withColumns(overrides)
    return returning.unionByName(fresh, allowMissingColumns=True)
