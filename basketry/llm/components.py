"""Connected components of links between 64-bit keys, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) rows to (u, v, least): the least neighbour of u, u itself included.

    The minimum is an aggregate that combines before the shuffle; a hub's rows are joined, not
    gathered, so AQE can split them.
    """
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every greater neighbour of u is linked to the least neighbour of u."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them."""
    found = _to_smallest(links)
    others = found.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = found.select("u", F.col("least").alias("v"))
    return others.union(own).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every linked key, root the least key it can reach; ``links`` has u > v.

    Each round is checkpointed to the shared folder, so a lost executor costs one round.
    """

    def state(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    links = links.distinct().checkpoint(eager=True)
    before = state(links)
    if not before[0]:
        return links.select("u", F.col("v").alias("root"))
    while True:
        links = _small_star(_large_star(links)).checkpoint(eager=True)
        now = state(links)
        if now == before:
            break
        before = now
    roots = links.select("u", F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("u"), "root").distinct())
