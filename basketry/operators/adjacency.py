"""Neighbouring rows of an ordered sequence, for sequences of any length.

``lead()`` over a sequence puts all of it into one task. Here copies of a row are folded
into one with a count, so that no order key repeats, and rows are range partitioned on
(sequence, order), which cuts a long sequence wherever it must. ``lead()`` runs inside the piece
of a sequence that lies in one range, so pieces spread evenly and are sorted by their sequence
first; the pairs across two ranges come from the first and last row of every piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_END = "struct<part: int, side: int, state: string>"


def _pair(where: Column, source: str, target: str, n: Column) -> Column:
    """A counted pair where the condition holds, else NULL."""
    columns = {"sequence": F.col("sequence"), "source": F.col(source), "target": F.col(target)}
    named = [*columns.items(), ("n", n.cast("bigint")), ("end", F.lit(None).cast(_END))]
    return F.when(where, F.struct(*[c.alias(name) for name, c in named]))


def _end(where: Column, side: int) -> Column:
    """The first (0) or last (1) row of a piece where the condition holds, else NULL."""
    end = F.struct(F.col("part"), F.lit(side), F.col("state")).cast(_END)
    nothing = [F.lit(None).cast("string").alias(c) for c in ("source", "target")]
    n = F.lit(0).cast("bigint").alias("n")
    return F.when(where, F.struct(F.col("sequence"), *nothing, n, end.alias("end")))


def adjacent_pairs(
    df: DataFrame,
    sequence: str,
    order: Sequence[str],
    state: str,
    keep_sequence: bool = True,
) -> DataFrame:
    """Counts ``(sequence, source, target, n)`` of neighbours in each sequence.

    Rows without a sequence or a state are left out; rows equal in every order column follow
    one another by state. The same combination may occur on several rows: group the result.
    With ``keep_sequence=False`` the sequence is NULL and the counts are over all sequences.
    Nothing runs while the plan is built: pairs inside a piece and the ends of the pieces come
    out of one pass, so both see the same ranges.
    """
    keys = [f"order_{i}" for i in range(len(order))]
    folded = (
        df.filter(F.col(sequence).isNotNull() & F.col(state).isNotNull())
        .select(
            F.col(sequence).cast("string").alias("sequence"),
            *[F.col(c).alias(k) for c, k in zip(order, keys)],
            F.col(state).cast("string").alias("state"),
        )
        .groupBy("sequence", *keys, "state")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ranged = folded.repartitionByRange("sequence", *keys, "state").withColumn(
        "part", F.spark_partition_id()
    )
    inside = Window.partitionBy("sequence", "part").orderBy(*keys, "state")
    steps = ranged.select(
        "part",
        "sequence",
        "state",
        "copies",
        F.lead("state").over(inside).alias("next_state"),
        F.lag("state").over(inside).isNull().alias("first"),
    )
    found = F.array(
        _pair(F.col("next_state").isNotNull(), "state", "next_state", F.lit(1)),
        _pair(F.col("copies") > 1, "state", "state", F.col("copies") - 1),
        _end(F.col("first"), 0),
        _end(F.col("next_state").isNull(), 1),
    )
    entries = steps.select(F.inline(F.filter(found, lambda e: e.isNotNull())))
    if not keep_sequence:
        ends_only = F.when(F.col("source").isNull(), F.col("sequence"))
        entries = entries.withColumn("sequence", ends_only)
    # a sequence's group without a source: its ends, two per range that holds some of it
    counted = entries.groupBy("sequence", "source", "target").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list("end")).alias("ends")
    )

    def bridge(left: Column, right: Column) -> Column:
        meets = (left["side"] == 1) & right["part"].isNotNull()  # zip_with pads the last
        kept = F.col("sequence") if keep_sequence else F.lit(None).cast("string")
        names = ("sequence", "source", "target", "n")
        values = (kept, left["state"], right["state"], F.lit(1).cast("bigint"))
        return F.when(meets, F.struct(*[v.alias(c) for c, v in zip(names, values)]))

    ends = F.col("ends")
    shifted = F.slice(ends, F.lit(2), F.greatest(F.size(ends) - 1, F.lit(0)))
    bridges = F.filter(F.zip_with(ends, shifted, bridge), lambda p: p.isNotNull())
    whole = F.array(F.struct("sequence", "source", "target", "n"))
    return counted.select(F.inline(F.when(F.col("source").isNull(), bridges).otherwise(whole)))
