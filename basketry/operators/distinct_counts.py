"""Several distinct counts in one grouping without one row copy per aggregate.

Spark plans ``k`` distinct counts plus ordinary aggregates by copying every row
``k + 1`` times. Here distinct counts over the same value share one copy, and the
ordinary aggregates ride along with the first value. Both steps combine before
they shuffle, and the first shuffles on (group, value), so a hot group is spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DistinctCount:
    """Count distinct non-NULL ``value``, on rows where ``only`` holds if given."""

    alias: str
    value: str
    only: Column | None = None


def _flags(distinct: list[DistinctCount]) -> dict[str, Column | None]:
    return {
        d.alias: F.coalesce(d.only, F.lit(False)) if d.only is not None else None
        for d in distinct
    }


def count_state(
    df: DataFrame,
    by: list[str],
    distinct: list[DistinctCount],
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group, counted column (``slot``) and value, with its flags and sums.

    States of different rows can be put together by ``merge_states``.
    """
    sums = sums or {}
    values = list(dict.fromkeys(d.value for d in distinct))
    flags = _flags(distinct)

    def null_like(expr: Column) -> Column:
        # same type as expr, always NULL
        return F.when(F.lit(False), expr)

    copies = []
    for slot, value in enumerate(values):
        fields = [F.lit(slot).alias("slot"), F.col(value).cast("string").alias("value")]
        for d in distinct:
            if flags[d.alias] is not None:
                fields.append(
                    (flags[d.alias] if d.value == value else F.lit(False)).alias(f"only_{d.alias}")
                )
        for name, expr in sums.items():
            fields.append((expr if slot == 0 else null_like(expr)).alias(f"sum_{name}"))
        copies.append(F.struct(*fields))

    if len(copies) == 1:
        tall = df.select(*by, copies[0].alias("c")).select(*by, "c.*")
    else:
        tall = df.select(*by, F.inline(F.array(*copies)))

    return tall.groupBy(*by, "slot", "value").agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.max(f"only_{alias}").alias(f"only_{alias}")
            for alias, flag in flags.items()
            if flag is not None
        ],
        *[F.sum(f"sum_{name}").alias(f"sum_{name}") for name in sums],
    )


def merge_states(states: DataFrame, by: list[str]) -> DataFrame:
    """The state of all rows from states of parts of them, unioned."""
    others = [c for c in states.columns if c not in (*by, "slot", "value", "rows")]
    return states.groupBy(*by, "slot", "value").agg(
        F.sum("rows").alias("rows"),
        *[(F.max if c.startswith("only_") else F.sum)(c).alias(c) for c in others],
    )


def finish_counts(
    state: DataFrame, by: list[str], distinct: list[DistinctCount], sums: list[str]
) -> DataFrame:
    """One row per group: a column per distinct count, one per sum."""
    values = list(dict.fromkeys(d.value for d in distinct))
    outputs = []
    for d in distinct:
        hit = (F.col("slot") == values.index(d.value)) & F.col("value").isNotNull()
        if d.only is not None:
            hit = hit & F.col(f"only_{d.alias}")
        outputs.append(F.count(F.when(hit, 1)).alias(d.alias))
    outputs += [F.sum(f"sum_{name}").alias(name) for name in sums]
    return state.groupBy(*by).agg(*outputs)


def grouped_distinct_counts(
    df: DataFrame,
    by: list[str],
    distinct: list[DistinctCount],
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Group by ``by`` columns; one column per distinct count, one per sum.

    ``sums`` expressions are summed over all rows (NULLs skipped).
    """
    return finish_counts(count_state(df, by, distinct, sums), by, distinct, list(sums or {}))
