"""Facts with distinct counts kept up to date load by load, late rows included.

A fact's state is what ``grouped_distinct_counts`` has after its first step: one row for each group,
counted column and value, with its flags and sums. States of different rows merge by the same
grouping, so a load is counted by itself, written beside the earlier ones, and only the groups that
it touches are finished anew, whatever their dates. Nothing of an earlier load is read but the
state of the touched days. A bitmap for each group would hold the same sets; most groups (a customer's
day, a quiet day) have a handful of values, for which the rows are smaller.

Every source row belongs to one load. A load that is repeated under its name changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.distinct_counts import DistinctCount, count_state, finish_counts, merge_states
from basketry.plans import marts

#: Days named one by one in the filter of a scan; beyond that it gets their range.
MAX_DAYS = 1000


@dataclass(frozen=True)
class CountedFact:
    """Rows of a fact's groups, what is counted in them, and the day that its state is laid out by."""

    rows: Callable[[DataFrame], DataFrame]
    counts: Callable[[], tuple[list[str], list[DistinctCount], dict[str, Column]]]
    day: str


COUNTED_FACTS = {
    "fct_sales_by_date": CountedFact(marts.sales_rows, marts.sales_counts, "sale_date"),
    "fct_customer_activity": CountedFact(marts.activity_rows, marts.activity_counts, "event_date"),
}


def _written(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def add_load(spark: SparkSession, root: str, name: str, source: DataFrame, load: str) -> DataFrame:
    """Count one load of ``source`` into the state under ``root``; the counts of its groups.

    The result has each group that the load touches, counted over all loads so far: these rows
    replace the fact's rows of the same groups. It is lazy; the load's own state is written here.
    """
    fact = COUNTED_FACTS[name]
    by, distinct, sums = fact.counts()
    state = count_state(fact.rows(source), by, distinct, sums)
    folder = f"{root.rstrip('/')}/{name}"
    mine = f"{folder}/load={load}"
    if not _written(spark, mine):
        # in order of days, a large day in several files: a reader of some days skips the others
        spread = state.repartitionByRange(F.col(fact.day), F.xxhash64(*by, "slot", "value"))
        spread.sortWithinPartitions(fact.day).write.mode("overwrite").parquet(mine)
    held = spark.read.schema(state.schema)
    touched = held.parquet(mine).select(*by).distinct()
    days = [r[0] for r in touched.select(fact.day).distinct().collect()]  # calendar days, one row each
    known = sorted(d for d in days if d is not None)
    of_days = F.col(fact.day).isin(known) if len(known) <= MAX_DAYS else F.col(fact.day).between(known[0], known[-1])
    if None in days:
        of_days = of_days | F.col(fact.day).isNull()
    loads = held.parquet(folder).select(*state.columns).where(of_days)
    same = [loads[c].eqNullSafe(touched[c]) for c in by]
    return finish_counts(merge_states(loads.join(touched, same, "left_semi"), by), by, distinct, list(sums))


def replace_groups(fact: DataFrame, fresh: DataFrame, by: list[str]) -> DataFrame:
    """``fact`` with its rows of the groups in ``fresh`` replaced by those."""
    same = [fact[c].eqNullSafe(fresh[c]) for c in by]
    return fact.join(fresh.select(*by), same, "left_anti").unionByName(fresh)
