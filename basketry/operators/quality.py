"""Data-quality checks: one pass over each table, whatever the number of checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import surrogate_key


@dataclass(frozen=True)
class Check:
    """``not_null``, ``unique``, ``relationships`` (to ``parent``) or ``grain``.

    ``column`` may name several columns separated by commas for a grain check.
    """

    table: str
    column: str
    kind: str
    parent: str = ""  # "table.column"
    severity: str = "error"


def _columns(target: str) -> list[str]:
    return [c.strip() for c in target.split(",")]


def _key_text(target: str, values_matter: bool) -> Column:
    columns = _columns(target)
    if len(columns) > 1:
        complete = reduce(and_, [F.col(c).isNotNull() for c in columns])
        return F.when(complete, surrogate_key(*columns))
    if values_matter:
        return F.col(target).cast("string")
    # all present values fold into one row per task
    return F.when(F.col(target).isNotNull(), F.lit(""))


def _folded(df: DataFrame, targets: list[str]) -> tuple[DataFrame, str | None]:
    """A table whose checks ask for the columns of one grain alone, as (grain, rows), and that grain.

    Facts lie by a part of their grain where they were grouped or joined, so the fold is no shuffle;
    of a grain only the keys found in several rows are then left to tell.
    """
    grains = [t for t in targets if len(_columns(t)) > 1]
    if len(grains) != 1 or not {c for t in targets for c in _columns(t)} <= set(_columns(grains[0])):
        return df.withColumn("_rows", F.lit(1)), None
    return df.groupBy(*_columns(grains[0])).agg(F.count(F.lit(1)).alias("_rows")), grains[0]


def _literal(rows: list, names: str) -> Column:
    columns = names.split()
    return F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows])


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Report ``(table_name, column_name, check_name, severity, failing_rows, status)``.

    ``failing_rows`` counts rows, except for unique and grain checks, which count the
    key values that occur more than once. A NULL child key passes a relationship, and a key with a
    NULL in it is no key of a grain.

    Every table is read once, children and parents alike: its checked columns fold to
    (slot, value, rows), a slot being one column of one table. A parent's values then meet those
    of all its children in one grouping on (parent, value).
    """
    checks = list(checks)
    if not checks:
        raise ValueError("no checks given")
    for check in checks:
        if check.kind not in ("not_null", "unique", "grain", "relationships"):
            raise ValueError(f"unknown check {check.kind}")
    relations: dict[tuple[str, str], list[int]] = {}  # parent column -> its checks
    for number, check in enumerate(checks):
        if check.kind == "relationships":
            table, column = check.parent.split(".")
            relations.setdefault((table, column), []).append(number)
    parents = list(relations)
    slots = list(dict.fromkeys([(c.table, c.column) for c in checks] + parents))

    # what a value of a slot counts for: (kind, group, place, check)
    rules: dict[tuple[str, str], list[tuple]] = {slot: [] for slot in slots}
    for number, check in enumerate(checks):
        if check.kind != "relationships":
            kind = "not_null" if check.kind == "not_null" else "unique"
            rules[check.table, check.column].append((kind, -1, 0, number))
    for group, parent in enumerate(parents):
        rules[parent].append(("parent", group, -1, -1))
        for place, number in enumerate(relations[parent]):
            child = checks[number]
            rules[child.table, child.column].append(("child", group, place, number))

    tall = None
    for name in dict.fromkeys(table for table, _ in slots):
        own = {column: number for number, (table, column) in enumerate(slots) if table == name}
        table, grain = _folded(tables[name], list(own))
        values = []
        for column, number in own.items():
            value = _key_text(column, any(rule[0] != "not_null" for rule in rules[name, column]))
            if column == grain:
                value = F.when(F.col("_rows") > 1, value)
            values.append(F.struct(F.lit(number).alias("slot"), value.alias("value"), F.col("_rows").alias("rows")))
        part = table.select(F.inline(F.array(*values)))
        tall = part if tall is None else tall.unionByName(part)
    # a hot value, NULL included, is folded here before anything else shuffles
    profile = tall.groupBy("slot", "value").agg(F.sum("rows").alias("rows"))

    by_slot = F.array(*[_literal(rules[slot], "kind group place check") for slot in slots])
    kind, value = F.col("kind"), F.col("value")
    counted = (
        profile.select("value", "rows", F.inline(F.element_at(by_slot, F.col("slot") + 1)))
        .withColumn(
            "n",
            F.when((kind == "not_null") & value.isNull(), F.col("rows"))
            .when((kind == "unique") & value.isNotNull() & (F.col("rows") > 1), 1)
            .when((kind == "child") & value.isNotNull(), F.col("rows"))
            .when((kind == "parent") & value.isNotNull(), 0),
        )
        .filter("n is not null")
        # a check without a parent is one group of its own
        .select(
            "group",
            "place",
            "n",
            F.when(F.col("group") < 0, F.col("check").cast("string")).otherwise(value).alias("value"),
        )
    )
    places = max([1, *map(len, relations.values())])
    met = counted.groupBy("group", "value").agg(
        F.bool_or(F.col("place") == -1).alias("known"),
        *[F.sum(F.when(F.col("place") == p, F.col("n"))).alias(f"n{p}") for p in range(places)],
    )
    numbers = [relations[parent] + [-1] * (places - len(relations[parent])) for parent in parents]
    check_of = F.array(*[F.array(*map(F.lit, row)) for row in numbers or [[-1]]])
    failed = met.filter("not known").select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.when(F.col("group") < 0, value.cast("int"))
                        .otherwise(F.get(F.get(check_of, F.col("group")), F.lit(p)))
                        .alias("check"),
                        F.col(f"n{p}").alias("failing"),
                    )
                    for p in range(places)
                ]
            )
        )
    )
    counts = failed.filter("failing > 0").groupBy("check").agg(F.sum("failing").alias("failing"))
    listed = [(i, c.table, c.column, c.kind, c.severity) for i, c in enumerate(checks)]
    names = "check table_name column_name check_name severity"
    # one entry per failed check, listed in the order of the checks
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("check", "failing"))).alias("found"))
    return (
        found.select("found", F.inline(_literal(listed, names)))
        .select(
            *names.split()[1:],
            F.coalesce(F.try_element_at("found", F.col("check")), F.lit(0)).cast("bigint").alias("failing_rows"),
        )
        .withColumn(
            "status",
            F.when(F.col("failing_rows") == 0, "pass")
            .when(F.col("severity") == "warn", "warn")
            .otherwise("fail"),
        )
    )


class FailedChecks(Exception):
    """Raised by ``require``; the message lists the checks."""


def require(report: DataFrame) -> None:
    """Stop a job whose report has failed checks of severity ``error``.

    Brings the failed lines of the report, at most one per check, to the driver.
    """
    failed = report.filter("status = 'fail'").orderBy("table_name", "column_name", "check_name").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failing_rows}" for r in failed]
        raise FailedChecks("; ".join(lines))
