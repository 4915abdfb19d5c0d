from __future__ import annotations

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators import columns, cutover, ids, merge, quality, sampling
from basketry.operators.adjacency import adjacent_pairs
from basketry.operators.audit import load_audit
from basketry.operators.dedup import drop_duplicate_keys
from basketry.operators.distinct_counts import DistinctCount, grouped_distinct_counts
from basketry.operators.quality import Check
from tests.conftest import rows

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
RAW = "ID string, V string, DATA_SOURCE string, BATCH_ID string, LOADED_AT timestamp_ntz"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def raw(spark, *records):
    return spark.createDataFrame([(*r,) for r in records], RAW)


# dedup


def test_latest_wins_a_tie_of_load_times(spark):
    df = raw(spark, ("1", "old", "historic", "b", T0), ("1", "new", "latest", "b", T0))
    assert [r.V for r in drop_duplicate_keys(df, "id").collect()] == ["new"]


def test_newest_load_wins_and_null_load_counts_as_newest(spark):
    df = raw(spark, ("1", "a", "latest", "b", T0), ("1", "b", "historic", "b", T1))
    assert drop_duplicate_keys(df, "id").first().V == "b"
    df = raw(spark, ("1", "a", "latest", "b", T1), ("1", "b", "historic", "b", None))
    assert drop_duplicate_keys(df, "id").first().V == "b"


def test_dedup_without_the_key_changes_nothing(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert drop_duplicate_keys(df, "id").count() == 2


@FEW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=30))
def test_dedup_leaves_each_key_once(spark, pairs):
    df = spark.createDataFrame([(str(k), str(v), "latest", "b", T0) for k, v in pairs], RAW)
    kept = [r.ID for r in drop_duplicate_keys(df, "id").collect()]
    assert sorted(kept) == sorted({str(k) for k, _ in pairs})


# upsert


def merge_case(spark):
    target = raw(
        spark,
        ("same", "x", "historic", "b0", T0),
        ("changed", "x", "historic", "b0", T0),
        ("filled", None, "historic", "b0", T0),
        ("emptied", "x", "historic", "b0", T0),
        ("untouched", "x", "historic", "b0", T0),
        (None, "keyless", "historic", "b0", T0),
    )
    source = raw(
        spark,
        ("same", "x", "latest", "b1", T1),
        ("changed", "y", "latest", "b1", T1),
        ("filled", "y", "latest", "b1", T1),
        ("emptied", None, "latest", "b1", T1),
        ("new", "n", "latest", "b1", T1),
        ("doubled", "old", "latest", "b1", T0),
        ("doubled", "new", "latest", "b1", T1),
    )
    return target, source


def test_upsert(spark):
    target, source = merge_case(spark)
    got = {(r.ID, r.V, r.BATCH_ID) for r in merge.upsert(target, source, "ID").collect()}
    assert got == {
        ("same", "x", "b0"),  # unchanged rows keep their old metadata
        ("changed", "y", "b1"),
        ("filled", "y", "b1"),
        ("emptied", None, "b1"),
        ("untouched", "x", "b0"),
        ("new", "n", "b1"),
        ("doubled", "new", "b1"),
        (None, "keyless", "b0"),
    }


def test_upsert_twice_is_once(spark):
    target, source = merge_case(spark)
    once = merge.upsert(target, source, "ID")
    assert rows(merge.upsert(once, source, "ID")) == rows(once)


def test_rows_without_a_key_are_merged_once(spark):
    target = raw(spark, ("1", "a", "historic", "b0", T0), (None, "x", "historic", "b0", T0))
    batch = raw(spark, (None, "x", "latest", "b1", T1), ("2", "c", "latest", "b1", T1))
    once = merge.upsert(target, batch, "ID")
    assert rows(once.select("ID", "V")) == [("1", "a"), ("2", "c"), (None, "x")]
    fresh = raw(spark, (None, "y", "latest", "b2", T1))
    twice = merge.upsert(merge.upsert(once, fresh, "ID"), fresh, "ID")
    assert rows(twice.filter("ID is null").select("V")) == [("x",), ("y",)]


def test_increment_of_nothing_is_everything(spark):
    batch = spark.createDataFrame([(1, 5), (2, 7)], "id int, d int")
    assert merge.append_increment(batch, "d", batch.limit(0)).count() == 2
    loaded = batch.filter("d = 5")
    assert rows(merge.append_increment(batch, "d", loaded)) == [(1, 5), (2, 7)]


# cut-over


def dated(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, d date")


def test_overlap_trims_later_and_undated_rows(spark):
    from datetime import date

    historic = dated(spark, date(2024, 1, 1), date(2024, 1, 5), date(2024, 1, 9), None)
    latest = dated(spark, date(2024, 1, 5))
    assert [r.id for r in cutover.trim_historic(historic, latest, "d").collect()] == [0]


def test_no_overlap_or_undated_latest_keeps_all(spark):
    from datetime import date

    historic = dated(spark, date(2024, 1, 1), None)
    for latest in (dated(spark, date(2024, 1, 5)), dated(spark, None), dated(spark)):
        assert cutover.trim_historic(historic, latest, "d").count() == 2


def test_combine_fills_columns_of_one_side(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "x int, z int")
    assert rows(cutover.combine(a, b).select("x", "y", "z")) == [(1, 2, None), (3, None, 4)]


def test_write_order(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "id int, d int")
    got = [tuple(r) for r in cutover.order_for_write(df, "id", "d").collect()]
    assert got == sorted(got)


# columns


def test_duplicate_names():
    assert columns.number_duplicate_names(["a", "b", "a"]) == ["a_1", "b", "a_2"]


def test_duplicate_columns_are_repaired_or_refused(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    assert columns.repair_duplicate_columns(df).columns == ["a_1", "b", "a_2"]
    with pytest.raises(ValueError, match="duplicate columns"):
        columns.assert_unique_columns(df)


def test_flatten_keeps_rows_aligned(spark):
    df = spark.createDataFrame(
        [(1, (7, ("x",)), [1, 2]), (2, None, None), (3, (9, ("z",)), [])],
        "id int, s struct<n:int, deep:struct<t:string>>, l array<int>",
    )
    flat = columns.flatten(df)
    assert flat.columns == ["id", "s_n", "s_deep_t", "l"]
    assert rows(flat) == [(1, 7, "x", "[1,2]"), (2, None, None, None), (3, 9, "z", "[]")]


def test_dates_are_found_by_name(spark):
    df = spark.createDataFrame(
        [("2023-01-01", "x", "2023-01-01T05:06:07.123", "2023-01-01")],
        "order_date string, bad_at string, created_at string, note string",
    )
    assert rows(columns.normalise_dates(df)) == [
        ("2023-01-01 00:00:00", None, "2023-01-01 05:06:07", "2023-01-01")
    ]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int")
    assert rows(columns.nan_to_null(df)) == [(2.0, 2), (None, 1)]


# ids


def test_gaps(spark):
    df = spark.createDataFrame([(str(i),) for i in (1, 2, 5, 5, 6, 9)], "id string")
    for bits in (20, 8, 5):  # one block, and several levels of blocks
        assert rows(ids.id_gaps(df, "id", bits)) == [(3, 4, 2), (7, 8, 2)]
    assert tuple(ids.gap_summary(df, "id").first()) == (1, 9, 5, 4)
    assert [r.missing_id for r in ids.first_missing_ids(df, "id", 3).collect()] == [3, 4, 7]


@FEW
@given(st.sets(st.integers(-50, 50), min_size=2, max_size=40))
def test_gaps_against_brute_force(spark, present):
    df = spark.createDataFrame([(i,) for i in present], "id bigint")
    found = set()
    for r in ids.id_gaps(df, "id", 6).collect():
        found |= set(range(r.gap_start, r.gap_end + 1))
    assert found == set(range(min(present), max(present) + 1)) - present


def test_gaps_of_sparse_ids(spark):
    present = sorted({(k * k * 5_000_000_011) % (1 << 62) - (1 << 61) for k in range(2000)})
    df = spark.createDataFrame([(i,) for i in present], "id bigint")
    gaps = ids.id_gaps(df, "id")
    got = sorted((r.gap_start, r.gap_end) for r in gaps.collect())
    assert got == [(a + 1, b - 1) for a, b in zip(present, present[1:]) if b - a > 1]
    # the only window over everything sees one row per 2 ** 60 ids
    plan = gaps._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4 and sum("block" not in w for w in windows) <= 1


def test_missing_key_is_filled_densely(spark):
    df = spark.range(1000).repartition(7).select(F.col("id").alias("x"))
    got = ids.fill_missing_key(df, "id", start=5)
    assert sorted(r.id for r in got.collect()) == list(range(5, 1005))
    assert ids.fill_missing_key(df, "x") is df


def test_lost_ids(spark):
    before = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    assert rows(ids.lost_ids(before, before.filter("id <> 2"), "id")) == [(2,)]


# adjacency


def brute_pairs(events):
    counts: dict = {}
    by_key: dict = {}
    for key, when, tie, state in events:
        if key is not None and state is not None:
            by_key.setdefault(key, []).append((when, tie, state))
    for key, seq in by_key.items():
        seq.sort()
        for a, b in zip(seq, seq[1:]):
            counts[key, a[2], b[2]] = counts.get((key, a[2], b[2]), 0) + 1
    return counts


@pytest.mark.parametrize("hot", [0.0, 0.5, 1.0])
def test_adjacent_pairs_with_a_hot_sequence(spark, hot):
    rng = random.Random(7)
    events = [
        ("hot" if rng.random() < hot else f"s{rng.randint(0, 40)}", rng.randint(0, 3), i, rng.choice("abc"))
        for i in range(3000)
    ] + [(None, 1, 9000, "a"), ("s1", 1, 9001, None)]
    events += [("hot", 2, 9002, "b")] * 700 + [("s2", 0, 9003, "c")] * 5  # groups of copies
    df = spark.createDataFrame(events, "k string, t int, i int, state string").repartition(5)
    # keep small partitions apart, so that a hot sequence really spans several
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = adjacent_pairs(df, "k", ["t", "i"], "state")
        total = pairs.groupBy("sequence", "source", "target").agg(F.sum("n").alias("n"))
        got = {(r.sequence, r.source, r.target): r.n for r in total.collect()}
        folded = adjacent_pairs(df, "k", ["t", "i"], "state", keep_sequence=False)
        short = {
            (r.source, r.target): r.n
            for r in folded.groupBy("source", "target").agg(F.sum("n").alias("n")).collect()
        }
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute_pairs(events)
    assert got == want
    merged: dict = {}
    for (_, a, b), n in want.items():
        merged[a, b] = merged.get((a, b), 0) + n
    assert short == merged


def test_adjacent_pairs_are_built_without_a_job(spark):
    df = spark.range(4000).selectExpr("'s' AS k", "id AS t", "string(id % 3) AS state").repartition(8, "t")
    spark.sparkContext.setJobGroup("pairs", "building only")
    try:
        pairs = adjacent_pairs(df, "k", ["t"], "state", keep_sequence=False)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("pairs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = pairs._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    total = pairs.groupBy("source", "target").agg(F.sum("n").alias("n"))
    assert rows(total) == [("0", "1", 1333), ("1", "2", 1333), ("2", "0", 1333)]


def test_adjacent_pairs_of_nothing_and_of_one_row(spark):
    shape = "k string, t int, state string"
    assert adjacent_pairs(spark.createDataFrame([], shape), "k", ["t"], "state").collect() == []
    assert adjacent_pairs(spark.createDataFrame([("a", 1, "x")], shape), "k", ["t"], "state").collect() == []
    lone = spark.createDataFrame([(k, None, "x") for k in "aabc"], shape)
    assert rows(adjacent_pairs(lone, "k", ["t"], "state")) == [("a", "x", "x", 1)]


# distinct counts


def test_distinct_counts_match_the_plain_form(spark):
    rng = random.Random(3)
    data = [
        (rng.choice("xy"), rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.randint(0, 9))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "g string, p string, q int, n int")
    got = grouped_distinct_counts(
        df,
        ["g"],
        [
            DistinctCount("p_all", "p"),
            DistinctCount("p_big", "p", F.col("n") > 8),
            DistinctCount("q_all", "q"),
        ],
        {"total": F.col("n")},
    )
    want = df.groupBy("g").agg(
        F.countDistinct("p"),
        F.countDistinct(F.when(F.col("n") > 8, F.col("p"))),
        F.countDistinct("q"),
        F.sum("n"),
    )
    assert rows(got) == rows(want)


# sampling


def test_exact_sample(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    first = sampling.sample_keys(df, "id", 137)
    assert first.count() == 137
    assert rows(first) == rows(sampling.sample_keys(df.repartition(9), "id", 137))
    assert sampling.sample_keys(df, "id", 5000).count() == 1000
    assert sampling.sample_keys(df, "id", 0).count() == 0


def test_fraction_sample_is_repeatable(spark):
    df = spark.range(10_000).select(F.col("id").cast("string").alias("id"))
    part = sampling.sample_fraction(df, "id", 0.2)
    large = spark.range(3_000_000)
    assert 5 <= sampling.sample_fraction(large, "id", 5e-6).count() <= 30
    assert 1 <= sampling.sample_fraction(large, "id", 1e-6).count() <= 10
    assert 1700 < part.count() < 2300
    assert rows(part) == rows(sampling.sample_fraction(df.repartition(3), "id", 0.2))


# audit and quality


def test_audit_counts(spark):
    df = raw(
        spark,
        ("1", "a", "historic", "b", T0),
        ("1", "a", "latest", "b", T0),
        ("2", "a", "latest", "b", T0),
        (None, "a", "latest", "b", T0),
        (None, "a", "latest", "b", T0),
    )
    report = load_audit(df, df, "things", "id", None, "b", T0).first()
    assert (report.historic_records, report.latest_records) == (1, 4)
    assert (report.total_records, report.duplicates_removed) == (3, 2)
    assert drop_duplicate_keys(df, "id").count() == report.total_records


def test_checks_on_orphans(spark):
    child = spark.createDataFrame(
        [("1", "p1"), ("2", "gone"), ("2", "gone"), ("3", None)], "id string, p string"
    )
    parent = spark.createDataFrame([("p1",), ("p1",)], "pid string")
    report = quality.run_checks(
        {"child": child, "parent": parent},
        [
            Check("child", "id", "unique"),
            Check("child", "p", "not_null"),
            Check("child", "p", "relationships", "parent.pid"),
            Check("child", "p", "relationships", "parent.pid", "warn"),
            Check("child", "id, p", "grain"),
            Check("child", "id", "not_null"),
        ],
    )
    assert [(r.check_name, r.failing_rows, r.status) for r in report.collect()] == [
        ("unique", 1, "fail"),
        ("not_null", 1, "fail"),
        ("relationships", 2, "fail"),
        ("relationships", 2, "warn"),
        ("grain", 1, "fail"),
        ("not_null", 0, "pass"),
    ]


def test_checks_on_the_columns_of_one_grain(spark):
    """The table is folded on its grain first; copies count as rows, and a key with a NULL is none."""
    data = [("1", "a"), ("1", "a"), ("2", None), ("2", None), ("3", "gone"), ("3", "gone"), ("3", "b")]
    facts = spark.createDataFrame(data, "id string, p string")
    parent = spark.createDataFrame([("a",), ("b",)], "pid string")
    checks = [
        Check("facts", "id, p", "grain"),
        Check("facts", "id", "unique"),
        Check("facts", "p", "not_null"),
        Check("facts", "p", "relationships", "parent.pid"),
        Check("parent", "pid", "unique"),
    ]
    report = quality.run_checks({"facts": facts.groupBy("id", "p").count().drop("count"), "parent": parent}, checks)
    assert [r.failing_rows for r in report.collect()] == [0, 1, 1, 1, 0]
    report = quality.run_checks({"facts": facts, "parent": parent}, checks)
    assert [r.failing_rows for r in report.collect()] == [2, 3, 2, 2, 0]


def test_two_parents_of_one_column_are_kept_apart(spark):
    child = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "c string")
    a, b = (spark.createDataFrame([(k,) for k in keys], "k string") for keys in (["1", "2"], ["2", "2"]))
    report = quality.run_checks(
        {"child": child, "a": a, "b": b},
        [
            Check("child", "c", "relationships", "a.k"),
            Check("child", "c", "relationships", "b.k"),
            Check("child", "c", "unique"),
        ],
    )
    assert [r.failing_rows for r in report.collect()] == [0, 1, 1]
    with pytest.raises(quality.FailedChecks, match="child.c relationships: 1"):
        quality.require(report)
    quality.require(report.filter("failing_rows = 0"))


def test_checks_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "id string")
    report = quality.run_checks({"t": empty}, [Check("t", "id", "not_null")])
    assert rows(report) == [("t", "id", "not_null", "error", 0, "pass")]


def test_pieces_of_a_sequence_are_dealt_and_sorted_by_the_sequence(spark, capsys):
    rows = [(f"s{k % 3}", k // 3, "ab"[k % 2]) for k in range(30)] + [("hot", k, "abc"[k % 3]) for k in range(300)]
    df = spark.createDataFrame(rows, "sequence string, place int, state string").repartition(4)
    pairs = adjacent_pairs(df, "sequence", ["place"], "state")
    pairs.explain()
    window = next(x for x in capsys.readouterr().out.splitlines() if "windowspecdefinition" in x)
    assert window.split("windowspecdefinition(")[1].startswith("sequence")
    got = {(r["sequence"], r["source"], r["target"]): 0 for r in pairs.collect()}
    for r in pairs.collect():
        got[r["sequence"], r["source"], r["target"]] += r["n"]
    assert got[("hot", "a", "b")] + got[("hot", "b", "c")] + got[("hot", "c", "a")] == 299
    assert sum(got.values()) == 299 + 3 * 9
