"""Tables of versions: merges equal an upsert and rewrite only files that hold changed rows."""

from __future__ import annotations

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketry.operators.merge import upsert
from basketry.plans.ingest import Run, merge_into_files, transform
from basketry.sources import versions
from basketry.sources.versions import (
    candidate_files,
    create_table,
    latest_version,
    manifest,
    merge_version,
    read_version,
)
from tests.conftest import rows

SCHEMA = "ID {}, V string, N double, BATCH_ID string, LOADED_AT timestamp"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def key_of(i, kind):
    return i if kind == "long" else f"k{i:06d}"


def made(spark, pairs, kind="long", batch="b0", at=T0):
    data = [(None if i is None else key_of(i, kind), v, 1.0, batch, at) for i, v in pairs]
    return spark.createDataFrame(data, SCHEMA.format(kind))


def files_under(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "t")
    create_table(made(spark, [(i, "x") for i in range(0, 10000, 2)]), root, "ID", rows_per_file=250)
    return root


def test_a_batch_rewrites_only_files_with_its_keys(spark, table):
    before = {r["file"]: (r["least"], r["greatest"]) for r in manifest(spark, table).collect()}
    assert len(before) >= 20
    done = merge_version(made(spark, [(i, "y") for i in range(4000, 4100)], batch="b1", at=T1), table, "ID")
    hit = {f for f, (a, b) in before.items() if a < 4100 and b >= 4000}
    assert (done.version, done.updated, done.inserted, done.rewritten) == (2, 50, 50, len(hit))
    assert len(hit) <= 2
    after = {r["file"] for r in manifest(spark, table).collect()}
    assert set(before) - after == hit


def test_new_keys_between_old_ones_rewrite_nothing(spark, table):
    batch = made(spark, [(i, "n") for i in range(1, 10000, 100)], batch="b1", at=T1)
    asked = candidate_files(manifest(spark, table), batch, table, "ID").count()
    assert asked <= 3  # the Bloom filter, at a fraction of a per cent
    done = merge_version(batch, table, "ID")
    assert (done.updated, done.inserted, done.rewritten) == (0, 100, 0)
    assert read_version(spark, table).count() == 5100


def test_replay_writes_nothing(spark, table):
    batch = made(spark, [(0, "y"), (1, "n"), (None, "u")], batch="b1", at=T1)
    assert merge_version(batch, table, "ID").version == 2
    data = files_under(f"{table}/files")
    again = merge_version(batch.withColumn("BATCH_ID", F.lit("b2")), table, "ID")
    assert (again.version, again.updated, again.inserted, again.rewritten) == (2, 0, 0, 0)
    assert files_under(f"{table}/files") == data
    assert merge_version(batch.limit(0), table, "ID").version == 2


def test_older_versions_stay_readable(spark, table):
    old = rows(read_version(spark, table, 1))
    merge_version(made(spark, [(i, "y") for i in range(0, 600)], batch="b1", at=T1), table, "ID")
    assert rows(read_version(spark, table, 1)) == old
    assert latest_version(spark, table) == 2


@pytest.mark.parametrize("kind", ["long", "string"])
def test_many_merges_equal_upserts(spark, tmp_path, kind):
    rng, root = random.Random(1), str(tmp_path / "t")
    start = [(i, rng.choice("xy")) for i in range(600)] + [(None, "a"), (None, "b"), (None, None)]
    expected = made(spark, start, kind)
    create_table(expected, root, "ID", rows_per_file=60)
    for k in range(2):
        pairs = [(rng.randrange(900), rng.choice(["x", "y", "z", None])) for _ in range(30)]
        pairs = list(dict(pairs).items()) + [(None, rng.choice("abc"))]
        batch = made(spark, pairs, kind, f"m{k}", T1)
        merge_version(batch, root, "ID", rows_per_file=60)
        expected = spark.createDataFrame(upsert(expected, batch, "ID").collect(), expected.schema)
        assert rows(read_version(spark, root)) == rows(expected)


def test_empty_tables_and_missing_ones(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no table"):
        merge_version(made(spark, [(1, "x")]), root, "ID")
    create_table(made(spark, []), root, "ID")
    assert read_version(spark, root).count() == 0
    done = merge_version(made(spark, [(1, "x"), (None, "y")]), root, "ID")
    assert (done.updated, done.inserted) == (0, 2)
    assert read_version(spark, root).columns == ["ID", "V", "N", "BATCH_ID", "LOADED_AT"]
    with pytest.raises(Exception, match="(?i)exists"):
        create_table(made(spark, []), root, "ID")


def test_wide_files_are_found_under_coarse_bins(spark, table):
    wide = made(spark, [(i, "w") for i in range(1, 10000, 50)], batch="b1", at=T1)
    merge_version(wide, table, "ID")  # files that span all keys
    done = merge_version(made(spark, [(51, "v"), (9951, "v"), (9998, "v")], batch="b2", at=T1), table, "ID")
    assert (done.updated, done.inserted) == (3, 0)
    assert read_version(spark, table).where("V = 'v'").count() == 3


def test_ingest_keeps_tables_of_files(spark, tmp_path):
    root = str(tmp_path / "raw_orders")
    columns = "order_id string, order_date string, total_amount double"
    first = spark.createDataFrame([(str(i), "2024-01-01", 1.0) for i in range(50)], columns)
    later = spark.createDataFrame([("3", "2024-01-02", 2.0), ("99", "2024-01-02", 1.0)], columns)
    merge_into_files(spark, root, transform(first, "orders", "historic", Run("r0", T0)), "orders")
    batch = transform(later, "orders", "latest", Run("r1", T1))
    done = merge_into_files(spark, root, batch, "orders")
    assert (done.version, done.updated, done.inserted) == (2, 1, 1)
    assert merge_into_files(spark, root, batch, "orders").version == 2
    assert read_version(spark, root).count() == 51
    with pytest.raises(ValueError, match="no columns"):
        merge_into_files(spark, root, batch.withColumn("EXTRA", F.lit(1)), "orders")


def test_rows_get_their_file_without_a_regular_expression(spark, table):
    """The name is worked out for every row read, so it has to be cheap."""
    listed = {r["file"] for r in manifest(spark, table).collect()}
    read = versions._files(spark, table, sorted(listed), versions._schema(spark, table, "empty"))
    assert {r["_file"] for r in read.select("_file").distinct().collect()} == listed
    assert "regexp" not in read._jdf.queryExecution().optimizedPlan().toString()
