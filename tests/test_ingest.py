from __future__ import annotations

import json
from datetime import datetime

from basketry.plans.ingest import Run, ingest_table, merge_into, run_ingest, transform
from basketry.sources import readers, writers
from basketry.streaming.landing import ingest_landing
from tests.conftest import rows

RUN = Run("batch-7", datetime(2024, 3, 1))
ORDERS = "order_id string, order_date string, status string"


def orders(spark, *records):
    return spark.createDataFrame(list(records), ORDERS)


def test_transform(spark):
    df = spark.createDataFrame(
        [("1", (("x",),), float("nan"), "2024-01-02T03:04:05")],
        "ORDER_ID string, info struct<a:struct<b:string>>, amount double, order_date string",
    )
    got = transform(df, "orders", "latest", RUN)
    assert got.columns == [
        "ORDER_ID", "INFO_A_B", "AMOUNT", "ORDER_DATE", "DATA_SOURCE", "BATCH_ID", "LOADED_AT",
    ]
    assert rows(got) == [
        ("1", "x", None, "2024-01-02 03:04:05", "latest", "batch-7", "2024-03-01 00:00:00")
    ]


def test_transform_adds_a_missing_key(spark):
    df = spark.createDataFrame([("a",), ("b",)], "status string")
    got = transform(df, "orders", "latest", RUN)
    assert sorted(r.ORDER_ID for r in got.collect()) == [1, 2]


def test_ingest_one_table(spark):
    historic = orders(
        spark,
        ("1", "2024-01-01", "Delivered"),
        ("2", "2024-01-05", "Shipped"),  # inside the overlap: the latest extract has it
        ("3", "bad", "Shipped"),
    )
    latest = orders(spark, ("2", "2024-01-05", "Delivered"), ("2", "2024-01-06", "Delivered"), ("4", "2024-01-07", "Pending"))
    result = ingest_table("orders", historic, latest, RUN)
    got = {(r.ORDER_ID, r.ORDER_DATE[:10], r.DATA_SOURCE) for r in result.rows.collect()}
    assert got == {("1", "2024-01-01", "historic"), ("2", "2024-01-06", "latest"), ("4", "2024-01-07", "latest")}
    report = result.report.first()
    assert (report.historic_records, report.latest_records, report.total_records) == (1, 3, 3)
    assert (report.duplicates_removed, report.min_latest_date) == (1, "2024-01-05 00:00:00")
    assert json.loads(report["columns"])[0] == "ORDER_ID"


def test_reference_tables_keep_no_history(spark):
    old = spark.createDataFrame([("1", "old")], "category_id string, category_name string")
    new = spark.createDataFrame([("2", "new")], "category_id string, category_name string")
    result = ingest_table("categories", old, new, RUN)
    assert [r.CATEGORY_NAME for r in result.rows.collect()] == ["new"]


def test_job_merges_and_isolates_failures(spark, tmp_path):
    def broken():
        raise RuntimeError("no such bucket")

    first = orders(spark, ("1", "2024-01-01", "Pending"), ("2", "2024-01-02", "Pending"))
    outcome = run_ingest(
        spark,
        {"orders": (None, lambda: first), "reviews": (None, broken)},
        str(tmp_path),
        Run("b1", datetime(2024, 1, 3)),
        prefix="t_raw_",
    )
    assert outcome["orders"] == "ok"
    assert outcome["reviews"].startswith("failed: RuntimeError")
    metadata = spark.read.json(f"{tmp_path}/b1/orders_metadata").first()
    assert (metadata.table_name, metadata.total_records) == ("orders", 2)

    # the next run reads the saved extract as history
    second = orders(spark, ("2", "2024-01-02", "Delivered"), ("3", "2024-01-03", "Pending"))
    saved = lambda: readers.read_csv_extract(spark, f"{tmp_path}/b1/orders_csv", "orders")
    outcome = run_ingest(
        spark,
        {"orders": (saved, lambda: second)},
        str(tmp_path),
        Run("b2", datetime(2024, 1, 4)),
        prefix="t_raw_",
    )
    assert outcome == {"orders": "ok"}
    got = {(r.ORDER_ID, r.STATUS, r.BATCH_ID) for r in spark.table("t_raw_orders").collect()}
    assert got == {("1", "Pending", "b1"), ("2", "Delivered", "b2"), ("3", "Pending", "b2")}


def test_merge_is_idempotent_and_takes_new_columns(spark):
    batch = transform(orders(spark, ("1", "2024-01-01", "Pending")), "orders", "latest", RUN)
    merge_into("t_idem", batch, "orders")
    merge_into("t_idem", batch, "orders")
    before = rows(spark.table("t_idem"))
    assert len(before) == 1
    wider = orders(spark, ("1", "2024-01-01", "Pending")).selectExpr("*", "'gift' AS note")
    merge_into("t_idem", transform(wider, "orders", "latest", RUN), "orders")
    assert spark.table("t_idem").first().NOTE == "gift"


def test_publishing_keeps_snapshots_until_they_expire(spark):
    for n in range(3):
        writers.publish(spark.range(n + 1), "t_pub")
    assert spark.table("t_pub").count() == 3
    assert writers.expire(spark, "t_pub", datetime(2000, 1, 1)) == []
    assert writers.expire(spark, "t_pub", datetime(2100, 1, 1)) == ["t_pub__v000001", "t_pub__v000002"]
    assert spark.table("t_pub").count() == 3


def test_publishing_twice_under_a_qualified_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    writers.publish(spark.range(1), "lake.t")
    assert writers.publish(spark.range(2), "lake.t") == "lake.t__v000002"
    assert writers.published(spark, "lake.t").count() == 2


def test_append_creates_then_appends(spark):
    writers.append_table(spark.range(2), "t_append")
    writers.append_table(spark.range(3), "t_append")
    assert spark.table("t_append").count() == 5


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("2", 'Smith, "Pro"\nline two'), ("1", None)], "product_id string, product_name string"
    )
    writers.write_csv_extract(df, str(tmp_path / "p"), "product_id")
    got = readers.read_csv_extract(spark, str(tmp_path / "p"), "products")
    assert rows(got) == rows(df)


def test_parquet_extract_is_sorted(spark, tmp_path):
    writers.write_parquet_extract(spark.range(100).selectExpr("(id * 37) % 100 AS id"), str(tmp_path / "x"), "id")
    got = [r.id for r in spark.read.parquet(str(tmp_path / "x")).collect()]
    assert sorted(got) == list(range(100))


def test_json_envelope(spark, tmp_path):
    document = {
        "metadata": {"table": "orders", "recordCount": 2, "generatedAt": "2024-01-01", "version": "1.0"},
        "data": [{"order_id": "1", "status": "Pending"}, {"order_id": "2", "status": None}],
    }
    path = tmp_path / "orders.json"
    path.write_text(json.dumps(document, indent=1))
    got = readers.read_raw(spark, str(path), "orders", "envelope")
    assert rows(got.select("order_id", "status")) == [("1", "Pending"), ("2", None)]
    assert rows(readers.read_json_envelope(spark, str(path))) == [("1", "Pending"), ("2", None)]


def test_json_extract(spark, tmp_path):
    df = orders(spark, ("1", "2024-01-01", "Pending"), ("2", None, "Shipped"))
    writers.write_json_extract(df, str(tmp_path / "o"), "orders")
    assert rows(readers.read_raw(spark, str(tmp_path / "o"), "orders", "json").select(*df.columns)) == rows(df)
    header = spark.read.json(str(tmp_path / "o" / "metadata")).first()
    assert (header.table, header.recordCount, header.version) == ("orders", 2, "1.0")


def test_jdbc_options():
    options = readers.jdbc_options(
        "jdbc:postgresql://h/db", "order_items", "order_item_id", (1, 1000), 64, latest=True
    )
    assert options["dbtable"] == "latest_order_items"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "1000", "64")
    assert "partitionColumn" not in readers.jdbc_options("u", "t")
    assert writers.jdbc_write_options("u", "t")["batchsize"] == "10000"


def test_landing_stream(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    landing.mkdir()

    def drop(name, *records):
        lines = [json.dumps(dict(zip(("order_id", "order_date", "status"), r))) for r in records]
        (landing / name).write_text("\n".join(lines))

    def run():
        query = ingest_landing(spark, str(landing), "orders", checkpoint, "t_stream_", 1)
        query.awaitTermination(120)
        assert query.exception() is None

    drop("a.json", ("1", "2024-01-01", "Pending"), ("2", "2024-01-01", "Pending"))
    drop("b.json", ("2", "2024-01-01", "Shipped"))
    run()
    drop("c.json", ("3", "2024-01-02", "Pending"))
    run()
    run()  # nothing new
    got = {r.ORDER_ID: r.STATUS for r in spark.table("t_stream_orders").collect()}
    assert set(got) == {"1", "2", "3"} and got["3"] == "Pending"
