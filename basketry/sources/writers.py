"""Sinks: extracts, load reports, appended and republished tables."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.cutover import order_for_write

# Keeps each text file readable by one task.
ROWS_PER_FILE = 2_000_000


def write_csv_extract(
    df: DataFrame, path: str, key: str | None = None, date_column: str | None = None
) -> None:
    """Replace a CSV extract; with a key its files come sorted by key and date."""
    ordered = order_for_write(df, key, date_column) if key and key in df.columns else df
    (
        ordered.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(path)
    )


def write_parquet_extract(
    df: DataFrame, path: str, key: str | None = None, date_column: str | None = None
) -> None:
    """The same extract as Parquet: typed, splittable, with key ranges per file."""
    ordered = order_for_write(df, key, date_column) if key and key in df.columns else df
    ordered.write.mode("overwrite").parquet(path)


def write_metadata(report: DataFrame, path: str) -> None:
    """A load report next to its extract; the report is a single row."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_json_extract(df: DataFrame, path: str, table: str) -> None:
    """JSON objects, one per line, under ``data`` and the envelope's header under
    ``metadata``. The count is taken from what was written, not from a second run."""
    root = path.rstrip("/")
    df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).json(f"{root}/data")
    header = (
        df.sparkSession.read.text(f"{root}/data")
        .agg(F.count(F.lit(1)).alias("recordCount"))
        .select(
            F.lit(table).alias("table"),
            "recordCount",
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generatedAt"),
            F.lit("1.0").alias("version"),
        )
    )
    header.coalesce(1).write.mode("overwrite").json(f"{root}/metadata")


def jdbc_write_options(
    url: str, table: str, batch_size: int = 10_000, partitions: int = 16
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(partitions),
        "truncate": "false",
    }


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Replace a relational table; ``numPartitions`` bounds the open connections."""
    df.write.format("jdbc").mode("overwrite").options(
        **jdbc_write_options(url, table, **options)
    ).save()


def append_table(df: DataFrame, name: str) -> None:
    """Initial warehouse load: create the table if it is absent, append otherwise."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def _snapshots(spark: SparkSession, name: str) -> list[str]:
    """Snapshot tables of a published table, oldest first, qualified like ``name``."""
    database, _, table = name.rpartition(".")
    pattern = re.compile(rf"{re.escape(table.lower())}__v\d{{6}}")
    listed = spark.catalog.listTables(database or None, pattern=f"{table}__v*")
    found = sorted(t.name for t in listed if pattern.fullmatch(t.name.lower()))
    return [f"{database}.{t}" if database else t for t in found]


def publish(df: DataFrame, name: str) -> str:
    """Write a new snapshot of ``name`` as its own table and point the view at it.

    The old snapshot stays readable while the new one is built from it, and readers
    move over in one catalog change. Snapshots are kept until ``expire`` is called. One
    writer at a time: two that number the same snapshot end in an error for the second.
    """
    spark = df.sparkSession
    older = _snapshots(spark, name)
    number = int(older[-1][-6:]) + 1 if older else 1
    snapshot = f"{name}__v{number:06d}"
    df.write.mode("errorifexists").format("parquet").saveAsTable(snapshot)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {snapshot}")
    return snapshot


def expire(spark: SparkSession, name: str, older_than: datetime) -> list[str]:
    """Drop snapshots created before ``older_than``, never the newest; the caller knows its readers."""
    dropped = []
    for snapshot in _snapshots(spark, name)[:-1]:
        facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {snapshot}").collect()}
        created = datetime.strptime(" ".join(facts["Created Time"].split()), "%a %b %d %H:%M:%S %Z %Y")
        if created < older_than:
            spark.sql(f"DROP TABLE {snapshot}")
            dropped.append(snapshot)
    return dropped


def published(spark: SparkSession, name: str) -> DataFrame | None:
    """Current snapshot of a published table, if there is one."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
