"""Readers for the extract formats. Every reader returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import TABLES, table_spec


def read_json_envelope(
    spark: SparkSession, path: str, row_schema: T.StructType | None = None
) -> DataFrame:
    """Rows of ``{"metadata": {...}, "data": [...]}`` documents.

    One document is read by one task, so a large extract should come as many documents
    or in the line form ``write_json_extract`` produces. Give ``row_schema`` to skip the
    pass that infers it.
    """
    reader = spark.read.option("multiLine", True)
    if row_schema is not None:
        reader = reader.schema(T.StructType([T.StructField("data", T.ArrayType(row_schema))]))
    return reader.json(path).select(F.explode("data").alias("row")).select("row.*")


def read_json_extract(
    spark: SparkSession, path: str, row_schema: T.StructType | None = None
) -> DataFrame:
    """Rows of an extract in line form: ``<path>/data`` holds one JSON object per line."""
    reader = spark.read
    if row_schema is not None:
        reader = reader.schema(row_schema)
    return reader.json(f"{path.rstrip('/')}/data")


def read_csv_extract(
    spark: SparkSession, path: str, table: str | None = None, multi_line: bool = True
) -> DataFrame:
    """A CSV extract with header and quoted commas.

    Columns are found by name; those of a registered table are all read as text, which
    loses nothing before staging casts them. ``multi_line`` keeps quoted line breaks
    whole at the price of one task per file; switch it off where there are none.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("inferSchema", False)
    )
    df = reader.csv(path)
    spec = table_spec(table) if table else None
    if spec is None:
        return df
    known = set(spec.staged)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() in known])


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    latest: bool = False,
) -> dict[str, str]:
    """Options of a parallel JDBC read; the latest extract lives in ``latest_<table>``."""
    options = {
        "url": url,
        "dbtable": f"latest_{table}" if latest else table,
        "fetchsize": str(fetch_size),
    }
    if partition_column and bounds:
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(max(1, min(partitions, high - low + 1))),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A relational table, split over tasks by ranges of a numeric key."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_raw(spark: SparkSession, path: str, table: str, form: str) -> DataFrame:
    """A raw table by form: parquet, csv, json (lines), envelope."""
    if form == "parquet":
        return spark.read.parquet(path)
    if form == "csv":
        return read_csv_extract(spark, path, table)
    schema = TABLES[table].struct() if table in TABLES else None
    if form == "json":
        return read_json_extract(spark, path, schema)
    if form == "envelope":
        return read_json_envelope(spark, path, schema)
    raise ValueError(f"unknown form {form}")
