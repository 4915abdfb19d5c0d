"""Load reports as DataFrames."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def load_audit(
    combined: DataFrame,
    latest: DataFrame,
    table: str,
    key: str,
    date_column: str | None,
    batch_id: str,
    loaded_at: datetime,
) -> DataFrame:
    """One audit row for a load: counts per side, duplicates removed, cut-over, columns.

    ``combined`` is the union before dedup, with ``data_source`` on each row. Rows left
    after dedup are its distinct keys (NULL counting as one), so one pass is enough.
    """
    source = next(c for c in combined.columns if c.lower() == "data_source")
    present = {c.lower(): c for c in combined.columns}
    counts = [
        F.count(F.when(F.col(source) == "historic", 1)).alias("historic_records"),
        F.count(F.when(F.col(source) == "latest", 1)).alias("latest_records"),
        F.count(F.lit(1)).alias("_rows"),
    ]
    if key.lower() in present:
        column = F.col(present[key.lower()])
        counts.append(
            (F.countDistinct(column) + F.max(F.when(column.isNull(), 1).otherwise(0))).alias(
                "total_records"
            )
        )
    else:
        counts.append(F.count(F.lit(1)).alias("total_records"))
    audit = combined.agg(*counts).select(
        "historic_records",
        "latest_records",
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        (F.col("_rows") - F.coalesce("total_records", F.lit(0))).alias("duplicates_removed"),
    )
    dated = {c.lower(): c for c in latest.columns}
    if date_column and date_column.lower() in dated:
        first = latest.agg(F.min(dated[date_column.lower()])).scalar().cast("string")
    else:
        first = F.lit(None).cast("string")
    return audit.select(
        F.lit(table).alias("table_name"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
        "historic_records",
        "latest_records",
        "total_records",
        "duplicates_removed",
        F.lit(date_column).cast("string").alias("date_column_used"),
        first.alias("min_latest_date"),
        F.lit(key).alias("primary_keys_used"),
        F.lit(json.dumps(combined.columns)).alias("columns"),
        F.lit(json.dumps({f.name: f.dataType.simpleString() for f in combined.schema})).alias(
            "data_types"
        ),
    )


def date_summary(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Rows and date range of each table, one row per table."""
    rows = []
    for name, (df, column) in tables.items():
        when = F.col(column) if column and column in df.columns else F.lit(None)
        rows.append(
            df.agg(
                F.count(F.lit(1)).alias("records"),
                F.min(when.cast("timestamp_ntz")).alias("first_date"),
                F.max(when.cast("timestamp_ntz")).alias("last_date"),
            ).select(F.lit(name).alias("table_name"), "records", "first_date", "last_date")
        )
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result


