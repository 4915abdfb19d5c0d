"""Incremental ingest of a landing folder with Structured Streaming.

The daily batch as a file stream: each trigger takes the files that arrived since the
last one and merges them into the published table. The stream's checkpoint remembers
which files are done, and the merge is idempotent, so a batch replayed after a failure
leaves the table as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketry.operators.dedup import drop_duplicate_keys
from basketry.plans.ingest import Run, merge_into, merge_into_files, transform
from basketry.schemas import TABLES


def ingest_landing(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    prefix: str = "raw_",
    files_per_batch: int = 1000,
    tables: str | None = None,
) -> StreamingQuery:
    """Merge all waiting JSON-lines files of ``table``, then stop.

    With ``tables``, a shared folder, the table is kept there as versions of files, and a trigger
    rewrites only the files that hold changed rows.
    """
    spec = TABLES[table]

    def merge(batch: DataFrame, epoch: int) -> None:
        rows = transform(batch, table, "latest", Run(f"stream-{epoch}"))
        newest = drop_duplicate_keys(rows, spec.primary_key, spec.date_column)
        if tables:
            merge_into_files(spark, f"{tables.rstrip('/')}/{prefix}{table}", newest, table)
        else:
            merge_into(f"{prefix}{table}", newest, table)

    return (
        spark.readStream.schema(spec.struct())
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
