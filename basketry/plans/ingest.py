"""The ingest job: extracts in, merged raw tables and load reports out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import parse_timestamp
from basketry.operators.audit import load_audit
from basketry.operators.columns import (
    assert_unique_columns,
    flatten,
    lower_names,
    nan_to_null,
    normalise_dates,
    repair_duplicate_columns,
    stamp,
    upper_names,
)
from basketry.operators.cutover import combine, trim_historic
from basketry.operators.dedup import drop_duplicate_keys
from basketry.operators.ids import fill_missing_key, first_missing_ids, gap_summary, lost_ids
from basketry.operators.merge import upsert
from basketry.schemas import date_column, primary_key, table_spec
from basketry.sources import versions, writers


@dataclass(frozen=True)
class Run:
    """Identity of one ingest run, stamped on every row it loads."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    loaded_at: datetime = field(
        default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    )


@dataclass(frozen=True)
class Ingested:
    """Lazy outcome of one table: its new raw rows and the load report."""

    table: str
    rows: DataFrame
    report: DataFrame


def transform(df: DataFrame, table: str, data_source: str, run: Run) -> DataFrame:
    """Flat, stamped, date-normalised extract with upper-case names."""
    df = repair_duplicate_columns(lower_names(df))
    df = flatten(fill_missing_key(df, primary_key(table)))
    df = stamp(df, data_source, run.batch_id, run.loaded_at)
    df = nan_to_null(normalise_dates(df))
    return assert_unique_columns(upper_names(df))


def ingest_table(
    table: str, historic: DataFrame | None, latest: DataFrame, run: Run
) -> Ingested:
    """Cut over, transform, combine and deduplicate one table.

    Tables marked ``replace_only`` keep no history: the latest extract is the table.
    """
    key, day = primary_key(table), date_column(table)
    spec = table_spec(table)
    fresh = transform(latest, table, "latest", run)
    if historic is None or (spec and spec.replace_only):
        combined = fresh
    else:
        # a saved extract may carry upper-case names and the stamps of older runs
        historic, latest = lower_names(historic), lower_names(latest)
        if day and day in historic.columns and day in latest.columns:
            historic = historic.withColumn(day, parse_timestamp(F.col(day)))
            dated = latest.select(parse_timestamp(F.col(day)).alias(day))
            historic = trim_historic(historic, dated, day)
        combined = combine(transform(historic, table, "historic", run), fresh)
    rows = drop_duplicate_keys(combined, key, day)
    report = load_audit(combined, fresh, table, key, day, run.batch_id, run.loaded_at)
    return Ingested(table, rows, report)


def merge_into(name: str, batch: DataFrame, table: str) -> str:
    """Upsert a transformed batch into the published table and publish the result.

    Either side may have columns the other lacks; they are NULL there. Merging the same
    batch twice changes nothing.
    """
    target = writers.published(batch.sparkSession, name)
    if target is None:
        return writers.publish(batch, name)
    day = date_column(table)
    merged = upsert(
        combine(target, batch.limit(0)),
        combine(batch, target.limit(0)),
        primary_key(table).upper(),
        day.upper() if day else None,
    )
    return writers.publish(merged, name)


def merge_into_files(spark: SparkSession, root: str, batch: DataFrame, table: str) -> versions.Merged:
    """The same for a table of versions under ``root``: only files with changed rows are rewritten.

    The batch may lack columns of the table, which are NULL then; it must not bring new ones.
    """
    key, day = primary_key(table).upper(), date_column(table)
    if not versions.latest_version(spark, root):
        versions.create_table(drop_duplicate_keys(batch, key, day.upper() if day else None), root, key)
        return versions.Merged(1, 0, 0, 0, 0)
    held = versions.read_version(spark, root).limit(0)
    if extra := {c.lower() for c in batch.columns} - {c.lower() for c in held.columns}:
        raise ValueError(f"the table at {root} has no columns {sorted(extra)}")
    return versions.merge_version(combine(batch, held), root, key, day.upper() if day else None)


Loader = Callable[[], DataFrame]


def run_ingest(
    spark: SparkSession,
    sources: Mapping[str, tuple[Loader | None, Loader]],
    root: str,
    run: Run | None = None,
    prefix: str = "raw_",
    form: str = "csv",
    parallel: int = 4,
    tables: str | None = None,
) -> dict[str, str]:
    """Ingest every table: extract with report under ``root``, merged table ``raw_<name>``.

    With ``tables``, a shared folder, merged tables are kept there as versions of files instead of
    catalog snapshots, and a merge rewrites only the files that hold changed rows.

    Tables are independent jobs, a few at a time; one that fails is reported and does
    not stop the others. The merge reads the written extract back instead of building
    it again; the report scans the key, date and source columns of the inputs. Beside it stand
    the key range with its number of gaps, the first missing ids, and the lost ids.
    """
    run = run or Run()

    def one(table: str) -> str:
        load_historic, load_latest = sources[table]
        result = ingest_table(
            table, load_historic() if load_historic else None, load_latest(), run
        )
        key = primary_key(table).upper()
        day = date_column(table)
        # a folder per batch: the historic side may be reading the previous one
        folder = f"{root.rstrip('/')}/{run.batch_id}/{table}"
        writers.write_parquet_extract(result.rows, folder, key, day.upper() if day else None)
        if form == "csv":
            writers.write_csv_extract(spark.read.parquet(folder), f"{folder}_csv", key)
        writers.write_metadata(result.report, f"{folder}_metadata")
        saved = lower_names(spark.read.parquet(folder))
        writers.write_metadata(gap_summary(saved, primary_key(table)), f"{folder}_keys")
        writers.write_metadata(first_missing_ids(saved, primary_key(table)), f"{folder}_gaps")
        if load_historic:
            before = lower_names(load_historic())
            if primary_key(table) in before.columns:
                gone = lost_ids(before, saved, primary_key(table))
                gone.write.mode("overwrite").parquet(f"{folder}_lost")
        saved = spark.read.parquet(folder)
        if tables:
            merge_into_files(spark, f"{tables.rstrip('/')}/{prefix}{table}", saved, table)
        else:
            merge_into(f"{prefix}{table}", saved, table)
        return "ok"

    def guarded(table: str) -> str:
        try:
            return one(table)
        except Exception as error:  # isolation between tables
            return f"failed: {type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        outcomes = pool.map(guarded, sources)
        return dict(zip(sources, outcomes))
