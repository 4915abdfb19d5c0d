"""Tables kept as versions of a list of files, merged by rewriting only the files a batch changes.

A table is a folder. Data files are written once, in key order, and never touched again. A version
is a small manifest: one row for each file with its rows, the least and greatest position of its
keys and its share of Bloom blocks. A merge finds the files that may hold a key of the batch by
position (an equi-join on bins of positions) and by Bloom filter, reads those only, and rewrites
the files in which a row really changes; new keys go to files of their own. Where nothing changes no
version is made, so a batch that is merged again writes nothing. Files of older versions stay, and
so do their readers.

Manifests are written by one task as the last step, into a folder that must not exist: a merge
that dies before leaves the table as it was, and of two writers the second fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.dedup import drop_duplicate_keys
from basketry.schemas import METADATA_COLUMNS

ROWS_PER_FILE = 1_000_000
#: A Bloom block is the 32,768 bits of one bitmap; sixteen bits a key, four of them set.
BLOCK_BITS = 32_768
KEYS_PER_BLOCK = 2_048
PROBES = 4
#: Bins of positions that a file may be listed under; wider files are listed under coarser bins.
MAX_BINS = 64

_MANIFEST = "file string, token string, n long, least long, greatest long, unkeyed long, blocks int"


@dataclass(frozen=True)
class Merged:
    """What a merge did: the version that now holds, and its counts of rows and files."""

    version: int
    updated: int
    inserted: int
    rewritten: int
    kept: int


def position(key: str, kind: T.DataType) -> Column:
    """A number that never falls as the key rises: the key itself, its day, its time, or its first bytes."""
    column = F.col(key)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    raise ValueError(f"no order of keys of type {kind.simpleString()}")


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), blocks).cast("int")


def _bits(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)) for i in range(PROBES)])


def _all_set(bitmap: str, bits: str) -> Column:
    """Whether every bit of the list is set in the bitmap (bit b is in byte b div 8)."""
    byte = lambda b: F.conv(
        F.hex(F.substring(F.col(bitmap), F.floor(b / 8).cast("int") + 1, F.lit(1))), 16, 10
    ).cast("int")
    return F.forall(bits, lambda b: F.getbit(byte(b), F.pmod(b, F.lit(8)).cast("int")) == 1)


def latest_version(spark: SparkSession, root: str) -> int:
    """The newest version, 0 for a table that is not there yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{root}/manifest")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    folders = [status.getPath() for status in system.listStatus(path)]
    done = [f.getName() for f in folders if system.exists(hadoop.Path(f, "_SUCCESS"))]
    return max((int(name.partition("=")[2]) for name in done if name.startswith("version=")), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Files of a version with their rows and key ranges."""
    number = latest_version(spark, root) if version is None else version
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/version={number}")


def _files(spark: SparkSession, root: str, names: list[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
    found = spark.read.schema(schema).parquet(*[f"{root}/files/{name}" for name in names])
    return found.withColumn("_file", F.substring_index("_metadata.file_path", "/", -2))


def _schema(spark: SparkSession, root: str, token: str) -> T.StructType:
    return spark.read.parquet(f"{root}/files/{token}").schema


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of a version, the newest by default."""
    listed = manifest(spark, root, version).select("file", "token").collect()
    if not listed:
        return spark.createDataFrame([], _schema(spark, root, "empty"))
    names = sorted(r["file"] for r in listed)
    return _files(spark, root, names, _schema(spark, root, listed[0]["token"])).drop("_file")


def _write_files(df: DataFrame, root: str, key: str, rows_per_file: int) -> str:
    """New data files in key order with their Bloom blocks; the token they stand under."""
    spark, token = df.sparkSession, uuid.uuid4().hex
    # the hash splits a hot run of NULL keys
    ordered = df.repartitionByRange(F.col(key), F.xxhash64(*df.columns)).sortWithinPartitions(key)
    ordered.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{root}/files/{token}")
    schema = df.schema
    held = _files(spark, root, [token], schema).select("_file", key, position(key, schema[key].dataType).alias("at"))
    sizes = held.groupBy(F.col("_file").alias("file")).agg(
        F.lit(token).alias("token"),
        F.count("*").alias("n"),
        F.min("at").alias("least"),
        F.max("at").alias("greatest"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("unkeyed"),
        F.ceil(F.count("*") / KEYS_PER_BLOCK).cast("int").alias("blocks"),
    )
    sizes.coalesce(1).write.parquet(f"{root}/sizes/{token}")
    blocks = spark.read.schema(_MANIFEST).parquet(f"{root}/sizes/{token}").select("file", "blocks")
    keyed = held.where(F.col(key).isNotNull()).join(blocks, F.col("_file") == F.col("file"))
    each = keyed.select("file", _block(key, F.col("blocks")).alias("block"), F.explode(_bits(key)).alias("bit"))
    bloom = each.groupBy("file", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bloom.write.parquet(f"{root}/bloom/{token}")
    return token


def _publish(spark: SparkSession, root: str, version: int, files: DataFrame) -> None:
    listed = files.select(*[c.split()[0] for c in _MANIFEST.split(", ")])
    listed.coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/version={version}")


def create_table(df: DataFrame, root: str, key: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """First version of a table; raises where there is one."""
    spark = df.sparkSession
    df.limit(0).coalesce(1).write.mode("errorifexists").parquet(f"{root}/files/empty")
    token = _write_files(df, root, key, rows_per_file)
    _publish(spark, root, 1, spark.read.schema(_MANIFEST).parquet(f"{root}/sizes/{token}"))
    return 1


def candidate_files(files: DataFrame, batch: DataFrame, root: str, key: str) -> DataFrame:
    """``file`` of those that may hold a key of the batch: in range, and all bits in the Bloom filter.

    Positions are cut into bins of which a file of usual width covers a few; one that covers more
    than ``MAX_BINS`` is listed under bins that many times wider, level by level, and a key looks
    under its bin of every level. The join is on (level, bin), never on all files.
    """
    spark = files.sparkSession
    bounds = files.agg(F.min("least"), F.max("greatest"), F.count("*")).first()
    if bounds[0] is None:
        return files.select("file").limit(0)
    low, high, n = bounds
    width, levels = max(1, (high - low) // n + 1), 1
    while (high - low) // (width * MAX_BINS ** (levels - 1)) >= MAX_BINS:
        levels += 1
    step = lambda level: F.lit(width) * F.pow(F.lit(MAX_BINS), level).cast("long")
    bin_of = lambda at, level: F.floor((F.col(at) - F.lit(low)) / step(level)).cast("long")
    span = F.greatest(F.lit(1.0), (F.col("greatest") - F.col("least") + 1) / F.lit(float(width)))
    level_of = F.least(F.floor(F.log(float(MAX_BINS), span) + F.lit(1e-9)).cast("int"), F.lit(levels - 1))
    ranged = files.where("least IS NOT NULL").withColumn("level", level_of)
    ranged = ranged.withColumn("bin", F.explode(F.sequence(bin_of("least", F.col("level")), bin_of("greatest", F.col("level")))))
    keys = batch.where(F.col(key).isNotNull()).select(key, position(key, batch.schema[key].dataType).alias("at"))
    keys = keys.distinct().where(F.col("at").between(low, high))
    keys = keys.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(levels)])))
    keys = keys.withColumn("bin", bin_of("at", F.col("level")))
    near = keys.join(ranged.select("file", "least", "greatest", "blocks", "level", "bin"), ["level", "bin"])
    near = near.where(F.col("at").between(F.col("least"), F.col("greatest")))
    asked = near.select("file", _block(key, F.col("blocks")).alias("block"), _bits(key).alias("asked"))
    tokens = [r[0] for r in files.select("token").distinct().collect()]
    bloom = spark.read.schema("file string, block int, bits binary").parquet(*[f"{root}/bloom/{t}" for t in tokens])
    passed = asked.join(bloom, ["file", "block"]).where(_all_set("bits", "asked"))
    return passed.select("file").distinct()


def merge_version(
    batch: DataFrame,
    root: str,
    key: str,
    date_column: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> Merged:
    """Merge a batch on ``key`` into the newest version; the meaning is that of ``merge.upsert``.

    A row changes only if a column other than the load's stamps differs, and then takes every
    column; unknown keys are inserted; nothing is deleted. A row without a key is inserted unless
    the table holds the same one, stamps aside. The batch has the table's columns. An empty batch,
    and one merged before, make no version.
    """
    spark = batch.sparkSession
    version = latest_version(spark, root)
    if not version:
        raise ValueError(f"no table at {root}")
    files = manifest(spark, root, version)
    schema = _schema(spark, root, "empty")
    metadata = {c.lower() for c in METADATA_COLUMNS}
    content = [c for c in schema.names if c.lower() not in metadata]
    work = f"{root}/incoming/{uuid.uuid4().hex}"
    drop_duplicate_keys(batch, key, date_column).select(
        *[F.col(c).cast(schema[c].dataType).alias(c) for c in schema.names]
    ).write.parquet(f"{work}/batch")
    newest = spark.read.schema(schema).parquet(f"{work}/batch")

    names = {r[0] for r in candidate_files(files, newest, root, key).collect()}
    if not newest.where(F.col(key).isNull()).isEmpty():
        names |= {r[0] for r in files.where("unkeyed > 0").select("file").collect()}
    held = _files(spark, root, sorted(names), schema)

    stamp = F.struct(*[F.col(c) for c in content])
    ours = held.select(F.col(key).alias("_k"), stamp.alias("_old"), "_file")
    theirs = newest.select(F.col(key).alias("_k"), stamp.alias("_new"), F.struct("*").alias("_row"))
    on_key = theirs.where("_k IS NOT NULL").join(ours.where("_k IS NOT NULL"), "_k", "left")
    on_key = on_key.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("_row", "_file")
    unkeyed = ours.where("_k IS NULL").select("_old").distinct()
    on_row = theirs.where("_k IS NULL").join(unkeyed, F.col("_new") == F.col("_old"), "left_anti")
    on_row = on_row.select("_row", F.lit(None).cast("string").alias("_file"))
    on_key.unionByName(on_row).write.parquet(f"{work}/changes")
    kinds = T.StructType([T.StructField("_row", schema), T.StructField("_file", T.StringType())])
    changes = spark.read.schema(kinds).parquet(f"{work}/changes")

    counts = changes.agg(F.count("_file"), F.count("*")).first()
    updated, inserted = counts[0], counts[1] - counts[0]
    kept = files.count()
    if not counts[1]:
        return Merged(version, 0, 0, 0, kept)
    hit = sorted(r[0] for r in changes.where("_file IS NOT NULL").select("_file").distinct().collect())
    old = _files(spark, root, hit, schema).drop("_file")
    new_keys = changes.where("_file IS NOT NULL").select(F.col(f"_row.`{key}`").alias(key))
    stays = old.join(new_keys, key, "left_anti")
    rows = stays.unionByName(changes.select("_row.*"))
    token = _write_files(rows, root, key, rows_per_file)
    made = spark.read.schema(_MANIFEST).parquet(f"{root}/sizes/{token}")
    gone = spark.createDataFrame([(name,) for name in hit], "file string")
    _publish(spark, root, version + 1, files.join(gone, "file", "left_anti").unionByName(made))
    return Merged(version + 1, updated, inserted, len(hit), kept - len(hit))
