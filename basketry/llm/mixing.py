"""Mixing sources to target weights (5) by Pareto order sampling.

Each source gets a target in words: weights share out the words of all sources, a target stops
at ``MOST`` times its source, and what is over goes to the others by weight. A source whose
target is r times its size takes every document floor(r) times for certain. The rest is a sample
with inclusion probability p = r - floor(r): documents are ranked by the odds of a uniform
number over the odds of p, U / (1 - U) : p / (1 - p), and the first in that order are taken
until the words of the rest are reached. U comes from a hash of the document, so reruns agree.

No source is gathered or sorted whole: the order is cut into ``BINS`` bins, the words of the
bins are summed up, and only the one bin that the cut falls in is put in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.texts import prepare, slices

WEIGHTS = (5, 2, 1)
MOST = 3
BINS = 1 << 16
#: After the first cut, further rounds fill what is left with documents that still fit.
ROUNDS = 4


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [texts.words().counts() for _, _, texts in slices(batch.column(batch.num_columns - 1))]
        if found:
            sizes = pa.array(np.concatenate(found).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], [*batch.schema.names[:-1], "size"])


def document_sizes(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """(doc_id, source, id_hash, text_hash, size) of every row; a null text has no words."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.xxhash64(doc_id).alias("id_hash"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(
        _count_batches, f"doc_id {kind}, source string, id_hash long, text_hash long, size long"
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(k, source, source_size, target): sources in code point order, null last, k from 1.

    Filling up by weight with a ceiling has one water level: in order of ceiling over weight,
    sources stay under the level that the words left and the weights left give, until the first
    whose ceiling is above it; that level holds for all from there on. Windows run over one row
    per source.
    """
    one = Window.partitionBy(F.lit(0))
    by_name = one.orderBy(F.col("source").asc_nulls_last())
    found = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("k", F.row_number().over(by_name))
        .withColumn(
            "weight",
            F.element_at(F.array(*map(F.lit, weights)), ((F.col("k") - 1) % len(weights) + 1).cast("int")),
        )
        .withColumn("ceiling", most * F.col("source_size"))
    )
    by_ratio = one.orderBy(F.col("ceiling") / F.col("weight"), "k")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(one) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    weight_left = F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    found = found.withColumn("level", left / weight_left).withColumn(
        "open", F.col("ceiling") > F.col("level") * F.col("weight")
    )
    level = F.min(F.when(F.col("open"), F.struct(F.col("ceiling") / F.col("weight"), "k", "level"))).over(one)
    target = F.least(F.coalesce(level["level"] * F.col("weight"), F.col("ceiling")), F.col("ceiling"))
    return found.select("k", "source", "source_size", target.cast("double").alias("target"))


def uniform(*keys: Column | str, seed: int = 17) -> Column:
    """A number in (0, 1) that only the keys decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 12)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_rank(u: Column, p: Column) -> Column:
    """The odds of u over the odds of p, mapped to (0, 1) in the same order."""
    odds = u * (1 - p)
    return odds / (odds + p * (1 - u))


def _take_prefix(open_rows: DataFrame, need: DataFrame) -> DataFrame:
    """``open_rows`` with ``now``: in the order of rank, the longest start within ``need`` words.

    ``open_rows``: k, rank, size and the tie breakers; ``need``: k, words. Bins of the rank are
    summed first; a window orders only the bin in which a source's need runs out.
    """
    rows = open_rows.withColumn("bin", F.floor(F.col("rank") * BINS))
    bins = rows.groupBy("k", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("k").orderBy("bin"))
    edge = (
        bins.withColumn("upto", upto)
        .join(need.withColumnRenamed("words", "need"), "k")
        .where("upto > need")
        .groupBy("k")
        .agg(F.min(F.struct("bin", (F.col("need") - (F.col("upto") - F.col("words"))).alias("room"))).alias("edge"))
        .select("k", F.col("edge.bin").alias("edge_bin"), F.col("edge.room").alias("room"))
    )
    placed = rows.join(edge, "k", "left")
    sure = placed.where("edge_bin is null or bin <> edge_bin")
    sure = sure.withColumn("now", F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin")))
    order = Window.partitionBy("k").orderBy("rank", "id_hash", "text_hash", "copy")
    last = placed.where("bin = edge_bin").withColumn("now", F.sum("size").over(order) <= F.col("room"))
    return sure.unionByName(last).drop("bin", "edge_bin", "room")


def mix_documents(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """Every row with ``copies`` and its source's size and target.

    Columns: doc_id, source, id_hash, text_hash, copy (number among rows of the same id and
    text), size, source_size, target, copies, taken. Null and empty texts have size 0 and count
    no words whatever their copies; a null source is a source, last in order; ties of the rank
    are broken by hashes. An empty table gives no rows. Other columns are not read.
    """
    prepare(spark)
    same = Window.partitionBy("id_hash", "text_hash").orderBy("source")
    sizes = document_sizes(docs, doc_id, source, text).withColumn("copy", F.row_number().over(same))
    sizes = sizes.checkpoint(eager=True)  # numbers only; the texts are read once
    targets = source_targets(sizes, weights, most).checkpoint(eager=True)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
    named = plan.withColumnRenamed("source", "_source")
    rows = sizes.join(named, sizes["source"].eqNullSafe(named["_source"])).drop("_source")
    rows = rows.withColumn("rank", pareto_rank(uniform("id_hash", "text_hash", "copy"), F.col("p")))
    rows = rows.withColumn("extra", F.lit(0)).checkpoint(eager=True)
    need = plan.where("p > 0").select("k", (F.col("p") * F.col("source_size")).alias("words"))
    for _ in range(ROUNDS):
        got = rows.groupBy("k").agg(F.sum(F.col("extra") * F.col("size")).alias("got"))
        gap = need.join(got, "k").select("k", (F.col("words") - F.col("got")).alias("words")).where("words >= 1")
        waiting = rows.join(gap, "k", "left")
        fits = F.coalesce((F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("words")), F.lit(False))
        waiting = waiting.withColumn("fits", fits).drop("words")
        chosen = _take_prefix(waiting.where("fits"), gap)
        chosen = chosen.withColumn("extra", F.col("now").cast("int")).drop("now", "fits")
        rows = waiting.where("not fits").drop("fits").unionByName(chosen).checkpoint(eager=True)
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return rows.select(
        "doc_id",
        "source",
        "id_hash",
        "text_hash",
        "copy",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
