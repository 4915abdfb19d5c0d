"""Documents to a training mix: five stages, each an operator of ``basketry.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns they
had; the last one also repeats documents and numbers the copies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.decontaminate import drop_contaminated
from basketry.llm.mixing import mix_documents
from basketry.llm.queries import TOXIC_CUT
from basketry.llm.repeats import remove_repeats
from basketry.llm.simhash import keep_one
from basketry.llm.texts import prepare
from basketry.llm.toxicity import score_toxicity
from basketry.session import ensure_checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    scored = score_toxicity(spark, docs, _table(spark, sf_dir, "labels"), whole_rows=True)
    return scored.where(F.col("score") < TOXIC_CUT).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return keep_one(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; a document with no word left goes.

    ``n_chars`` follows the text. Documents without a word before the cut stay as they are.
    """
    others = [c for c in docs.columns if c != "text"]
    cut = remove_repeats(spark, docs, carry=[*others, "text"], as_text=True)
    emptied = (F.size("spans") > 0) & (F.trim(F.regexp_replace("kept", r"\s+", " ")) == "")
    changed = F.size("spans") > 0
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.when(changed, F.col("kept")).otherwise(columns["text"])
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(columns["n_chars"])
    return cut.where(~emptied).select(*[columns[c].alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(spark, docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, ``mix_copy`` counting from 1.

    Documents and their numbers of copies meet on a hash of id and text; rows alike in both are
    numbered in order of their source. A ``mix_copy`` that the documents bring along is replaced.
    """
    mixed = mix_documents(spark, docs)
    counts = mixed.select("id_hash", "text_hash", F.col("copy").alias("nth"), "copies").where("copies > 0")
    mine = docs.select(
        F.struct("*").alias("row"), F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash")
    )
    same = Window.partitionBy("id_hash", "text_hash").orderBy(F.col("row.source").cast("string"))
    placed = mine.withColumn("nth", F.row_number().over(same)).join(counts, ["id_hash", "text_hash", "nth"])
    each = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    columns = [F.col(f"row.`{c}`") for c in docs.columns if c != "mix_copy"]
    return placed.select(*columns, each.alias("mix_copy"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing),
]

#: The stages train a classifier and search by fingerprints: no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
