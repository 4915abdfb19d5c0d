"""Registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.align import align, score_links
from basketry.llm.bpe import decode_ids, encode_texts
from basketry.llm.decontaminate import digest, mark_contaminated
from basketry.llm.hard_negatives import mine_negatives
from basketry.llm.host_rules import host_quality, host_rules
from basketry.llm.html_text import extract_text
from basketry.llm.mixing import mix_documents
from basketry.llm.quality_rank import CUT, score_quality
from basketry.llm.repeats import remove_repeats
from basketry.llm.simhash import near_duplicates
from basketry.llm.sql import LLM_ORACLE
from basketry.llm.token_counts import count_tokens
from basketry.llm.toxicity import held_out, score_toxicity
from basketry.llm.url_filter import filter_urls, pages_of_sites

TOXIC_CUT = 0.5
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality(spark, _read(spark, sf_dir, "documents")).withColumnRenamed("host", "source")
    rates = {rate: F.round(rate, 6) for rate in host_rules()}
    return judged.withColumns(rates).drop("n_lines", "n_ascii")


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(mark_contaminated(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")))


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _read(spark, sf_dir, "documents"))


def _scored(found: DataFrame, cut: float) -> DataFrame:
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_read(spark, sf_dir, t) for t in ("documents", "labels"))
    return _scored(score_quality(spark, docs, labels), CUT)


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_read(spark, sf_dir, t) for t in ("documents", "labels"))
    return _scored(score_toxicity(spark, docs, labels), TOXIC_CUT)


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark, _read(spark, sf_dir, "documents")).select("row.doc_id", "n_tokens")


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark, _read(spark, sf_dir, "documents"))
    return found.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(spark, _read(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(spark, _read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return filter_urls(spark, pages, pages_of_sites(pages))


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    tokens = encode_texts(spark, _read(spark, sf_dir, "documents"), path, packed=True)
    return decode_ids(spark, tokens, path).select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in (BYTE_BPE, PIECE_BPE))
    aligned = align(spark, _read(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    scored = score_links(spark, aligned.withColumn("groups_sha256", digest).drop("groups"))
    return scored.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(spark, table.withColumn("label", label), F.col("vec_id") % 100 == 0)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_token_counts": _token_counts,
        "op2_repeats": _repeats,
        "op3_host_rules": _host_rules,
        "op4_html_text": _html_text,
        "op5_mixing": _mixing,
        "op6_decontaminate": _decontaminate,
        "op7_quality_rank": _quality,
        "op8_url_filter": _url_filter,
        "op9_simhash": _simhash,
        "op10_toxicity": _toxicity,
        "op11_bpe": _bpe,
        "op12_align": _align,
        "op13_negatives": _negatives,
    }


def llm_oracle() -> dict[str, str]:
    return dict(LLM_ORACLE)
