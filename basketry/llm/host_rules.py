"""Quality rules (3): rule failures per host, shrunk by a beta prior, judge its documents.

A document's own rules come from its words: too few, or too many that repeat. Failures of these
and of three more rules (symbols, duplicate lines, mean word length) are then counted per host (the
``source`` of a document). Each rule's failure rates get a beta prior fitted by moments over all
hosts, and the host's posterior means decide for its documents that passed on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import NOT_SPACE, Texts, mix, prepare, slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_SYMBOL_PERCENT = 10  # of the words
MAX_DUP_LINE_PERCENT = 30  # of the lines that are not blank
MEAN_WORD = (3, 10)  # characters, in texts that are mostly ASCII: other scripts may have no blanks between words
#: A host with a rule's shrunk failure rate above this loses all its documents: most of what it
#: holds fails.
MAX_HOST_RATE = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_ascii long"


def _lines(text: bytes) -> tuple[int, int]:
    """Lines that are not blank, and how many of them an earlier one equals."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: Texts) -> list[np.ndarray]:
    """The five measures of each text that its rules and features are made of."""
    return _measures(texts)[:5]


def _measures(texts: Texts) -> list[np.ndarray]:
    """All measures of each text, in the order of the output columns."""
    words = texts.words()
    raw = texts.data[: texts.size]
    counts = words.counts()
    inside = NOT_SPACE[raw] & ((raw & 0xC0) != 0x80)  # first bytes of code points in words
    h = words.hashes()
    repeated = np.zeros(len(words), dtype=bool)
    if len(words) >= WINDOW:
        owner = words.owner()
        n = len(words) - WINDOW + 1
        window = owner[:n].astype(np.uint64)
        for k in range(WINDOW):
            window = mix(window, h[k : k + n])
        whole = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
        keys = window[whole]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        again = np.zeros(len(whole), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for k in range(WINDOW):
            repeated[whole[again] + k] = True
    upto = np.concatenate([[0], np.cumsum(repeated)])
    lines = np.array([_lines(texts.text(i)) for i in range(len(texts))], dtype=np.int64).reshape(-1, 2)
    return [
        counts,
        texts.per_text(inside),
        texts.per_text(_SYMBOL[raw]),
        lines[:, 1],
        upto[words.at[1:]] - upto[words.at[:-1]],
        lines[:, 0],
        texts.per_text((raw > 0x20) & (raw < 0x7F)),
    ]


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _MEASURES.split(", ")]
    for batch in batches:
        parts = [_measures(texts) for _, _, texts in slices(batch.column(2))]
        columns = [np.concatenate(found).astype(np.int64) for found in zip(*parts, strict=True)]
        if columns:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns)], ["doc_id", "host", *names]
            )


def document_rules(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Measures and ``base_failed`` of every document; a null text has no words."""
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text")
    )
    measured = source.mapInArrow(_measure_batches, f"doc_id {kind}, host string, {_MEASURES}")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed)


def host_rules() -> dict[str, Column]:
    """The rules whose failures count for a host, by the column of its shrunk failure rate."""
    shortest, longest = (F.col("n_words") * chars for chars in MEAN_WORD)
    return {
        "host_rate": F.col("base_failed"),
        "host_symbol_rate": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
        "host_dup_line_rate": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        "host_word_length_rate": (2 * F.col("n_ascii") > F.col("word_chars"))
        & ((F.col("word_chars") < shortest) | (F.col("word_chars") > longest)),
    }


def fit_priors(hosts: DataFrame, failed: list[str]) -> list[tuple[float, float]]:
    """Mean and weight (a + b) of each rule's beta prior, from one row of moments over all hosts.

    Between-host variance v is the variance of the rates less what sampling adds; the weight is
    m(1 - m) / v - 1, one document at least. Hosts alike (v = 0) get the mean host's weight.
    """
    moments = [
        moment
        for k, name in enumerate(failed)
        for moment in (F.sum(name).alias(f"failed{k}"), F.var_pop(F.col(name) / F.col("n_docs")).alias(f"spread{k}"))
    ]
    row = hosts.agg(
        F.sum("n_docs").alias("docs"),
        F.avg(1 / F.col("n_docs")).alias("inverse"),
        F.avg("n_docs").alias("mean_docs"),
        *moments,
    ).first()
    if not row["docs"]:
        return [(0.0, 1.0)] * len(failed)
    priors = []
    for k in range(len(failed)):
        mean = row[f"failed{k}"] / row["docs"]
        noise = mean * (1 - mean) * row["inverse"]
        between = row[f"spread{k}"] - noise
        weight = float(row["mean_docs"]) if between <= 0 else max(mean * (1 - mean) / between - 1, 1.0)
        priors.append((mean, weight))
    return priors


def fit_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and weight of the prior of ``n_failed`` alone."""
    return fit_priors(hosts, ["n_failed"])[0]


def host_rates(judged: DataFrame) -> DataFrame:
    """One row per host (null is one): documents, and each rule's failures and shrunk failure rate.

    The rate is the posterior mean (prior mean x weight + failures) / (weight + documents).
    """
    rules = host_rules()
    counts = {rate: f"{rate}_failed" for rate in rules}
    failed = [F.sum(rule.cast("long")).alias(counts[rate]) for rate, rule in rules.items()]
    hosts = judged.groupBy("host").agg(F.count("*").alias("n_docs"), *failed)
    priors = fit_priors(hosts, list(counts.values()))
    for (rate, count), (mean, weight) in zip(counts.items(), priors, strict=True):
        hosts = hosts.withColumn(rate, (F.lit(mean * weight) + F.col(count)) / (F.lit(weight) + F.col("n_docs")))
    return hosts


def judge(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Adds the host's rates and ``kept``: passed itself, and no rate of its host is above ``max_rate``."""
    names = list(host_rules())
    rates = host_rates(judged).select(F.col("host").alias("_host"), *names)
    joined = judged.join(rates, judged["host"].eqNullSafe(rates["_host"])).drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.greatest(*names) <= max_rate))


def host_quality(spark: SparkSession, docs: DataFrame, **columns: str) -> DataFrame:
    """All documents with measures, own verdict, host rates and verdict.

    Empty and null texts have no words and fail. Repeated rows count as often as they occur. A rate equal
    to the limit keeps its host; nothing else is compared, so there are no ties. Very long texts are
    measured whole, one at a time. An empty table gives no rows. Other columns of ``docs`` are not read, whatever their names.
    """
    prepare(spark)
    rules = document_rules(docs, **columns)
    # The rules feed the host totals and the verdicts: keep the few numbers, not the texts.
    return judge(rules.checkpoint(eager=True))
