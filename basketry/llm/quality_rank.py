"""Quality classifier (7): Bradley-Terry ranking of documents by pairwise preferences.

Each document has a vector of features of its whole text. A document labelled good is preferred
to one labelled bad; the weights minimise the logistic loss of the feature differences over such
pairs. The margins of all labelled documents that may be learnt from are cut at the quantile that
equals the share of bad ones among them, and that cut becomes score ``CUT``.

Weights and bins come from at most ``TRAIN_PER_CLASS`` labelled documents of each class; every
bad one meets ``PARTNERS`` good ones. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.host_rules import measure
from basketry.llm.texts import Texts, mix, prepare, slices
from basketry.llm.toxicity import clean_labels, training_rows

TRAIN_PER_CLASS = 6000
PARTNERS = 12
BINS = 12
ITERATIONS = 300
CUT = 0.3
#: Margins are counted in steps of one over this.
STEPS = 256

_CLASSES = {
    "upper": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)],
    "symbol": [*b"#*$%&<>@^~_=+\\/{}[]"],
    "bar": [*b"|"],
    "shout": [*b"!"],
    "stop": [*b".,;:?"],
    "space": [0x20, *range(0x09, 0x0E)],
    "beyond": [*range(0x80, 0x100)],
}
FEATURES = [
    "log_words",
    "word_length",
    "long_words",
    "repeat_share",
    "dup_lines",
    "top_word",
    "distinct_share",
    "bigram_repeat",
    "same_as_before",
    "ends_odd",
    "line_words",
    *_CLASSES,
]


def _ends_with(words, table: np.ndarray) -> np.ndarray:
    return table[words.texts.data[words.ends - 1]]


def features(texts: Texts) -> np.ndarray:
    """One row per text; shares are of words, lines or bytes."""
    raw = texts.data[: texts.size]
    words = texts.words()
    counts, word_chars, _, dup_lines, repeats = measure(texts)
    n = np.maximum(counts, 1)
    size = np.maximum(np.diff(texts.offsets), 1)
    lines = texts.per_text(raw == 0x0A) + 1
    owner = words.owner()

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, len(texts)) / n

    h = words.hashes()
    lowered = texts.lowered().words().hashes()
    key = mix(owner.astype(np.uint64), lowered)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    begin = np.flatnonzero(fresh)
    often = np.diff(np.append(begin, len(key)))
    top = np.zeros(len(texts))
    np.maximum.at(top, owner[order[begin]], often)
    distinct = np.bincount(owner[order[begin]], minlength=len(texts))
    same = np.zeros(len(h))
    pair_repeat = np.zeros(len(h))
    if len(h) > 1:
        together = owner[1:] == owner[:-1]
        same[1:] = (lowered[1:] == lowered[:-1]) & together
        pairs = mix(key[1:], lowered[:-1])
        by = np.argsort(pairs, kind="stable")
        pair_repeat[by[1:]] = (pairs[by[1:]] == pairs[by[:-1]]) & together[by[1:]]
    odd = np.zeros(256, dtype=bool)
    odd[[*b"#*$%&!|@~^"]] = True
    columns = [
        np.log1p(counts),
        word_chars / n,
        of_words(words.ends - words.starts > 16),
        repeats / n,
        dup_lines / lines,
        top / n,
        distinct / n,
        of_words(pair_repeat),
        of_words(same),
        of_words(_ends_with(words, odd)),
        np.log1p(counts / lines),
    ]
    for members in _CLASSES.values():
        table = np.zeros(256, dtype=bool)
        table[members] = True
        columns.append(texts.per_text(table[raw]) / size)
    return np.stack(columns, axis=1)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(texts) for _, _, texts in slices(batch.column(1))]
        if found:
            rows = np.concatenate(found)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(
                pa.list_(pa.float64())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["label", "x"])


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Position of each value among its feature's bins, counted on from the feature before."""
    out = np.empty(x.shape, dtype=np.int64)
    first = 0
    for k, cut in enumerate(edges):
        out[:, k] = first + np.searchsorted(cut, x[:, k], side="right")
        first += len(cut) + 1
    return out


def fit(x: np.ndarray, label: np.ndarray, seed: int = 11) -> tuple[list[np.ndarray], np.ndarray]:
    """Bin edges and a weight for each bin.

    Features are cut into bins at quantiles of either class, so that a weight per bin can follow
    any shape. Without documents of both classes all weights are zero.
    """
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    edges = []
    for k in range(x.shape[1]):
        cuts = [np.quantile(x[c, k], np.linspace(0, 1, BINS + 1)[1:-1]) for c in (good, bad) if len(c)]
        edges.append(np.unique(np.concatenate(cuts)) if cuts else np.zeros(0))
    width = sum(len(c) + 1 for c in edges)
    weights = np.zeros(width)
    if not len(good) or not len(bad):
        return edges, weights
    rng = np.random.default_rng(seed)
    a = rng.choice(good, size=(len(bad), PARTNERS)).ravel()
    b = np.repeat(bad, PARTNERS)
    bins = _binned(x, edges)
    m, v = np.zeros(width), np.zeros(width)
    for step in range(1, ITERATIONS + 1):
        margin = weights[bins].sum(axis=1)
        # d/dw of log(1 + exp(-(s_a - s_b))), gathered by document, then by bin
        pull = 1 / (1 + np.exp(np.clip(margin[a] - margin[b], -50, 50)))
        by_doc = np.bincount(b, pull, len(x)) - np.bincount(a, pull, len(x))
        grad = np.bincount(bins.ravel(), np.repeat(by_doc, x.shape[1]), width) / len(a) + 2e-4 * weights
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        weights -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return edges, weights


def _margin_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges, weights = shared.value
            found = [weights[_binned(features(texts), edges)].sum(axis=1) for _, _, texts in slices(batch.column(1))]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], ["row", "margin"])

    return run


def quantile_cut(margins: DataFrame) -> float:
    """The cut that as many of the (margin, label) rows are below as are bad, between two steps of
    ``1 / STEPS`` that hold any.

    Steps are few (margins are sums of bounded weights), so their totals are read by the driver.
    """
    steps = margins.groupBy(F.floor(F.col("margin") * STEPS).alias("step"))
    rows = steps.agg(F.count("*").alias("docs"), F.sum(1 - F.col("label")).alias("bad")).orderBy("step").collect()
    bad = sum(r["bad"] for r in rows)
    if not bad:
        return rows[0]["step"] / STEPS if rows else 0.0
    k = int(np.searchsorted(np.cumsum([r["docs"] for r in rows]), bad))
    above = rows[k + 1]["step"] if k + 1 < len(rows) else rows[k]["step"] + 1
    return (rows[k]["step"] + 1 + above) / 2 / STEPS


def score_quality(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    per_class: int = TRAIN_PER_CLASS,
) -> DataFrame:
    """``row`` (a struct of the id) and ``score`` of every row; ``CUT`` and above is good.

    Only text is an input of the score. Null and empty texts have the features of no words.
    Labels of held-out, missing or null ids are not learnt from; a label other than 0 and 1 is
    none, and an id with both has none. Repeated rows are scored each, learnt from once, and count each for
    the cut; equal margins are on one side of it. Very long texts are read whole, one at a time. Without
    labels of both classes every score is the same. Other columns of ``docs`` are not read.
    """
    prepare(spark)
    rows, _ = training_rows(docs, labels, label, doc_id, text, per_class)
    sample = rows.mapInArrow(_feature_batches, "label int, x array<double>")
    taken = sorted((r["label"], tuple(r["x"])) for r in sample.collect())
    x = np.array([r[1] for r in taken]).reshape(len(taken), len(FEATURES))
    model = fit(x, np.array([r[0] for r in taken], dtype=np.int64))
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(F.struct(F.col(doc_id).alias("doc_id")).alias("row"), F.col(text).alias("text"))
    kind = f"row {source.schema['row'].dataType.simpleString()}, margin double"
    # Numbers only: the cut needs the margins of all labelled rows before any row has its score.
    margins = source.mapInArrow(_margin_batches(shared), kind).checkpoint(eager=True)
    known = clean_labels(labels, label, doc_id)
    judged = margins.join(known, F.col("row.doc_id") == F.col("_id")).select("margin", F.col("_label").alias("label"))
    shift = F.lit(quantile_cut(judged) - float(np.log(CUT / (1 - CUT))))
    odds = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("margin") - shift))
    return margins.select("row", (1 / (1 + F.exp(-odds))).alias("score"))
