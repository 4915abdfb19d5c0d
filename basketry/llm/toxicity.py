"""Toxicity (10): subword bags, their embeddings averaged, a linear softmax on top.

A text is the bag of the 3- to 6-byte pieces of its lower-cased words (a blank on either side
marks the word's ends) and of the words themselves, hashed to ``BUCKETS`` rows of an embedding.
The mean of a text's embeddings goes through a linear softmax; embeddings and softmax are
trained together in numpy. A word never seen shares most pieces, and so most of its vectors,
with the words it resembles. As the layers are linear, scoring needs one number per bucket.

Which buckets are trained is decided by all labelled documents that may be learnt from. The model
is fitted on at most ``TRAIN_PER_CLASS`` of each class (those of least hash), weighted back to the
shares of the classes; what the driver holds is bounded by that. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import ALNUM, Texts, mix, prepare, slices

BUCKET_BITS = 17
TRAIN_PER_CLASS = 2500
PIECES = (3, 4, 5, 6)
DIMENSIONS = 8
MIN_CONTRAST = 4.0
EPOCHS = 30
BATCH = 250
RATE = 0.2
DECAY = 1e-6
_SHIFT = np.uint64(64 - BUCKET_BITS)
_WORD_SALT = np.uint64(0x5851F42D4C957F2D)


def subwords(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every piece and word; texts are lower-cased already."""
    words = texts.lowered().words(ALNUM)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = words.texts.data[: texts.size]
    padded = np.full(texts.size + 9, 0x20, np.uint8)
    padded[1 : texts.size + 1] = np.where(ALNUM[raw], raw, 0x20)
    lanes = np.ndarray((texts.size + 2,), "<u8", padded, strides=(1,))
    # In the padded text a word with its two blanks is starts : ends + 2.
    size = words.ends - words.starts + 1
    last = np.repeat(words.ends + 2, size)
    at = np.arange(len(last)) + np.repeat(words.starts - (np.cumsum(size) - size), size)
    owner = words.owner()
    text = np.repeat(owner, size)
    raw_piece = lanes[at]
    buckets = [(mix(words.hashes(), _WORD_SALT) >> _SHIFT).astype(np.int64)]
    owners = [owner]
    for n in PIECES:
        fits = at + n <= last
        piece = raw_piece[fits] & np.uint64((1 << (8 * n)) - 1)
        buckets.append((mix(piece, np.uint64(n)) >> _SHIFT).astype(np.int64))
        owners.append(text[fits])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Bags:
    """Texts as bags over chosen buckets: place and weight of each entry, where a text begins."""

    place: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    label: np.ndarray


def bags_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, share of its text's bag) entries, and where each text's begin."""
    bucket, text = subwords(texts)
    key, count = np.unique(text << BUCKET_BITS | bucket, return_counts=True)
    owner = key >> BUCKET_BITS
    total = np.bincount(owner, count, len(texts))
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    return key & ((1 << BUCKET_BITS) - 1), count / total[owner], ends


def _presence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class and bucket, in how many of a task's texts it is; the texts stand under bucket -1."""
    held = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    n = np.zeros(2, np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        n += np.bincount(labels, minlength=2)
        for first, stop, texts in slices(batch.column(1)):
            bucket, _, ends = bags_of(texts)
            of = np.repeat(labels[first:stop], np.diff(ends))
            for k in (0, 1):
                held[k] += np.bincount(bucket[of == k], minlength=1 << BUCKET_BITS)
    label, bucket = np.nonzero(held)
    columns = [np.append(label, (0, 1)), np.append(bucket, (-1, -1)), np.append(held[label, bucket], n)]
    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["label", "bucket", "n"])


def _bag_batches(used: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BUCKET_BITS, -1)
        place[used] = np.arange(len(used))
        for batch in batches:
            places, weights = [], []
            for _, _, texts in slices(batch.column(1)):
                bucket, share, ends = bags_of(texts)
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    mine = place[bucket[a:b]]
                    places.append(mine[mine >= 0].astype(np.int32).tobytes())
                    weights.append(share[a:b][mine >= 0].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.binary()), pa.array(weights, pa.binary())],
                ["label", "place", "weight"],
            )

    return run


def clean_labels(labels: DataFrame, label: str, doc_id: str) -> DataFrame:
    """(_id, _label) of the ids that may be learnt from, once each; an id with both labels has none."""
    rows = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    rows = rows.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    both = rows.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
    return both.where("_label = _most").drop("_most")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str) -> DataFrame:
    """(label, text) of all documents that may be learnt from; of rows with the same id the least text."""
    known = clean_labels(labels, label, doc_id)
    found = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    found = found.join(known, F.col("_doc") == F.col("_id")).groupBy("_doc", F.col("_label").alias("label"))
    return found.agg(F.min("text").alias("text")).select("label", "text")


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of at most ``per_class`` labelled documents of each class, and class sizes.

    Chosen by least hash of the id among the rows that are not held out. The ids chosen are
    broadcast: their number is bounded by the parameter. Of rows with the same id the least text
    is learnt from, so repeated rows do not add to the sample.
    """
    rows = clean_labels(labels, label, doc_id)
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")
    )
    once = found.groupBy("_id", F.col("_label").alias("label")).agg(F.min("text").alias("text"))
    return once.select("label", "text"), sizes


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def informative(rows: DataFrame) -> np.ndarray:
    """Buckets that the texts of one class hold clearly more often than those of the other.

    A z-score between the two shares over all the rows; the embedding of a bucket found about as
    often in either class stays zero. Counts are added up by Spark: two for each bucket come back.
    """
    counts = rows.mapInArrow(_presence_batches, "label long, bucket long, n long").groupBy("label", "bucket")
    label, bucket, total = (c.to_numpy() for c in counts.agg(F.sum("n").alias("n")).toArrow().columns)
    held = np.zeros((2, (1 << BUCKET_BITS) + 1))
    held[label, bucket] = total  # bucket -1 comes last
    held, n = held[:, :-1], held[:, -1]
    if not n.all():
        return np.zeros(0, np.int64)
    share = (held.sum(axis=0) + 1) / (n.sum() + 2)
    spread = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    return np.flatnonzero(np.abs(held[1] / n[1] - held[0] / n[0]) >= MIN_CONTRAST * spread)


def gather(rows: DataFrame, used: np.ndarray) -> Bags:
    found = rows.mapInArrow(_bag_batches(used), "label int, place binary, weight binary").collect()
    found = sorted((r["label"], bytes(r["place"]), bytes(r["weight"])) for r in found)
    lengths = [len(place) // 4 for _, place, _ in found]
    return Bags(
        np.frombuffer(b"".join(place for _, place, _ in found), np.int32),
        np.frombuffer(b"".join(weight for _, _, weight in found), np.float32),
        np.cumsum([0, *lengths])[:-1],
        np.array([label for label, _, _ in found], dtype=np.int64),
    )


def train(bags: Bags, used: np.ndarray, class_sizes: dict[int, int], seed: int = 7) -> tuple[np.ndarray, float]:
    """One number per bucket and a bias: the log odds of class 1 are their mean plus the bias.

    Without buckets that tell the classes apart the numbers are zero and the bias is the log
    odds of the classes.
    """
    total = np.array([class_sizes.get(0, 0), class_sizes.get(1, 0)], dtype=float)
    numbers = np.zeros(1 << BUCKET_BITS, np.float32)
    if not len(used):
        return numbers, float(np.log((total[1] + 0.5) / (total[0] + 0.5)))
    seen = np.bincount(bags.label, minlength=2)
    importance = (total / total.sum()) / (seen / seen.sum())
    rng = np.random.default_rng(seed)
    stop = np.append(bags.first[1:], len(bags.place))
    params = [
        rng.uniform(-1, 1, (len(used), DIMENSIONS)) / DIMENSIONS,
        rng.normal(0, 0.5, (DIMENSIONS, 2)),
        np.log(total / total.sum()),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags.label))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            lengths = stop[rows] - bags.first[rows]
            begin = np.cumsum(lengths) - lengths
            entry = np.arange(lengths.sum()) + np.repeat(bags.first[rows] - begin, lengths)
            ids, weight, row = bags.place[entry], bags.weight[entry], np.repeat(np.arange(len(rows)), lengths)
            embedding, out, bias = params
            vectors = embedding[ids]
            mean = np.stack([np.bincount(row, vectors[:, k] * weight, len(rows)) for k in range(DIMENSIONS)], axis=1)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), bags.label[rows]] -= 1
            wrong = p * (importance[bags.label[rows]] / len(rows))[:, None]
            back = (wrong @ out.T)[row] * weight[:, None]
            pull = np.stack([np.bincount(ids, back[:, k], len(used)) for k in range(DIMENSIONS)], axis=1)
            grads = [pull + DECAY * embedding, mean.T @ wrong + DECAY * out, wrong.sum(axis=0)]
            step += 1
            for param, grad, (m, v) in zip(params, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    embedding, out, bias = params
    numbers[used] = embedding @ (out[:, 1] - out[:, 0])
    return numbers, float(bias[1] - bias[0])


def score_texts(texts: Texts, numbers: np.ndarray, bias: float) -> np.ndarray:
    bucket, text = subwords(texts)
    total = np.bincount(text, numbers[bucket], len(texts))
    size = np.bincount(text, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(size, 1) + bias, -50, 50)))


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bias = shared.value
            found = [score_texts(t, numbers, bias) for _, _, t in slices(batch.column(batch.num_columns - 1))]
            if found:
                names = [*batch.schema.names[:-1], "score"]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found))], names)

    return run


def score_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    per_class: int = TRAIN_PER_CLASS,
    whole_rows: bool = False,
) -> DataFrame:
    """``row`` (the id, or with ``whole_rows`` all of the document) and ``score`` of every row.

    Only text is an input of the score. Null and empty texts score the bias alone. Labels of
    held-out, missing or null ids are not learnt from; a label other than 0 and 1 is none, and an id
    with both has none. Very long texts are read whole, one at a time. Repeated rows are scored each
    and learnt from once. Columns of ``docs`` stay inside ``row``: no name can clash.
    """
    prepare(spark)
    rows, sizes = training_rows(docs, labels, label, doc_id, text, per_class)
    rows = rows.withColumn("text", F.lower("text")).checkpoint(eager=True)  # the bounded sample
    used = informative(labelled_rows(docs, labels, label, doc_id, text).withColumn("text", F.lower("text")))
    shared = spark.sparkContext.broadcast(train(gather(rows, used), used, sizes))
    row = F.struct(*docs.columns) if whole_rows else F.struct(F.col(doc_id).alias("doc_id"))
    source = docs.select(row.alias("row"), F.lower(text).alias("text"))
    return source.mapInArrow(
        _score_batches(shared), f"row {source.schema['row'].dataType.simpleString()}, score double"
    )
