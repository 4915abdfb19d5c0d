"""SimHash near-duplicates (9): 64-bit fingerprints linked through a Gray-ordered index.

Fingerprints count the bits of the XXH64 hashes of word shingles. Two fingerprints that differ
in at most d bits agree in two at least of d + 2 blocks, so the distinct fingerprints are dealt
out by every pair of blocks. Each such bucket gets an index over its fingerprints in Gray order:
neighbours in that order share most bits, a node holds the bits that all fingerprints below it
share (as a mask and a pattern) less those its parent holds already, and a search adds up the
differences on the way down and drops a whole node once they exceed d. What links inside a
bucket leaves as a star to the bucket's least linked fingerprint, so a dense bucket of n
fingerprints gives n links, not n squared. Components over all buckets give the classes.

A bucket of more than ``HOT_CODES`` fingerprints is dealt out again, twice over: the bits that
its two blocks leave open are cut into d + 1 parts, of which linked fingerprints share one, and
what that part leaves open into d + 1 again. With d = 2 at most 15 of the 64 bits then stay
open, so no bucket has more than 32,768 fingerprints, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.texts import Texts, prepare, slices

SHINGLE = 3
MAX_BITS = 2
SEED = 42
HOT_CODES = 1 << 14
_FANOUT = 16
_QUERIES = 512
_TOP = np.uint64(1 << 63)


def fingerprints(texts: Texts, width: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text; no word: zero."""
    texts = texts.lowered()
    hashes: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(len(texts)):
        words = texts.text(i).split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= width:
            hashes.append(digest(joined, SEED))
            sizes[i] = 1
            continue
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
        hashes.extend(
            [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)]
        )
        sizes[i] = len(starts)
    out = np.zeros(len(texts), dtype=np.uint64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    first = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > sizes[filled][:, None], axis=1)
    out[filled] = majority.copy().view(">u8").ravel().astype(np.uint64)
    return out


def _fingerprint_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints(texts, width) for _, _, texts in slices(batch.column(batch.num_columns - 1))]
            if found:
                bits = pa.array(np.concatenate(found).view(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], bits], [*batch.schema.names[:-1], "bits"])

    return run


def fingerprint_documents(docs: DataFrame, doc_id: str, text: str, width: int = SHINGLE) -> DataFrame:
    """(doc_id, version, bits): fingerprint as a signed long, version a hash of the whole text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    return source.mapInArrow(_fingerprint_batches(width), f"doc_id {kind}, version long, bits long")


def block_keys(max_bits: int) -> list[tuple[int, int]]:
    """Masks of the pairs of blocks, each with its number."""
    edges = [round(64 * i / (max_bits + 2)) for i in range(max_bits + 3)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [(n, a | b) for n, (a, b) in enumerate(combinations(masks, 2))]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """Masks of more bits that hold ``mask``: codes alike in ``mask`` that differ in at most
    ``max_bits`` bits are alike in one of them at least."""
    found = [mask]
    for _ in range(2):
        found = [wider for m in found for wider in _one_part_more(m, max_bits)]
    return found


def _one_part_more(mask: int, max_bits: int) -> list[int]:
    free = [1 << b for b in range(64) if not mask >> b & 1]
    edges = [round(len(free) * i / (max_bits + 1)) for i in range(max_bits + 2)]
    return [mask | sum(free[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Index of distinct codes. Level 0 holds the codes, each level above one node for 16 below."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        shared = [(np.full(len(codes), ~np.uint64(0)), self.codes)]
        while len(shared[-1][0]) > 1:
            mask, pattern = shared[-1]
            at = np.arange(0, len(mask), _FANOUT)
            ones = np.bitwise_and.reduceat(pattern | ~mask, at)
            zeros = np.bitwise_or.reduceat(pattern & mask, at)
            agree = np.bitwise_and.reduceat(mask, at) & ~(ones ^ zeros)
            shared.append((agree, ones & agree))
        # What the parent holds is taken out of the children: each bit is compared once on a path.
        self.levels = []
        for k, (mask, pattern) in enumerate(shared):
            if k + 1 < len(shared):
                mask = mask & ~shared[k + 1][0][np.arange(len(mask)) // _FANOUT]
            self.levels.append((mask, pattern & mask))

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, position among ``codes``) that differ in at most ``limit`` bits."""
        mask, pattern = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        spent = np.zeros(len(q), dtype=np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[depth]
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            alive = spent <= limit
            q, node, spent = q[alive], node[alive], spent[alive]
            if depth:
                below = len(self.levels[depth - 1][0])
                q = np.repeat(q, _FANOUT)
                spent = np.repeat(spent, _FANOUT)
                node = (node[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
                real = node < below
                q, node, spent = q[real], node[real], spent[real]
        return q, node


def _find(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins a[i] and b[i] in ``parent`` (smaller positions win), all at once."""
    while True:
        ra, rb = parent[a], parent[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if np.array_equal(low, high):
            return
        np.minimum.at(parent, high, low)
        while not np.array_equal(parent, parent[parent]):
            parent[:] = parent[parent]


def stars(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, least code linked to it) inside one bucket of distinct codes."""
    codes = np.sort(codes)
    if len(codes) == 2:
        near = np.bitwise_count(codes[0] ^ codes[1]) <= limit
        return codes[1:][[near]], codes[:1][[near]]
    index = GrayIndex(codes)
    place = np.searchsorted(codes, index.codes)
    parent = np.arange(len(codes))
    for first in range(0, len(codes), _QUERIES):
        q, found = index.within(codes[first : first + _QUERIES], limit)
        _find(parent, q + first, place[found])
    linked = np.flatnonzero(parent != np.arange(len(codes)))
    return codes[linked], codes[parent[linked]]


def _bucket_batches(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            greater, lesser = [], []
            for codes in batch.column(0):
                values = np.unique(np.asarray(codes.values, dtype=np.int64).view(np.uint64))
                u, v = stars(values, limit)
                greater.append(u)
                lesser.append(v)
            if greater:
                u, v = np.concatenate(greater), np.concatenate(lesser)
                a, b = u.view(np.int64), v.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"]
                )

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot_codes: int = HOT_CODES) -> DataFrame:
    """(u, v) with u > v: for each bucket, every linked code with the least code it reaches there.

    ``distinct`` has one row per fingerprint (``bits``), and is read twice. A bucket holds
    distinct fingerprints that agree in two blocks; copies never meet in it. Those of buckets
    with more than ``hot_codes`` are counted first, and go to buckets of more bits instead.
    """
    masks = block_keys(max_bits)

    def keys(wanted: list[int]) -> Column:
        return F.array(*[F.col("bits").bitwiseAND(F.lit(_signed(mask))) for mask in wanted])

    dealt = distinct.select("bits", F.posexplode(keys([mask for _, mask in masks])).alias("n", "key"))
    sizes = dealt.groupBy("n", "key").agg(F.count("*").alias("codes")).where(F.col("codes") > hot_codes)
    hot = sizes.select("n", "key").checkpoint(eager=True)
    whole = dealt.select("bits", "n", F.lit(0).alias("part"), "key")
    if not hot.isEmpty():
        part_keys = F.lit(None)
        for n, mask in masks:
            part_keys = F.when(F.col("n") == n, keys(finer_masks(mask, max_bits))).otherwise(part_keys)
        finer = dealt.join(hot, ["n", "key"]).select("bits", "n", F.posexplode(part_keys).alias("part", "key"))
        cold = dealt.join(hot, ["n", "key"], "left_anti").select("bits", "n", F.lit(-1).alias("part"), "key")
        whole = cold.unionByName(finer)
    buckets = (
        whole.groupBy("n", "part", "key")
        .agg(F.collect_list("bits").alias("codes"))
        .where(F.size("codes") > 1)
        .select("codes")
    )
    return buckets.mapInArrow(_bucket_batches(max_bits), "u long, v long")


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(bits, root, component_id): the class of every distinct fingerprint; ``prints`` is stored.

    ``root`` is the class's least fingerprint, ``component_id`` the smallest document id that
    links lead to; null ids count only where a class has no other.
    """
    distinct = prints.groupBy("bits").agg(F.min("doc_id").alias("least")).checkpoint(eager=True)
    roots = components(links(distinct, max_bits)).withColumnRenamed("u", "bits")
    rooted = distinct.join(roots, "bits", "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("bits", "root", "component_id")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows are
    returned as often as they occur. An empty table gives no rows. No other column is read.
    """
    prepare(spark)
    prints = fingerprint_documents(docs, doc_id, text, width).checkpoint(eager=True)
    found = classes(prints, max_bits)
    return prints.join(found, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each class: its smallest id, then the smallest text hash.

    Repeated rows (same id, same text) are one document and leave one row. Null ids come last.
    Ids and texts are matched by a 64-bit hash each, which also holds for null ids. Columns of
    ``docs`` stay inside a struct, so no name can clash.
    """
    prepare(spark)
    prints = fingerprint_documents(docs, doc_id, text, width).checkpoint(eager=True)
    found = classes(prints, max_bits).select("bits", "root")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version")
    leaders = prints.join(found, "bits").groupBy("root").agg(F.min(order).alias("first"))
    keys = leaders.select(F.xxhash64("first.doc_id").alias("_id_hash"), F.col("first.version").alias("_text_hash"))
    others = F.to_json(F.struct(*[c for c in docs.columns if c != text]))
    mine = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(doc_id).alias("_id_hash"),
        F.xxhash64(text).alias("_text_hash"),
        others.alias("_others"),
    )
    kept = mine.join(keys, ["_id_hash", "_text_hash"], "left_semi")
    copy = F.row_number().over(Window.partitionBy("_id_hash", "_text_hash").orderBy("_others"))
    return kept.withColumn("_copy", copy).where("_copy = 1").select("row.*")
