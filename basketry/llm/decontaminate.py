"""Benchmark decontamination (6): Wu-Manber search of benchmark windows in whole documents.

Symbols are words. A pattern is a window of ten consecutive words of a benchmark item; an item
of fewer words is one pattern. Patterns of one length form a set with its own tables:

* the shift table says for the block of two words under the cursor how far the cursor may move
  before any pattern can end there (a block that no pattern holds: length - 1 words);
* where the shift is 0, the hash of that last block selects the patterns that end with it;
* the selected patterns are compared with the document, word hashes first, bytes last.

Many stretches of the text are searched side by side, one cursor each, with array operations.

The patterns of up to ``PASS_BYTES`` of benchmark text are broadcast, which bounds what a
worker holds; a larger benchmark is searched in several passes of that size, whose hits are
then brought together per document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import ALNUM, Words, mix, prepare, slices, texts_of

WINDOW = 10
PASS_BYTES = 4 << 20
_STRETCH = 256
_VERDICT = "n_words long, n_hit long, n_items long, items array<string>"


@dataclass
class PatternSet:
    """The patterns of one length, ordered by their last block."""

    length: int
    first: np.ndarray  # where each distinct pattern starts among the benchmark's words
    last_block: np.ndarray
    items: list[list[str]]
    shift: np.ndarray
    mask: np.uint64


@dataclass
class Benchmark:
    hashes: np.ndarray
    spelled: list[bytes]
    sets: list[PatternSet]


def _blocks(h: np.ndarray, length: int) -> np.ndarray:
    """The block that ends at each word: the word and the one before, or the word alone."""
    if length == 1:
        return h
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    return mix(before, h)


def _pattern_set(length: int, by_words: dict[tuple[bytes, ...], tuple[int, list[str]]], h: np.ndarray) -> PatternSet:
    first = np.array([start for start, _ in by_words.values()], dtype=np.int64)
    items = [sorted(set(ids)) for _, ids in by_words.values()]
    blocks = _blocks(h, length)
    width = 1 if length == 1 else 2
    size = 1 << max(16, int(len(first) * length * 8).bit_length())
    mask = np.uint64(size - 1)
    shift = np.full(size, length - width + 1, dtype=np.int64)
    for end in range(width - 1, length):
        np.minimum.at(shift, (blocks[first + end] & mask).astype(np.int64), length - 1 - end)
    last = blocks[first + length - 1]
    order = np.argsort(last, kind="stable")
    return PatternSet(length, first[order], last[order], [items[i] for i in order], shift, mask)


def build(items: list[tuple[str, str | None]], window: int = WINDOW) -> Benchmark:
    """Tables of the windows of (item id, text) pairs."""
    texts = texts_of(pa.array([text for _, text in items], pa.string())).lowered()
    words = texts.words(ALNUM)
    h = words.hashes()
    spelled = [texts.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
    by_length: dict[int, dict[tuple[bytes, ...], tuple[int, list[str]]]] = defaultdict(dict)
    for i, (item, _) in enumerate(items):
        low, high = int(words.at[i]), int(words.at[i + 1])
        length = min(window, high - low)
        for start in range(low, high - length + 1) if length else ():
            by_length[length].setdefault(tuple(spelled[start : start + length]), (start, []))[1].append(item)
    return Benchmark(h, spelled, [_pattern_set(n, found, h) for n, found in sorted(by_length.items())])


def _ends(patterns: PatternSet, blocks: np.ndarray) -> np.ndarray:
    """Word positions at which the shift is 0, found by cursors that skip."""
    n = len(blocks)
    first = np.arange(0, n, _STRETCH)
    stop = np.minimum(first + _STRETCH, n)
    cursor = np.maximum(first, patterns.length - 1)
    slot = (blocks & patterns.mask).astype(np.int64)
    found = []
    live = cursor < stop
    while live.any():
        cursor, stop = cursor[live], stop[live]
        move = patterns.shift[slot[cursor]]
        found.append(cursor[move == 0])
        cursor = cursor + np.maximum(move, 1)
        live = cursor < stop
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def occurrences(patterns: PatternSet, bench: Benchmark, words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence inside one text."""
    length = patterns.length
    none = np.zeros(0, np.int64)
    if len(h) < length:
        return none, none
    blocks = _blocks(h, length)
    ends = _ends(patterns, blocks)
    low = np.searchsorted(patterns.last_block, blocks[ends], side="left")
    size = np.searchsorted(patterns.last_block, blocks[ends], side="right") - low
    ends, low, size = ends[size > 0], low[size > 0], size[size > 0]
    start = np.repeat(ends - length + 1, size)
    chosen = np.arange(len(start)) + np.repeat(low - (np.cumsum(size) - size), size)
    for k in range(length):
        same = bench.hashes[patterns.first[chosen] + k] == h[start + k]
        start, chosen = start[same], chosen[same]
    one_text = np.searchsorted(words.at, start, side="right") == np.searchsorted(
        words.at, start + length - 1, side="right"
    )
    start, chosen = start[one_text], chosen[one_text]
    data = words.texts.data
    exact = np.array(
        [
            all(
                data[words.starts[s + k] : words.ends[s + k]].tobytes() == bench.spelled[patterns.first[p] + k]
                for k in range(length)
            )
            for s, p in zip(start, chosen, strict=True)
        ],
        dtype=bool,
    )
    return start[exact], chosen[exact]


def _search(column: pa.Array, bench: Benchmark) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """For each text: its number of words, which are hit, and the items that occur."""
    for _, _, texts in slices(column):
        words = texts.lowered().words(ALNUM)
        h = words.hashes()
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for patterns in bench.sets:
            start, chosen = occurrences(patterns, bench, words, h)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + patterns.length, -1)
            owner = np.searchsorted(words.at, start, side="right") - 1
            for i, p in set(zip(owner.tolist(), chosen.tolist(), strict=True)):
                items[i].update(patterns.items[p])
        hit = np.cumsum(edge[:-1]) > 0
        for i in range(len(texts)):
            yield int(words.at[i + 1] - words.at[i]), hit[words.at[i] : words.at[i + 1]], sorted(items[i])


def _one_pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_search(batch.column(batch.num_columns - 1), shared.value))
            columns = [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([int(hit.sum()) for _, hit, _ in found], pa.int64()),
                pa.array([len(items) for _, _, items in found], pa.int64()),
                pa.array([items for _, _, items in found], pa.list_(pa.string())),
            ]
            names = [*batch.schema.names[:-1], "n_words", "n_hit", "n_items", "items"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    return run


def _runs(hit: np.ndarray) -> list[int]:
    """Bounds of the runs that are set: first, one past the last, and so on."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def _part_of_passes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_search(batch.column(batch.num_columns - 1), shared.value))
            columns = [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([_runs(hit) for _, hit, _ in found], pa.list_(pa.int64())),
                pa.array([items for _, _, items in found], pa.list_(pa.string())),
            ]
            names = [*batch.schema.names[:-1], "n_words", "runs", "items"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    return run


def _covered(runs: list[list[int]]) -> int:
    total = reach = 0
    for first, stop in sorted((r[i], r[i + 1]) for r in runs for i in range(0, len(r), 2)):
        total += max(0, stop - max(first, reach))
        reach = max(reach, stop)
    return total


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [_covered(r) for r in batch.column("runs").to_pylist()]
        items = [sorted({x for part in p for x in part}) for p in batch.column("items").to_pylist()]
        kept = batch.select([n for n in batch.schema.names if n not in ("runs", "items")])
        columns = [
            *kept.columns,
            pa.array(runs, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array(items, pa.list_(pa.string())),
        ]
        yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, "n_hit", "n_items", "items"])


def passes_over(benchmark: DataFrame, item_text: str = "text", pass_bytes: int = PASS_BYTES) -> int:
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    return max(1, -(-size // pass_bytes))


def drop_contaminated(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` less those that hold a benchmark window.

    After one pass the rows come out of the search itself. After several the ids and texts that
    were hit are taken out by an anti-join on a hash of each.
    """
    if passes_over(benchmark, pass_bytes=pass_bytes) == 1:
        marked = mark_contaminated(spark, docs, benchmark, doc_id=doc_id, text=text, carry=docs.columns)
        return marked.where("n_hit = 0").select("row.*")
    marked = mark_contaminated(spark, docs, benchmark, doc_id=doc_id, text=text, pass_bytes=pass_bytes)
    hit = marked.where("n_hit > 0").select(F.xxhash64("doc_id").alias("_id_hash"), F.col("version").alias("_text_hash"))
    mine = docs.withColumn("_id_hash", F.xxhash64(doc_id)).withColumn("_text_hash", F.xxhash64(text))
    return mine.join(hit.distinct(), ["_id_hash", "_text_hash"], "left_anti").select(*docs.columns)


def mark_contaminated(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` with their words, words hit, items that occur (sorted as strings).

    Null and empty texts have no words and are never hit; items without words never occur; a
    null item id is listed as ``null``; repeated items count once. Repeated documents are judged
    each. An empty benchmark hits nothing. ``carry`` names columns of ``docs`` to return in a
    struct ``row`` beside the result, so that no name of theirs can clash with it; that needs a
    benchmark of one pass. Several passes add ``version``, a hash of the text.
    """
    prepare(spark)
    listed = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("text")
    )
    passes = passes_over(benchmark, item_text, pass_bytes)
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = [F.col(doc_id).alias("doc_id")]
    head = f"doc_id {kind}, "
    if carry:
        columns.append(F.struct(*carry).alias("row"))
        head += f"row {docs.select(F.struct(*carry).alias('row')).schema['row'].dataType.simpleString()}, "
    source = docs.select(*columns, F.col(text).alias("text"))

    def tables(k: int):
        part = listed if passes == 1 else listed.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k)
        return spark.sparkContext.broadcast(build([tuple(r) for r in part.collect()], window))

    if passes == 1:
        return source.mapInArrow(_one_pass(tables(0)), head + _VERDICT)
    if carry:
        raise ValueError("carry needs a benchmark of one pass; join the result to the documents instead")
    keyed = source.select("doc_id", F.xxhash64("text").alias("version"), "text")
    found = None
    for k in range(passes):
        part = keyed.mapInArrow(
            _part_of_passes(tables(k)),
            f"doc_id {kind}, version long, n_words long, runs array<long>, items array<string>",
        )
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("doc_id", "version", "n_words").agg(
        F.collect_set("runs").alias("runs"),
        F.collect_set("items").alias("items"),
        (F.count("*") / passes).cast("long").alias("copies"),
    )
    whole = merged.mapInArrow(
        _together,
        f"doc_id {kind}, version long, n_words long, copies long, n_hit long, n_items long, items array<string>",
    )
    each = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("doc_id", "version", "n_words", "n_hit", "n_items", "items")


def digest(marked: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
