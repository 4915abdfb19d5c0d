"""Cross-tokenizer alignment (12) as an Arrow pipeline, with counts of linked ids over the corpus.

Tokenizer A is a byte-level BPE file, B a sentence-piece BPE model; both read a blank and the text,
so their tokens' bytes, laid end to end, are the same. In a slice of documents the two id lists are
flattened with the index of their document, token sizes become ends by a cumulative sum that starts
again with each document, and an Acero hash join (full outer) on the key (document, end) meets the
ends of both. In order of that key each row is one link: the A token and the B token over the bytes
that end there, the missing one being the next that ends. Rows where both end cut the groups.

``Table.group_by`` folds a document's links to (pair, times), and (pair, documents) over all that a
task reads; Spark merges the partial counts. Aligned documents are written to the shared folder
between the two passes, so that nothing is tokenized twice and no lineage is long. Counts return to
the documents by a hash join: broadcast up to ``MAX_BROADCAST_PAIRS`` pairs, else on both sides'
hash, where AQE splits the partitions of pairs that are in most documents.

A task holds one slice, ``SLICE_CHARS`` characters or the longest text, at some 400 bytes a token.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe import Bpe, Memo, Vocabulary, read_vocabulary, worker_bpe
from basketry.llm.texts import prepare
from basketry.session import ensure_checkpoint_dir

MARK = "▁"
SLICE_CHARS = 1 << 18
MAX_MODEL_BYTES = 64 << 20
MAX_BROADCAST_PAIRS = 1_000_000
PARTIAL_PAIRS = 1 << 20
_DOC_BITS = 40
_A_BITS = 32


class Unfaithful(Exception):
    """The bytes of a text's pieces are not the text's."""


class Pieces:
    """Ids of a sentence-piece model; one per worker.

    If no piece has a mark after another character, the pieces of a text are those of its chunks,
    each a word with the blanks before it; chunks are then remembered. Else texts go whole. Either
    is compared with the bytes of its pieces.
    """

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.table = [self._bytes(i, names[i]) for i in range(n)]
        self.apart = not any(MARK in name.lstrip(MARK) for name in names)
        self.chunks = re.compile(r" +[^ ]*").findall
        self.memo = Memo(self._chunk, None)

    def _bytes(self, i: int, name: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(name[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return name.replace(MARK, " ").encode()

    def _ids(self, text: str) -> bytes:
        """Ids of a text; the model puts one blank in front."""
        found = self.model.encode(text) if text else [self.model.piece_to_id(MARK)]
        if b"".join([self.table[i] for i in found]) != (" " + text).encode("utf-8", "replace"):
            raise Unfaithful
        return pack(f"<{len(found)}I", *found)

    def _chunk(self, chunk: str) -> bytes:
        return self._ids(chunk[1:])

    def encode(self, text: str) -> bytes:
        if not self.apart:
            return self._ids(text)
        return b"".join(map(self.memo.__getitem__, self.chunks(" " + text)))


class Aligner:
    """Both tokenizers with the byte lengths and decimal strings of their ids."""

    def __init__(self, vocabulary: Vocabulary, model: bytes):
        self.a: Bpe = worker_bpe(vocabulary, False)
        self.b = Pieces(model)
        self.a_bytes = [x or b"" for x in vocabulary.bytes_of]
        self.b_bytes = self.b.table
        self.a_sizes = pa.array([len(x) for x in self.a_bytes], pa.int64())
        self.b_sizes = pa.array([len(x) for x in self.b_bytes], pa.int64())
        #: Decimal ids with what follows them: A , or | and B , or ; or nothing.
        written = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"]
        self.b_strings = len(written)
        written += [f"{i}{end}" for i in range(len(self.b_bytes)) for end in (",", ";", "")]
        self.strings = pa.array(written, pa.string())

    def tokens(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of both, or none if a text is null or empty or either's bytes are not the text's."""
        found = [(b"", b"")] * len(texts)
        some = [i for i, t in enumerate(texts) if t and MARK not in t]
        of_b = {}
        for i in some:
            try:
                of_b[i] = self.b.encode(texts[i])
            except Unfaithful:
                pass
        # The bytes of a word's A parts are the word's by the way they are cut.
        of_a = self.a.encode_all([" " + texts[i] for i in of_b])
        for (i, b), a in zip(of_b.items(), of_a, strict=True):
            found[i] = a, b
        return found


def _lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int64)))


def _ends(ids: pa.LargeListArray, sizes: pa.Array, side: str) -> pa.Table:
    """Tokens of one tokenizer: the key (document, end of the token in it), number and id."""
    flat, doc = pc.list_flatten(ids), pc.cast(pc.list_parent_indices(ids), pa.int64())
    total = pc.cumulative_sum(sizes.take(flat))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(ids.offsets.slice(0, len(ids)))
    ends = pc.subtract(total, before.take(doc))
    key = pc.add(pc.shift_left(doc, pa.scalar(_DOC_BITS, pa.int64())), ends)
    return pa.table({"key": key, side: pa.array(np.arange(len(flat)))}), flat


def align_slice(aligner: Aligner, texts: list[str | None]) -> dict[str, pa.Array]:
    """Counts, groups and folded links of some documents."""
    n = len(texts)
    found = aligner.tokens(texts)
    lists = [_lists([x[k] for x in found]) for k in (0, 1)]
    (a, a_ids), (b, b_ids) = (
        _ends(ids, sizes, side) for ids, sizes, side in zip(lists, (aligner.a_sizes, aligner.b_sizes), "ab")
    )
    met = a.join(b, keys="key", join_type="full outer", use_threads=False).combine_chunks()
    # A join gives a few sorted runs, which a stable sort merges.
    met = met.take(pa.array(np.argsort(met["key"].to_numpy(), kind="stable"))).combine_chunks()
    both = np.asarray(pc.and_(pc.is_valid(met["a"]), pc.is_valid(met["b"])).combine_chunks().to_numpy(zero_copy_only=False))
    at_a, at_b = (pc.fill_null_backward(met[side]).combine_chunks() for side in "ab")
    doc = pc.shift_right(met["key"], pa.scalar(_DOC_BITS, pa.int64())).combine_chunks()
    pair = pc.add(pc.shift_left(a_ids.take(at_a), pa.scalar(_A_BITS, pa.int64())), b_ids.take(at_b))
    folded = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False)
    folded = folded.aggregate([([], "count_all")]).combine_chunks()
    if (np.diff(folded["doc"].to_numpy()) < 0).any():
        folded = folded.sort_by("doc").combine_chunks()

    docs = doc.to_numpy()
    cut_a, cut_b = (np.zeros(len(x), bool) for x in (a_ids, b_ids))
    cut_a[at_a.to_numpy()[both]] = True
    cut_b[at_b.to_numpy()[both]] = True
    per_doc = np.bincount(folded["doc"].to_numpy(), minlength=n)
    starts = pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32))
    counted = {
        "n_a": pc.list_value_length(lists[0]),
        "n_b": pc.list_value_length(lists[1]),
        "n_groups": pa.array(np.bincount(docs[both], minlength=n)),
        "n_links": pa.array(np.bincount(docs, minlength=n)),
    }
    chunk = lambda name: folded[name].combine_chunks()
    return {name: pc.cast(values, pa.int64()) for name, values in counted.items()} | {
        "groups": _groups(aligner, lists, a_ids.to_numpy(), b_ids.to_numpy(), cut_a, cut_b),
        "pairs": pa.ListArray.from_arrays(starts, chunk("pair")),
        "times": pa.ListArray.from_arrays(starts, pc.cast(chunk("count_all"), pa.int32())),
    }


def _groups(aligner, lists, a_ids, b_ids, cut_a, cut_b) -> pa.Array:
    """The groups of each document as ``a1,a2|b1;a3|b2,b3``, written by one take from all ids' strings."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    a_until = (np.flatnonzero(cut_a) + 1)[group_b]  # A tokens up to the end of a B token's group
    b_until = np.concatenate([[0], np.flatnonzero(cut_b) + 1])[group_a]  # B tokens before an A token's group
    take = np.empty(len(a_ids) + len(b_ids), np.int64)
    take[np.arange(len(a_ids)) + b_until] = a_ids * 2 + cut_a
    ends_a, ends_b = (x.offsets.to_numpy() for x in lists)
    follows = cut_b.astype(np.int64)
    follows[ends_b[1:][ends_b[1:] > ends_b[:-1]] - 1] = 2
    take[np.arange(len(b_ids)) + a_until] = aligner.b_strings + b_ids * 3 + follows
    written = pc.cast(aligner.strings, pa.large_string()).take(pa.array(take))
    if isinstance(written, pa.ChunkedArray):
        written = written.combine_chunks()
    offsets = np.frombuffer(written.buffers()[1], np.int64, len(take) + 1) if len(take) else np.zeros(1, np.int64)
    at = offsets[ends_a + ends_b].astype(np.int32)
    if not len(take):
        return pa.array([""] * (len(at) - 1), pa.string())
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.tobytes()), written.buffers()[2])


_kept: list[tuple[Vocabulary, Aligner]] = []


def _worker_aligner(vocabulary: Vocabulary, model: bytes) -> Aligner:
    """An aligner that is kept, with its memos, from one task of a Python worker to the next."""
    if not _kept or _kept[0][0] is not vocabulary:
        _kept[:] = [(vocabulary, Aligner(vocabulary, model))]
    return _kept[0][1]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        more = len(text or "")
        if i > start and size + more > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += more
    if texts:
        yield start, len(texts)


def _align_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker_aligner(*shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _slices(texts):
                made = align_slice(aligner, texts[start:end])
                columns = [batch.column(0).slice(start, end - start), *made.values()]
                yield pa.RecordBatch.from_arrays(columns, ["row", *made])

    return run


def align(
    spark: SparkSession,
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """Every document's alignment, in one pass without a shuffle.

    ``row`` (a struct of the ``keep`` columns), ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (decimal ids, ``a1,a2|b1;a3|b2,b3``), ``pairs`` (an A id in the upper, a B id in the
    lower 32 bits; each once) and ``times`` (links of that pair in the document). Null and empty
    texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros,
    an empty string, empty arrays. Strings of special tokens are plain text. Repeated rows are
    aligned each; an empty table gives an empty one; ``row`` keeps other columns from clashing.
    """
    prepare(spark)
    if os.path.getsize(b_path) > MAX_MODEL_BYTES:
        raise ValueError("model too large to hold in every task")
    with open(b_path, "rb") as file:
        shared = spark.sparkContext.broadcast((read_vocabulary(a_path), file.read()))
    source = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(
        _align_batches(shared),
        f"row {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>",
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, documents that hold it) of what a task reads, folded again whenever it has grown."""
    names, held, size = ["pair", "n"], [], 0

    def fold() -> pa.Table:
        found = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        return found.rename_columns(names)

    for batch in batches:
        pairs = pc.list_flatten(batch.column(0))
        found = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        held.append(found.rename_columns(names))
        size += len(found)
        if size > PARTIAL_PAIRS:
            held = [fold()]
            size = len(held[0])
            if size > PARTIAL_PAIRS // 2:
                yield from held[0].combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from fold().combine_chunks().to_batches()


def count_pairs(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it linked) and ``best`` (n is the highest of its A id)."""
    counts = aligned.select("pairs").mapInArrow(_count_batches, "pair long, n long")
    counts = counts.groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = F.shiftright("pair", _A_BITS)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("highest"))
    joined = counts.withColumn("a", of_a).join(highest, "a")
    return joined.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def score_links(spark: SparkSession, aligned: DataFrame, max_broadcast: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (any columns beside ``pairs`` and ``times``) with ``n_best`` and ``count_sum``.

    ``n_best``: links whose pair is in as many documents as any pair of the same A id, ties
    included; ``count_sum``: documents of the pair, summed over links. Zero without links. The
    table is written to the shared folder first and read from there for both passes; ``pairs`` and
    ``times`` are dropped from the result.
    """
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/align-{uuid.uuid4().hex}"
    others = [c for c in aligned.columns if c not in ("pairs", "times", "n_best", "count_sum")]
    numbered = aligned.withColumn("_uid", F.monotonically_increasing_id())
    numbered.select("_uid", *others, "pairs", "times").write.parquet(f"{folder}/documents")
    stored = spark.read.parquet(f"{folder}/documents")
    count_pairs(stored).write.parquet(f"{folder}/pairs")
    counts = spark.read.parquet(f"{folder}/pairs")
    if counts.count() <= max_broadcast:
        counts = F.broadcast(counts)
    each = stored.select("_uid", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    each = each.select("_uid", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times"))
    sums = (
        each.join(counts, "pair")
        .groupBy("_uid")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return stored.join(sums, "_uid", "left").select(*others, *zero)
