"""Token counts (1): count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character; dynamic
programming carries the best score and its number of pieces, never the pieces themselves. The
rules are those of the public unigram tokenizers: a character that no piece of one character
covers costs the least score less 10 and counts as its UTF-8 bytes (byte fallback); of equal
scores the path whose last piece begins first wins.

A text is blanks turned to U+2581 with one in front. No piece has a U+2581 after another
character, so the best path over a text is made of the best paths over its chunks, each a word
with the marks before it; a chunk's count is kept while a task runs (``MEMO`` entries at most).

The vocabulary file has merge ranks, not log probabilities: rank r scores -ln(r + 1), rounded to
2^-16, which makes sums of scores exact and so independent of where a text is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import prepare

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 400_000
UNKNOWN_PENALTY = 10.0
MAX_VOCABULARY_BYTES = 64 << 20
_STEP = 1 << 16


def unigram_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of the pieces of a vocabulary file, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    pieces = [model.id_to_piece(i) for i in ids]
    if sum(len(p.encode()) for p in pieces) > MAX_VOCABULARY_BYTES:
        raise ValueError("vocabulary too large to hold in every task")
    return [(piece, round(-math.log(rank + 1) * _STEP) / _STEP) for rank, piece in enumerate(pieces)]


class Counter:
    """Counts pieces of texts; one per task."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self.automaton.make_automaton()
        self.empty = not vocabulary
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        #: Pieces with a mark after another character would tie the chunks together.
        self.apart = not any(MARK in piece.lstrip(MARK) for piece, _ in vocabulary)
        self.memo: dict[str, int] = {}

    def chunk(self, text: str) -> int:
        """Pieces on the best path over ``text``."""
        n = len(text)
        score = [None] * (n + 1)
        pieces = [0] * (n + 1)
        begin = [0] * (n + 1)
        score[0] = 0.0
        last, single = 0, True  # characters whose matches are all seen; one of length 1 among them

        def settle(upto: int) -> None:
            """Lets characters up to ``upto`` that no single piece covers count as unknown."""
            for at in range(last if not single else last + 1, upto + 1):
                found = score[at - 1] + self.unknown
                if score[at] is None or found > score[at]:
                    score[at], pieces[at] = found, pieces[at - 1] + len(text[at - 1].encode("utf-8", "replace"))

        for end, (length, value) in () if self.empty else self.automaton.iter(text):
            at = end + 1
            if at != last:
                settle(end)
                last, single = at, False
            start = at - length
            found, best = score[start] + value, score[at]
            if best is None or found > best or (found == best and start < begin[at]):
                score[at], pieces[at], begin[at] = found, pieces[start] + 1, start
            single = single or length == 1
        settle(n)
        return pieces[n]

    def count(self, text: str | None) -> int:
        """Pieces of a whole text; none for an empty or null one."""
        if not text:
            return 0
        if not self.apart:
            return self.chunk(MARK + text.replace(" ", MARK))
        memo, total, marks = self.memo, 0, ""
        for word in text.replace(MARK, " ").split(" "):
            marks += MARK
            if not word:
                continue
            key = marks + word
            marks = ""
            found = memo.get(key)
            if found is None:
                found = self.chunk(key)
                if len(memo) >= MEMO:
                    memo.clear()
                if len(key) < 64:
                    memo[key] = found
            total += found
        return total + (self.chunk(marks) if marks else 0)


def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["row", "n_tokens"])

    return run


def count_tokens(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: list[tuple[str, float]] | None = None,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) and ``n_tokens`` of every row.

    Null and empty texts have 0 tokens. An empty vocabulary counts bytes. Repeated rows are
    counted each. The vocabulary is broadcast; its size is checked when it is read.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(unigram_vocabulary() if vocabulary is None else vocabulary)
    source = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(_count_batches(shared), f"row {kind}, n_tokens long")
