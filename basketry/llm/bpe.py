"""Byte-level BPE encoding and decoding (11) by a contiguous rank array.

A text is cut at special tokens, then by the tokenizer's pattern into words. A short word is two
flat lists: the boundaries of its parts, one byte each at first, and the rank of the merge of each
pair of neighbours. The least rank is looked for again and again (of equal ones the leftmost), the
boundary inside that pair is deleted, and the ranks on both sides are refreshed. Scanning flat
lists beats a heap for the few bytes of a word; words over ``LONG_WORD`` bytes take a heap, which
keeps a text without blanks from costing the square of its length. Words that are new in many texts
(``Memo.join``) are merged side by side: their parts lie in one array, and in each round every word
joins its leftmost pair of least rank. A rule is known by the bytes it makes
and the length of its left part, so no two parts join unless the file has that very rule.

The tables come from a tokenizer file in JSON (its path is a parameter); the driver reads it,
checks its size and broadcasts it. Ids of short words are kept by a Python worker from task to
task (twice ``MEMO`` words at most). Memory follows the longest text, about thirty bytes a character; no text is cut.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers.pre_tokenizers import ByteLevel

from basketry.llm.texts import prepare

MEMO = 300_000
MEMO_WORD = 64
LONG_WORD = 256
MAX_FILE_BYTES = 64 << 20
NO_RANK = 1 << 62

# The pattern that byte-level tokenizers cut words by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same pattern where the letters of the class NEW are none.
NARROW = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[NEW]]+| ?[\p{N}--[NEW]]+| ?(?:[^\s\p{L}\p{N}]|[NEW])+|\s+(?!\S)|\s+"
)

# The same pattern in spelled-out classes of letters, digits and white space.
SPELLED = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


def spelled_words():
    """``PATTERN`` for texts without characters past U+FFFF; ``re`` looks its classes up in tables."""
    every = "".join(map(chr, range(0x10000)))
    spelled = SPELLED
    for name, kind in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("S", r"\s+")):
        runs = [f"\\u{ord(x[0]):04x}-\\u{ord(x[-1]):04x}" for x in regex.findall(kind, every)]
        spelled = spelled.replace(f"{{{name}}}", "".join(runs))
    return re.compile(spelled).findall


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of each id, id of each part, rank and left length of the rule that makes a part, special
    tokens, letters that the tokenizer takes for none."""

    bytes_of: tuple[bytes | None, ...]
    id_of: dict[bytes, int]
    ranks: dict[bytes, int]
    lefts: tuple[int, ...]
    special: dict[str, int]
    newer: str


def byte_letters() -> dict[str, int]:
    """Letter to byte: printable Latin-1 letters stand for themselves, other bytes for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def newer_letters() -> str:
    """A character class of the letters and digits that the tokenizers library does not know as such.

    Its tables are of an older Unicode than those of ``regex``; what this Python's own tables do
    not have either is put to the library, letter by letter.
    """
    known = regex.compile(r"(\p{L})|\p{N}")
    one = ByteLevel(add_prefix_space=False).pre_tokenize_str
    found = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn" and (kind := known.match(chr(c))):
            if len(one(("a" if kind[1] else "1") + chr(c))) > 1:
                found.append(c)
    runs: list[list[int]] = []
    for c in found:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in runs)


def read_vocabulary(path: str) -> Vocabulary:
    """Tables of a byte-level BPE file; raises where the file asks for what is not done here."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError("tokenizer file too large to hold in every task")
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, added, before = told["model"], told.get("added_tokens") or [], told.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        raise ValueError("not a byte-level BPE file without a prefix space")
    if told.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("normalizers, dropout and whole-word lookups are not supported")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("special tokens that take blanks along are not supported")
    letters = byte_letters()
    raw = {piece: bytes(letters[c] for c in piece) for piece in model["vocab"]}
    special = {t["content"]: t["id"] for t in added}
    table: list[bytes | None] = [None] * (1 + max([*model["vocab"].values(), *special.values()], default=-1))
    for piece, at in model["vocab"].items():
        table[at] = raw[piece]
    for content, at in special.items():
        table[at] = content.encode()
    rules = [rule.split(" ") if isinstance(rule, str) else rule for rule in model["merges"]]
    ranks = {raw[left] + raw[right]: rank for rank, (left, right) in enumerate(rules)}
    if len(ranks) < len(rules):
        raise ValueError("two merge rules make the same part")
    lefts = tuple(len(raw[left]) for left, _ in rules)
    id_of = {raw[piece]: at for piece, at in model["vocab"].items()}
    if any(bytes([b]) not in id_of for b in range(256)):
        raise ValueError("a byte has no token")
    return Vocabulary(tuple(table), id_of, ranks, lefts, special, newer_letters())


class NewerLetter(Exception):
    """A word holds a letter that the tokenizer's tables do not have."""


class Memo(dict):
    """Ids by word; a miss is worked out, and kept if the word is short.

    Two generations of ``MEMO`` words: when one is full the one before it goes, so that common
    words stay.
    """

    def __init__(self, work, rare):
        self.work, self.rare, self.old = work, rare, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            if self.rare and not word.isascii() and self.rare(word):
                raise NewerLetter
            found = self.work(word)
            if len(word) > MEMO_WORD:
                return found
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found

    def join(self, texts: list[list[str]], work_all) -> list[bytes | None]:
        """Ids of each text's words; None for a text with a word that has none.

        ``work_all`` takes the words that are not remembered, all at once, each once.
        """
        found = [list(map(self.get, words)) for words in texts]
        gaps = [[i for i, ids in enumerate(each) if ids is None] for each in found]
        new = dict.fromkeys(words[i] for words, at in zip(texts, gaps, strict=True) for i in at)
        for word in new:
            new[word] = self.old.get(word)
        unknown = [word for word, ids in new.items() if ids is None]
        new.update(zip(unknown, work_all(unknown), strict=True))
        for each, words, at in zip(found, texts, gaps, strict=True):
            for i in at:
                each[i] = new[words[i]]
        for word, ids in new.items():
            if ids is not None and len(word) <= MEMO_WORD:
                if len(self) >= MEMO:
                    self.old = dict(self)
                    self.clear()
                self[word] = ids
        lost = [any(each[i] is None for i in at) for each, at in zip(found, gaps, strict=True)]
        return [None if gone else b"".join(each) for gone, each in zip(lost, found, strict=True)]


class Rules:
    """Merge rules as arrays: the key of a pair of ids, in order, its rank, and the id that it makes."""

    def __init__(self, vocabulary: Vocabulary):
        id_of, lefts = vocabulary.id_of, vocabulary.lefts
        self.n = len(vocabulary.bytes_of)
        self.byte_ids = np.array([id_of[bytes([b])] for b in range(256)], np.int64)
        rules = [
            (id_of[part[: lefts[rank]]] * self.n + id_of[part[lefts[rank] :]], rank, id_of[part])
            for part, rank in vocabulary.ranks.items()
        ]
        rules.sort()
        self.keys, self.ranks, made = np.array(rules or [(-1, 0, 0)], np.int64).T.copy()
        self.made = np.zeros(int(self.ranks.max()) + 1, np.int64)
        self.made[self.ranks] = made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, none of them empty."""
        size = np.array([len(w) for w in words], np.int64)
        part = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(part), NO_RANK)  # of the pair that begins here
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self.rank(part[inside], part[inside + 1])
        merged = []
        while len(part):
            least = np.minimum.reduceat(rank, np.cumsum(size) - size)
            if (over := least == NO_RANK).any():
                gone = np.repeat(over, size)
                merged.append((owner[gone], part[gone]))
                owner, part, rank = owner[~gone], part[~gone], rank[~gone]
                size, least = size[~over], least[~over]
                if not len(part):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            at = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])]
            part[at] = self.made[least]
            kept = np.ones(len(part), bool)
            kept[at + 1] = False
            owner, part, rank = owner[kept], part[kept], rank[kept]
            size = size - 1
            at = at - np.arange(len(at))  # a part went in each word before
            after = np.minimum(at + 1, len(part) - 1)
            follows = (after > at) & (owner[after] == owner[at])
            rank[at] = np.where(follows, self.rank(part[at], part[after]), NO_RANK)
            at = at[at > 0]
            at = at[owner[at - 1] == owner[at]]
            rank[at - 1] = self.rank(part[at - 1], part[at])
        owner, part = (np.concatenate(x) for x in zip(*merged, strict=True)) if merged else (owner, part)
        ids = part[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(owner, minlength=len(words))) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Bpe:
    """Encodes and decodes texts; one per task."""

    def __init__(self, vocabulary: Vocabulary, *, special: bool = True):
        self.v = vocabulary
        self.words = regex.compile(PATTERN).findall
        self.spelled_words = self.rules = None  # made when first needed
        self.narrow = None
        names = sorted(vocabulary.special, key=lambda s: (-len(s), s)) if special else []
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        rare = regex.compile(f"[{vocabulary.newer}]").search if vocabulary.newer else None
        self.rare = rare
        self.memo = Memo(self.word, rare)

    def boundaries(self, word: bytes) -> list[int]:
        """Part boundaries of a word when no merge is left."""
        if len(word) > LONG_WORD:
            return self._long_boundaries(word)
        get, lefts = self.v.ranks.get, self.v.lefts
        bounds = list(range(len(word) + 1))
        ranks = [get(word[i : i + 2], NO_RANK) for i in bounds[:-2]]
        last = len(ranks) - 1
        while last >= 0:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            last -= 1
            a, b = bounds[i], bounds[i + 1]
            if i <= last:
                rank = get(word[a : bounds[i + 2]], NO_RANK)
                ranks[i] = rank if rank == NO_RANK or lefts[rank] == b - a else NO_RANK
            if i:
                before = bounds[i - 1]
                rank = get(word[before:b], NO_RANK)
                ranks[i - 1] = rank if rank == NO_RANK or lefts[rank] == a - before else NO_RANK
        return bounds

    def _long_boundaries(self, word: bytes) -> list[int]:
        """The same with a heap of (rank, part) and links between parts, for words without end."""
        n, get, lefts = len(word), self.v.ranks.get, self.v.lefts
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2], NO_RANK)) != NO_RANK]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if gone[a] or gone[b] or after[a] != b or after[b] != c:
                continue
            gone[b] = 1
            after[a], before[c] = c, a
            for i in (a, before[a]):
                if i >= 0 and after[i] < n:
                    j, k = after[i], after[after[i]]
                    rank = get(word[i:k], NO_RANK)
                    if rank != NO_RANK and lefts[rank] == j - i:
                        heapq.heappush(heap, (rank, i, j, k))
        bounds, i = [0], 0
        while i < n:
            i = after[i]
            bounds.append(i)
        return bounds

    def word(self, word: str) -> bytes:
        """Ids of one word."""
        raw = word.encode("utf-8", "replace")
        whole = self.boundaries(raw)
        ids = [self.v.id_of[raw[a:b]] for a, b in zip(whole, whole[1:])]
        return pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        try:
            return b"".join(map(self.memo.__getitem__, self.words(text)))
        except NewerLetter:
            if self.narrow is None:
                self.narrow = regex.compile(NARROW.replace("NEW", self.v.newer), regex.V1).findall
            return b"".join(map(self.word, self.narrow(text)))

    def _words(self, words: list[str]) -> list[bytes | None]:
        """Ids of words; None where one holds a letter that the tokenizer's tables do not have."""
        raw = [w.encode("utf-8", "replace") for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= LONG_WORD]
        found: list[bytes | None] = [None] * len(words)
        for i, ids in zip(short, self.rules.merge([raw[i] for i in short]), strict=True):
            found[i] = ids
        for i, word in enumerate(words):
            if self.rare and not word.isascii() and self.rare(word):
                found[i] = None
            elif found[i] is None:
                found[i] = self.word(word)
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, none of which holds a special token that counts."""
        if self.rules is None:
            self.rules, self.spelled_words = Rules(self.v), spelled_words()
        wide = (not t.isascii() and len(t.encode("utf-16-le", "surrogatepass")) > 2 * len(t) for t in texts)
        words = [self.words(t) if w else self.spelled_words(t) for t, w in zip(texts, wide)]
        found = self.memo.join(words, self._words)
        return [self._plain(t) if ids is None else ids for t, ids in zip(texts, found, strict=True)]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; none for null."""
        if not text:
            return b""
        if not self.special or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return b"".join(
            pack("<I", self.v.special[part]) if i % 2 else self._plain(part) for i, part in enumerate(parts)
        )

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; ids that the file does not have are passed over, broken UTF-8 is replaced."""
        table = self.v.bytes_of
        return b"".join([table[i] or b"" for i in ids.tolist() if 0 <= i < len(table)]).decode("utf-8", "replace")


#: The encoder that this Python worker used last; the broadcast value stays the same object there.
_kept: list[tuple[Vocabulary, bool, Bpe]] = []


def worker_bpe(vocabulary: Vocabulary, special: bool = True) -> Bpe:
    """An encoder that is kept, with its memo, from one task of a Python worker to the next."""
    for known, how, bpe in _kept:
        if known is vocabulary and how == special:
            return bpe
    _kept[:] = [(vocabulary, special, Bpe(vocabulary, special=special))]
    return _kept[0][2]


def _encode_batches(shared, special: bool, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(shared.value, special)
        for batch in batches:
            found = [bpe.encode(t.as_py()) for t in batch.column(1)]
            if packed:
                ids = pa.array(found, pa.binary())
            else:
                ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int64).astype(np.int32)
                values = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["row", "ids"])

    return run


def _decode_batches(shared, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            ids = (x.as_py() for x in batch.column(at))
            if packed:
                found = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in ids]
            else:
                found = [bpe.decode(np.array([i for i in x or () if i is not None], np.int64)) for x in ids]
            columns = [*batch.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "decoded"])

    return run


def encode_texts(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    special: bool = True,
    packed: bool = False,
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) and ``ids`` of every row, in one pass without a shuffle.

    ``ids`` is an array of int or, ``packed``, a binary of little-endian unsigned 32-bit integers.
    With ``special`` the string of a special token inside a text becomes that token's id, else it
    is plain text; no token is ever added. Null and empty texts have no ids; a text of only blanks
    has ids; repeated rows are encoded each; an empty table gives an empty one. ``row`` keeps the
    documents' own columns apart, so none can clash. A very long text or word is encoded whole.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))
    source = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    ids = "binary" if packed else "array<int>"
    return source.mapInArrow(_encode_batches(shared, special, packed), f"row {kind}, ids {ids}")


def decode_ids(spark: SparkSession, tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``decoded``, the text of its ``ids`` (array of int or packed binary).

    Special tokens give their strings. Null or no ids give an empty text; null, negative or unknown
    ids are passed over; bytes that are no UTF-8 become U+FFFD. A column ``decoded`` of the table
    is replaced.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))
    source = tokens.drop("decoded")
    packed = source.schema["ids"].dataType.simpleString() == "binary"
    schema = StructType([*source.schema.fields, StructField("decoded", StringType())])
    return source.mapInArrow(_decode_batches(shared, packed), schema)
