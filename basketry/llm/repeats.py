"""Suffix-array dedup (2): bytes covered by 50-byte strings that an earlier document holds too.

Only strings that can repeat are sorted. Every 50-byte window has a minimizer, the 16-byte piece
in it with the least hash; equal windows have the same one. A stretch of windows with one
minimizer is a *string* here, 50 to 84 bytes long. The steps, each a shuffle of compact arrays:

1. documents are dealt into chunks of a few megabytes by a hash of their id; each chunk sends the
   minimizers it holds, and learns which of them occur in several documents;
2. the chunk's distinct strings on those minimizers go, with the least document that holds them,
   to the minimizer's bucket. Strings without a 44-byte core of another around the minimizer are
   there by chance and are left aside; of the others each shard gets its suffixes sorted once and a
   Burrows-Wheeler transform; the transforms are merged by refining an interleave one symbol a
   round, without sorting the suffixes of all shards again. Suffixes part in the round that is
   one more than their common prefix; what is still together after 50 rounds is an interval of
   equal windows, and its least document is the first that holds them;
3. the windows that an earlier document holds return to the chunk, which cuts them out.

Texts are shuffled once; all three steps read that exchange.

A minimizer that very many documents hold (``HOT_DOCS`` of them in each of ``HOT_CHUNKS`` chunks,
or any in ``WIDE_CHUNKS``), such as that of a passage in a third of all documents, would gather its
strings in one bucket, as they differ in what stands before the passage. Its windows are sent one
by one instead, under a 128-bit hash each, to the buckets of those hashes. Every chunk sends a
window once, however many of its documents hold it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import Texts, mix, prepare

WINDOW = 50
PIECE = 16
_REACH = WINDOW - PIECE + 1  # pieces in a window
CHUNK_BYTES = 4 << 20
MAX_CHUNK_BYTES = 32 << 20
MOST_CHUNKS = 1 << 16
BUCKET_BYTES = 4 << 20
HOT_DOCS = 8
HOT_CHUNKS = 8
WIDE_CHUNKS = 1024
SHARD_SYMBOLS = 1 << 18
BATCH_SYMBOLS = 1 << 20
_SLICE = 1 << 16  # its arrays stay in a core's cache
_LAST = np.iinfo(np.int64).max  # a null id comes after all others
_LOW = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))

_ROWS = "part long, chunk long, kind int, a binary, b binary, c binary, d binary"
_ROW_NAMES = ["part", "chunk", "kind", "a", "b", "c", "d"]
_ZSTD = pa.Codec("zstd", 1)
_SHARED, _RUNS, _FLAGS = 0, 1, 2
_STRINGS, _WINDOWS = 0, 1
_META = [("hash", "<u8"), ("least", "<i8"), ("number", "<u4"), ("place", "u1")]
_BAND = 7  # offsets of a minimizer in its window that are looked at together


def _pack(values: np.ndarray | bytes) -> bytes:
    raw = values if isinstance(values, bytes) else values.tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _raw(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return _ZSTD.decompress(blob[8:], size, asbytes=True) if size else b""


def _unpack(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(_raw(blob), kind)


def _table(rows: list[tuple]) -> pa.Table:
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_ROW_NAMES)


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``begin``, ``begin + 1`` ... of each range, ``count`` numbers of each."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _cuts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])


# Chunks ------------------------------------------------------------------------------------


class Chunk:
    """The documents of one chunk in order of id and text, and their strings."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
        raw = [x or b"" for x in table.column("text").to_pylist()]
        self.order = sorted(range(len(raw)), key=lambda i: (ids[i], raw[i]))
        self.ids = ids[self.order].astype(np.int64)
        raw = [raw[i] for i in self.order]
        offsets = np.cumsum([0, *map(len, raw)]).astype(np.int64)
        self.texts = Texts(np.frombuffer(b"".join(raw), np.uint8), offsets)
        found = []
        first = 0
        while first < len(raw):
            stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE, side="right")) - 1)
            stop = min(stop, len(raw))
            found.append(self._strings(first, stop))
            first = stop
        self.start, self.stop, self.hash, self.place = (np.concatenate(x) for x in zip(*found, strict=True))
        self.doc = self.ids[np.searchsorted(offsets, self.start, side="right") - 1]

    def _strings(self, first: int, stop: int) -> tuple[np.ndarray, ...]:
        """Start, end, minimizer hash and minimizer place of every string of some documents."""
        low, high = int(self.texts.offsets[first]), int(self.texts.offsets[stop])
        length = np.diff(self.texts.offsets[first : stop + 1])
        windows = np.maximum(length - WINDOW + 1, 0)
        n = high - low
        if not windows.any():
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        padded = np.concatenate([self.texts.data[low:high], np.zeros(PIECE, np.uint8)])
        lanes = np.ndarray((n + 9,), "<u8", padded, strides=(1,))
        h = mix(mix(np.full(n, _SEEDS[0]), lanes[:n]), lanes[8 : n + 8])
        # The least hash, then the first place: the place takes the hash's low bits.
        bits = np.uint64(max(20, int(n).bit_length()))
        place = (np.uint64(1) << bits) - np.uint64(1)
        least = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
        width = 1
        while width < _REACH:
            step = min(width, _REACH - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        begin = self.texts.offsets[first:stop] - low
        at = np.arange(windows.sum()) + np.repeat(begin - (np.cumsum(windows) - windows), windows)
        least = least[at]
        edge = _cuts(least)
        piece = (least[edge[:-1]] & place).astype(np.int64)
        head = at[edge[:-1]]
        return head + low, at[edge[1:] - 1] + low + WINDOW, h[piece], (piece - head).astype(np.uint8)

    def shared_strings(self, shared: list[dict], buckets: int) -> None:
        """Keeps the strings whose minimizer is shared, numbers the distinct ones.

        Numbers follow the order of documents, so they come out alike whenever this runs, and
        the first document seen with a string is the least.
        """
        keys = [_keys(_unpack(r["a"], np.uint32), r["part"]) for r in shared]
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        hot = np.concatenate([_unpack(r["b"], np.bool_) for r in shared]) if keys else np.zeros(0, bool)
        order = np.argsort(key)
        key, hot = key[order], hot[order]
        mine = _keys(self.hash & _LOW, (self.hash >> _S32) % np.uint64(buckets))
        at = np.searchsorted(key, mine)
        at[at == len(key)] = 0
        found = key[at] == mine if len(key) else np.zeros(len(mine), bool)
        kept = (self.start, self.stop, self.hash, self.place, self.doc)
        self.start, self.stop, self.hash, self.place, self.doc = (x[found] for x in kept)
        is_hot = hot[at[found]] if len(key) else np.zeros(0, bool)
        numbers: dict[bytes, int] = {}
        body = self.texts.data.tobytes()
        self.number = np.array(
            [numbers.setdefault(body[a:b], len(numbers)) for a, b in zip(self.start.tolist(), self.stop.tolist(), strict=True)],
            dtype=np.int64,
        )
        self.strings = list(numbers)
        _, seen = np.unique(self.number, return_index=True)
        self.least, self.of_hash, self.of_place = self.doc[seen], self.hash[seen], self.place[seen]
        self.hot = is_hot[seen]

    def holders(self, which: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``string``, occurrence) for the occurrences among ``which`` of numbered strings.

        It sorts the chunk's occurrences, so it is asked once for all messages of a chunk.
        """
        mine = np.flatnonzero(which)
        mine = mine[np.argsort(self.number[mine], kind="stable")]
        low = np.searchsorted(self.number[mine], string, side="left")
        many = np.searchsorted(self.number[mine], string, side="right") - low
        row = np.repeat(np.arange(len(string)), many)
        return row, mine[_ranges(low, many)]

    def hot_windows(self) -> tuple[np.ndarray, ...]:
        """Windows of hot strings: (string, offset) of each, its number among the distinct ones;
        of the distinct ones the two hashes and the least document."""
        which = np.flatnonzero(self.hot)
        if not len(which):
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64), none
        joined = b"".join(self.strings[i] for i in which)
        size = np.array([len(self.strings[i]) for i in which])
        begin = np.cumsum(size) - size
        count = size - WINDOW + 1
        string = np.repeat(which, count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(begin, count) + offset
        lanes = np.ndarray((len(joined) + 1,), "<u8", np.frombuffer(joined + bytes(8), np.uint8), strides=(1,))
        pair = []
        for seed in _SEEDS:
            h = np.full(len(at), seed)
            for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
                h = mix(h, lanes[at + k])
            pair.append(h)
        order = np.lexsort((self.least[string], pair[1], pair[0]))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (pair[0][order[1:]] != pair[0][order[:-1]]) | (pair[1][order[1:]] != pair[1][order[:-1]])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        head = order[fresh]
        return string, offset, number, pair[0][head], pair[1][head], self.least[string[head]]


def _keys(low: np.ndarray, bucket) -> np.ndarray:
    return (np.uint64(bucket) << _S32) | low.astype(np.uint64)


def _send_minimizers(buckets: int, hot_docs: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        order = np.lexsort((chunk.doc, chunk.hash))
        h, doc = chunk.hash[order], chunk.doc[order]
        edge = _cuts(h)
        other = np.ones(len(h), dtype=np.int64)
        other[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        docs = np.add.reduceat(other, edge[:-1]) if len(h) else other
        level = (docs >= 2).astype(np.uint8) + (docs >= hot_docs)
        h = h[edge[:-1]]
        bucket = (h >> _S32) % np.uint64(buckets)
        order = np.lexsort((h & _LOW, bucket))
        bucket, low, level = bucket[order], (h[order] & _LOW).astype(np.uint32), level[order]
        number = table.column("chunk")[0].as_py()
        edge = _cuts(bucket)
        return _table(
            [
                (int(bucket[a]), number, 0, _pack(low[a:b]), _pack(level[a:b]), b"", b"")
                for a, b in zip(edge[:-1], edge[1:], strict=True)
            ]
        )

    return run


def _find_shared(hot_chunks: int):
    """For each chunk its minimizers that are in several documents, and which of them are hot."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        low = [_unpack(r["a"], np.uint32) for r in rows]
        sizes = [len(x) for x in low]
        low = np.concatenate(low)
        level = np.concatenate([_unpack(r["b"], np.uint8) for r in rows])
        order = np.argsort(low, kind="stable")
        edge = _cuts(low[order])
        chunks = np.diff(edge)
        some = np.maximum.reduceat(level[order], edge[:-1])
        many = np.add.reduceat((level[order] == 2).astype(np.int64), edge[:-1])
        shared = np.empty(len(low), dtype=bool)
        hot = np.empty(len(low), dtype=bool)
        shared[order] = np.repeat((chunks >= 2) | (some >= 1), chunks)
        hot[order] = np.repeat((many >= hot_chunks) | (chunks >= WIDE_CHUNKS), chunks)
        out, first = [], 0
        for r, size in zip(rows, sizes, strict=True):
            mine = slice(first, first + size)
            first += size
            if shared[mine].any():
                kept = shared[mine]
                out.append((r["part"], r["chunk"], _SHARED, _pack(low[mine][kept]), _pack(hot[mine][kept]), b"", b""))
        return _table(out)

    return run


def _send_strings(buckets: int, parts: int):
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows or not shared.num_rows:
            return _table([])
        number = table.column("chunk")[0].as_py()
        chunk = Chunk(table)
        chunk.shared_strings(shared.to_pylist(), buckets)
        out = []
        cold = np.flatnonzero(~chunk.hot)
        part = chunk.of_hash[cold] % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        part, cold = part[order], cold[order]
        strings = [chunk.strings[i] for i in cold.tolist()]
        body = b"".join(strings)
        size = np.fromiter(map(len, strings), np.uint8, len(strings))
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        meta = np.empty(len(cold), _META)
        meta["hash"], meta["least"], meta["number"] = chunk.of_hash[cold], chunk.least[cold], cold
        meta["place"] = chunk.of_place[cold]
        edge = _cuts(part)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            blobs = [_pack(x) for x in (body[ends[a] : ends[b]], size[a:b], meta[a:b])]
            out.append((int(part[a]), number, _STRINGS, *blobs, b""))
        *_, one, two, least = chunk.hot_windows()
        part = one % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        edge = _cuts(part[order])
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            mine = order[a:b]
            blobs = [_pack(x[mine]) for x in (one, two, least)]
            out.append((int(part[mine[0]]), number, _WINDOWS, *blobs, _pack(mine.astype(np.uint32))))
        return _table(out)

    return run


# Buckets -----------------------------------------------------------------------------------


def sort_shard(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in order of their first ``depth`` symbols (0 ends a string)."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k]
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        if known >= depth:
            return order
        fresh = np.ones(n, dtype=np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        step = min(known, depth - known)
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:]
        key = rank * (n + 1) + after
        known += step


@dataclass(frozen=True)
class Shard:
    """The suffixes of some strings in order, and their Burrows-Wheeler transform."""

    order: np.ndarray  # where each suffix starts
    transform: np.ndarray  # the symbol before it; 0 where a string starts
    before: np.ndarray  # place in this order of the suffix that is longer by that symbol


def shard_of(symbols: np.ndarray, depth: int) -> Shard:
    """``symbols`` ends with a 0; so does every string in it."""
    order = sort_shard(symbols, depth)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Shard(order, symbols[order - 1], place[order - 1])


def merge_transforms(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges the transforms of shards by refining their interleave, a symbol a round.

    The interleave says for each place of the merged order which shard its suffix is from; the
    shards' own orders fill in the rest. A round deals the places out, stably, by the symbol
    before their suffix: the interleave is then in order of one symbol more, of suffixes that
    start one earlier. Neighbours whose symbols and intervals were equal stay in one interval.
    A suffix alone in its interval shares no longer prefix with any other, nor does any that
    only adds symbols before it, so both leave; and so do suffixes that have ended.

    Returns the suffixes that share ``depth`` symbols with another, numbered shard after shard
    in the shards' orders, the interval of each, and for every suffix the longest prefix that
    it has in common with any other (``depth`` if as long as that).
    """
    transform = np.concatenate([s.transform for s in shards])
    first = np.cumsum([0, *(len(s.order) for s in shards)])
    before = np.concatenate([s.before + at for s, at in zip(shards, first[:-1], strict=True)])
    n = len(transform)
    alive = np.arange(n)
    interleave = np.repeat(np.arange(len(shards)), np.diff(first))
    interleave = interleave.astype(np.uint8 if len(shards) <= 256 else np.uint16)
    interval = np.zeros(n, np.int32)
    common = np.zeros(n, np.int32)
    longer = np.zeros(n, dtype=bool)
    for length in range(1, depth + 1):
        symbols = transform[alive]
        dealt_symbols = np.empty(len(alive), np.uint8)
        dealt_symbols[np.argsort(interleave, kind="stable")] = symbols
        dealt = np.argsort(dealt_symbols, kind="stable")
        dealt = dealt[np.count_nonzero(symbols == 0) :]  # nothing stands before a string
        interleave, dealt_symbols, interval = interleave[dealt], dealt_symbols[dealt], interval[dealt]
        parted = np.ones(len(dealt) + 1, dtype=bool)
        parted[1:-1] = (dealt_symbols[1:] != dealt_symbols[:-1]) | (interval[1:] != interval[:-1])
        shared = ~(parted[:-1] & parted[1:])
        longer[:] = False
        longer[before[alive[symbols != 0]]] = True
        alive = np.flatnonzero(longer)[shared[np.argsort(interleave, kind="stable")]]
        interval = np.cumsum(parted[:-1], dtype=np.int32)[shared]
        interleave = interleave[shared]
        common[alive] = length
        if not len(alive):
            break
    return alive, interval[np.argsort(interleave, kind="stable")], common


def first_documents(
    strings: list[bytes], least: np.ndarray, shard_symbols: int = SHARD_SYMBOLS
) -> list[np.ndarray]:
    """For each string the least document of each of its windows, over all strings given."""
    ends = np.cumsum([len(s) - WINDOW + 1 for s in strings])
    return np.split(_first_documents(strings, least, shard_symbols), ends[:-1])


def _first_documents(strings: list[bytes], least: np.ndarray, shard_symbols: int = SHARD_SYMBOLS) -> np.ndarray:
    body = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    size = np.array([len(s) for s in strings])
    begin = np.cumsum(size + 1) - (size + 1)
    # Text symbols are counted on from 1 in byte order; UTF-8 uses fewer than 255 byte values.
    values = np.flatnonzero(np.bincount(np.frombuffer(b"".join(strings), np.uint8), minlength=256))
    if len(values) > 255:
        raise ValueError("texts must be UTF-8")
    code = np.zeros(256, np.uint8)
    code[values] = np.arange(1, len(values) + 1)
    symbols = code[body]
    symbols[begin + size] = 0
    shard_number = begin // shard_symbols
    bounds = np.append(begin[_cuts(shard_number)[:-1]], len(symbols))
    shards = [shard_of(symbols[a:b], WINDOW) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    alive, interval, _ = merge_transforms(shards, WINDOW)
    start = np.concatenate([s.order + a for s, a in zip(shards, bounds[:-1], strict=True)])[alive]
    count = size - WINDOW + 1
    string = np.repeat(np.arange(len(strings)), size + 1)
    held = np.full(int(interval.max(initial=0)) + 1, _LAST, np.int64)
    np.minimum.at(held, interval, least[string[start]])
    first = least[string]  # a window that no other string holds is its own string's
    first[start] = held[interval]
    at = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
    return first[at]


def may_share(strings: list[bytes], size: np.ndarray, place: np.ndarray, of_hash: np.ndarray) -> np.ndarray:
    """Which distinct strings may have a window in common with another one; no such string is missed.

    Equal windows have their minimizer at the same offset. Those where it stands ``low`` to ``high``
    bytes in all hold ``low`` bytes before it and what the window has behind it at ``high``; two
    strings that share one of them share that core, of 44 bytes. A string with no core of another
    is left out: it is on a common minimizer by chance. A hash only lets too many through.
    """
    found = np.zeros(len(strings), dtype=bool)
    joined = b"".join(strings)
    lanes = np.ndarray((len(joined) + 1,), "<u8", np.frombuffer(joined + bytes(8), np.uint8), strides=(1,))
    begin = np.cumsum(size) - size + place
    for low in range(0, _REACH, _BAND):
        high = min(low + _BAND, _REACH) - 1
        core = WINDOW - (high - low)
        mine = np.flatnonzero((place >= low) & (place - low + core <= size))
        at = begin[mine] - low
        h = of_hash[mine]
        for k in (*range(0, core - 8, 8), core - 8):
            h = mix(h, lanes[at + k])
        order = np.argsort(h)
        edge = _cuts(h[order])
        many = np.diff(edge)
        found[mine[order]] |= np.repeat(many > 1, many)
    return found


def _resolve_strings(rows: list[dict]) -> list[tuple]:
    meta = [_unpack(r["c"], _META) for r in rows]
    numbers: dict[bytes, int] = {}
    which = []
    for r in rows:
        body, sizes = _raw(r["a"]), _unpack(r["b"], np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        which += [
            numbers.setdefault(body[a:b], len(numbers))
            for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
        ]
    which = np.array(which, dtype=np.int64)
    strings = list(numbers)
    every = np.concatenate(meta)
    least = np.full(len(strings), _LAST, np.int64)
    np.minimum.at(least, which, every["least"])
    of_hash = np.zeros(len(strings), np.uint64)
    of_hash[which] = every["hash"]
    size = np.array([len(s) for s in strings])
    place = np.zeros(len(strings), np.int64)
    place[which] = every["place"]
    # What may share a window is sorted; no other string can hold the windows of the rest.
    order = np.argsort(of_hash, kind="stable")
    order = order[may_share(strings, size, place, of_hash)[order]]
    edge = _cuts(of_hash[order])
    count = size - WINDOW + 1
    begin = np.cumsum(count) - count
    firsts = np.repeat(least, count)  # of each window the first document
    batch: list[np.ndarray] = []

    def settle() -> None:
        mine = np.concatenate(batch)
        firsts[_ranges(begin[mine], count[mine])] = _first_documents([strings[i] for i in mine], least[mine])
        batch.clear()

    held = 0
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        batch.append(order[a:b])
        held += int(size[order[a:b]].sum())
        if held >= BATCH_SYMBOLS:
            settle()
            held = 0
    if batch:
        settle()
    out, at = [], 0
    for r, m in zip(rows, meta, strict=True):
        mine = which[at : at + len(m)]
        at += len(m)
        many = count[mine]
        earlier = np.zeros(int(many.sum()) + 2, dtype=np.int8)  # a window that is not earlier on both sides
        earlier[1:-1] = firsts[_ranges(begin[mine], many)] < np.repeat(m["least"], many)
        string = np.repeat(np.arange(len(m)), many)
        parted = np.cumsum(many)[:-1]
        # Where a string begins a run begins anew.
        opens = earlier[1:-1] > earlier[:-2]
        opens[parted] = earlier[parted + 1] > 0
        closes = earlier[1:-1] > earlier[2:]
        closes[parted - 1] = earlier[parted] > 0
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        if len(first):
            string = string[first]
            zero = (np.cumsum(many) - many)[string]
            runs = np.stack([first - zero, last - zero], axis=1).astype(np.uint8)
            out.append((r["part"], r["chunk"], _RUNS, _pack(m["number"][string]), _pack(runs), b"", b""))
    return out


def _resolve_windows(rows: list[dict]) -> list[tuple]:
    one, two, least = (
        np.concatenate([_unpack(r[c], kind) for r in rows]) for c, kind in (("a", "<u8"), ("b", "<u8"), ("c", "<i8"))
    )
    order = np.lexsort((two, one))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    edge = np.append(np.flatnonzero(fresh), len(order))
    earlier = np.empty(len(order), dtype=bool)
    first = np.minimum.reduceat(least[order], edge[:-1])
    earlier[order] = np.repeat(first, np.diff(edge)) < least[order]
    out, at = [], 0
    for r in rows:
        numbers = _unpack(r["d"], np.uint32)
        flagged = numbers[earlier[at : at + len(numbers)]]
        at += len(numbers)
        if len(flagged):
            out.append((r["part"], r["chunk"], _FLAGS, _pack(flagged), b"", b"", b""))
    return out


def _resolve(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["chunk"]))
    strings = [r for r in rows if r["kind"] == _STRINGS]
    windows = [r for r in rows if r["kind"] == _WINDOWS]
    return _table((_resolve_strings(strings) if strings else []) + (_resolve_windows(windows) if windows else []))


# Cutting -----------------------------------------------------------------------------------


def _marked(chunk: Chunk, rows: list[dict], buckets: int) -> np.ndarray:
    """Which bytes of the chunk are covered by windows that an earlier document holds."""
    edge = np.zeros(chunk.texts.size + 1, np.int32)
    chunk.shared_strings([r for r in rows if r["kind"] == _SHARED], buckets)
    later = chunk.doc > chunk.least[chunk.number] if len(chunk.number) else np.zeros(0, bool)
    cold = ~chunk.hot[chunk.number] if len(chunk.number) else np.zeros(0, bool)
    np.add.at(edge, chunk.start[later & cold], 1)
    np.add.at(edge, chunk.stop[later & cold], -1)

    runs = [r for r in rows if r["kind"] == _RUNS]
    if runs:
        string = np.concatenate([_unpack(r["a"], np.uint32) for r in runs]).astype(np.int64)
        span = np.concatenate([_unpack(r["b"], np.uint8) for r in runs]).reshape(-1, 2)
        row, at = chunk.holders(~later & cold, string)
        np.add.at(edge, chunk.start[at] + span[row, 0], 1)
        np.add.at(edge, chunk.start[at] + span[row, 1] + WINDOW, -1)
    string, offset, number, _, _, least = chunk.hot_windows()
    if len(string):
        flagged = np.zeros(len(least), dtype=bool)
        for r in rows:
            if r["kind"] == _FLAGS:
                flagged[_unpack(r["a"], np.uint32)] = True
        hot = np.flatnonzero(~cold)
        low = np.searchsorted(string, chunk.number[hot], side="left")
        many = np.searchsorted(string, chunk.number[hot], side="right") - low
        which = np.repeat(hot, many)
        row = np.arange(len(which)) + np.repeat(low - (np.cumsum(many) - many), many)
        gone = (chunk.doc[which] > least[number[row]]) | flagged[number[row]]
        at = chunk.start[which[gone]] + offset[row[gone]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(buckets: int, as_text: bool):
    def run(table: pa.Table, rows: pa.Table) -> pa.Table:
        if not table.num_rows:
            raise ValueError("strings came back to a chunk without documents")
        chunk = Chunk(table)
        gone = _marked(chunk, rows.to_pylist(), buckets)
        offsets = chunk.texts.offsets
        kept, spans = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            mine = gone[a:b]
            left = chunk.texts.data[a:b][~mine].tobytes()
            kept.append(left.decode("utf-8", "ignore") if as_text else left)
            turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
            spans.append(turns.tolist())
        return pa.table(
            [
                table.column("row").take(pa.array(chunk.order)),
                pa.array(np.diff(offsets)),
                pa.array(kept, pa.string() if as_text else pa.binary()),
                pa.array(spans, pa.list_(pa.int64())),
            ],
            names=["row", "n_bytes", "kept", "spans"],
        )

    return run


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    as_text: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    hot_docs: int = HOT_DOCS,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """``row`` (the id, or the columns named in ``carry``), ``n_bytes``, ``kept`` (the bytes
    left, in order) and ``spans`` (start, end, start, end ... of the removed runs) of every row.

    Null and empty texts have no bytes; a text under 50 bytes keeps all. Rows with the same id
    are one document: they lose nothing to each other. A null id is after every other. Ids are
    integers. Columns of ``docs`` stay inside ``row``, so no name can clash. With ``as_text`` what
    is left is a string, less what remains of characters that a cut has split.
    """
    prepare(spark)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    size = min(max(chunk_bytes, total // MOST_CHUNKS), MAX_CHUNK_BYTES)
    chunks, parts = max(1, -(-total // size)), max(1, -(-total // BUCKET_BYTES))
    buckets = max(1, parts // 8)  # a minimizer takes five bytes there, a string about seventy
    row = F.struct(*(carry or [F.col(doc_id).alias("doc_id")]))
    dealt = docs.select(
        F.pmod(F.xxhash64(doc_id), F.lit(chunks)).cast("long").alias("chunk"),
        row.alias("row"),
        F.col(doc_id).cast("long").alias("id"),
        F.col(text).cast("binary").alias("text"),
    )
    kind = dealt.schema["row"].dataType.simpleString()
    by_chunk = dealt.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send_minimizers(buckets, hot_docs), _ROWS)
    shared = sent.groupBy("part").applyInArrow(_find_shared(hot_chunks), _ROWS)
    strings = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_send_strings(buckets, parts), _ROWS)
    found = strings.groupBy("part").applyInArrow(_resolve, _ROWS)
    back = shared.unionByName(found)
    return by_chunk.cogroup(back.groupBy("chunk")).applyInArrow(
        _cut(buckets, as_text),
        f"row {kind}, n_bytes long, kept {'string' if as_text else 'binary'}, spans array<long>",
    )
