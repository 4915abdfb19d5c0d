"""BPE ids and alignments of two tokenizers against the libraries and brute force."""

from __future__ import annotations

import bisect
import hashlib
import random
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import align as alignment, bpe
from basketry.llm.queries import llm_queries
from tests.conftest import SF_DIR
from tests.llm.conftest import ids_and_texts, prose

QUERIES = llm_queries()
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    " ",
    "a<|endoftext|>b <|endoftext|><|endoftext|>",
    "<|endoftext|",
    "a" * 5000,
    "ab" * 3000 + " x",
    "  \n\n a 　\x1c\x1d b",
    "日本語テキスト" * 300,
    "\x00\x01 \U0001f600 don't I'LL we'll '",
    "▁a ▁",
    "a<s>b</s> <0x0A>",
    " \n \t x  y\r\n",
]


def scrawl(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "ab c'\nsté 1٣　!é日\U0001f600՘\U00010940"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    anything = [c for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    return texts + ["".join(map(chr, rng.choices(anything, k=40))) for _ in range(n // 4)]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def plain_library():
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


# BPE ---------------------------------------------------------------------------------------


def test_query_as_the_library_encodes(spark, library, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_bpe"](spark, SF_DIR).collect()}
    for doc_id, text, _ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded.encode()))
    assert len(got) == len(documents)


def test_ids_of_odd_texts(vocabulary, library, plain_library):
    whole, plain = bpe.Bpe(vocabulary), bpe.Bpe(vocabulary, special=False)
    for text in [*HARD, *scrawl(400, 1)]:
        for mine, theirs in ((whole, library), (plain, plain_library)):
            ids = theirs.encode(text, add_special_tokens=False).ids
            found = np.frombuffer(mine.encode(text), "<u4")
            assert found.tolist() == ids, text
            assert mine.decode(found) == theirs.decode(ids, skip_special_tokens=False)


def test_letters_newer_than_the_tokenizer(vocabulary, library):
    mine = bpe.Bpe(vocabulary)
    runs = vocabulary.newer.split("\\U")[1:]  # both ends of each run
    first = [chr(int(end.rstrip("-"), 16)) for end in runs]
    for letter in first:
        text = f"a{letter}1{letter}!{letter}  {letter}\n"
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_any_ids_decode_as_in_the_library(vocabulary, library):
    rng, mine = random.Random(2), bpe.Bpe(vocabulary)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert mine.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_rank_array_and_heap_give_the_same_parts(vocabulary, monkeypatch):
    rng, mine = random.Random(3), bpe.Bpe(vocabulary)
    words = [bytes(rng.choices(b"abcest\xc3\xa9 \xe6", k=rng.randint(1, 80))) for _ in range(400)] + [b"a" * 77, b"the" * 30]
    flat = [mine.boundaries(w) for w in words]
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    assert [mine.boundaries(w) for w in words] == flat


def test_memo_turns_over(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    mine = bpe.Bpe(vocabulary)
    for seed in range(20):
        text = prose(40, seed)
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(mine.memo) <= 5 and len(mine.memo.old) <= 5


def test_new_words_are_merged_side_by_side(vocabulary, plain_library, monkeypatch):
    def alone(self, word):
        raise AssertionError("a short word merged by itself")

    texts = [t for t in [*HARD[4:], *scrawl(300, 11), prose(500, 12)] if t]
    want = [plain_library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = bpe.Bpe(vocabulary, special=False)
    newer = [bool(encoder.rare and encoder.rare(t)) for t in texts]
    got = encoder.encode_all(texts)
    assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in got] == want
    monkeypatch.setattr(bpe.Bpe, "word", alone)
    monkeypatch.setattr(bpe, "MEMO", 7)
    encoder = bpe.Bpe(vocabulary, special=False)
    short = [k for k, t in enumerate(texts) if not newer[k] and max(map(len, encoder.words(t))) < 60]
    assert len(short) > 50
    for _ in range(2):  # the second time from the memo
        assert encoder.encode_all([texts[k] for k in short]) == [got[k] for k in short]
    assert encoder.encode_all([]) == []


def test_spelled_out_classes_cut_the_same_words():
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF)
    rng = random.Random(5)
    cut, spelled = bpe.regex.compile(bpe.PATTERN).findall, bpe.spelled_words()
    texts = [every, *("a".join(every[k : k + 90]) for k in range(0, len(every), 90))]
    texts += ["".join(rng.choices(every, k=60)) for _ in range(500)]
    assert all(cut(t) == spelled(t) for t in [*texts, "  \n\n a", " \t", "don't 'll"])


def test_bpe_of_odd_rows(spark, odd, empty, library):
    tokens = bpe.encode_texts(spark, odd, BPE, keep=tuple(odd.columns))
    found = bpe.decode_ids(spark, tokens, BPE).select("row.doc_id", "row.row", "ids", "decoded").collect()
    expected = Counter()
    for doc_id, text in ids_and_texts():
        expected[doc_id, tuple(library.encode(text or "", add_special_tokens=False).ids), text or ""] += 1
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found) == expected
    assert bpe.decode_ids(spark, bpe.encode_texts(spark, empty, BPE), BPE).count() == 0


def test_decode_passes_over_unknown_ids(spark):
    rows = [(1, [64, None, -5, 99999999, 65], "kept out"), (2, None, None), (3, [], "")]
    table = spark.createDataFrame(rows, "k int, ids array<int>, decoded string")
    found = {r["k"]: r["decoded"] for r in bpe.decode_ids(spark, table, BPE).collect()}
    assert found == {1: "ab", 2: "", 3: ""}


# Alignment ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def aligner(vocabulary):
    with open(PIECES, "rb") as file:
        return alignment.Aligner(vocabulary, file.read())


@pytest.fixture(scope="module")
def brute(plain_library, aligner):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def of(text):
        """n_a, n_b, n_groups, n_links, groups, links (with repeats) of a text."""
        if not text:
            return 0, 0, 0, 0, "", []
        raw = (" " + text).encode()
        a, b = plain_library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        sizes = [[len(table[i]) for i in ids] for ids, table in ((a, aligner.a_bytes), (b, aligner.b_bytes))]
        joined = [b"".join(table[i] for i in ids) for ids, table in ((a, aligner.a_bytes), (b, aligner.b_bytes))]
        if joined != [raw, raw]:
            return 0, 0, 0, 0, "", []
        ends = [np.cumsum(x).tolist() for x in sizes]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        sides = []
        for ids, at in zip((a, b), ends):
            side = [[] for _ in cuts]
            for i, end in zip(ids, at):
                side[bisect.bisect_left(cuts, end)].append(str(i))
            sides.append(side)
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
        links, j = [], 0
        for i, (token, end) in enumerate(zip(a, ends[0])):
            begin = end - sizes[0][i]
            while ends[1][j] <= begin:
                j += 1
            k = j
            while k < len(b) and ends[1][k] - sizes[1][k] < end:
                links.append((token, b[k]))
                k += 1
        return len(a), len(b), len(groups), len(links), ";".join(groups), links

    return of


def test_slices_against_brute_force(aligner, brute):
    texts = [None, "", *HARD, *scrawl(300, 4), prose(3000, 1)]
    found = alignment.align_slice(aligner, texts)
    for i, text in enumerate(texts):
        *counts, links = brute(text)
        assert [found[k][i].as_py() for k in ("n_a", "n_b", "n_groups", "n_links", "groups")] == counts
        got = dict(zip(found["pairs"][i].as_py(), found["times"][i].as_py()))
        assert got == Counter((a << 32) + b for a, b in links)
    assert alignment.align_slice(aligner, [None, ""])["groups"].to_pylist() == ["", ""]


def expected_scores(rows, brute):
    made = [(key, brute(text)) for key, text in rows]
    documents = Counter(link for _, x in made for link in set(x[5]))
    highest = defaultdict(int)
    for (a, _), n in documents.items():
        highest[a] = max(highest[a], n)
    out = []
    for key, (n_a, n_b, n_groups, n_links, groups, links) in made:
        best = sum(documents[link] == highest[link[0]] for link in links)
        total = sum(documents[link] for link in links)
        out.append((key, n_a, n_b, n_groups, n_links, best, total, sha(groups.encode()) if n_a else ""))
    return Counter(out)


def test_query_against_brute_force(spark, documents, brute):
    got = Counter(map(tuple, QUERIES["op12_align"](spark, SF_DIR).collect()))
    assert got == expected_scores([(i, t) for i, t, _ in documents], brute)


@pytest.mark.parametrize("max_broadcast", [0, 1_000_000])
def test_scores_of_odd_rows(spark, odd, empty, brute, monkeypatch, max_broadcast):
    aligned = alignment.align(spark, odd, BPE, PIECES, keep=tuple(odd.columns))
    scored = alignment.score_links(spark, aligned, max_broadcast)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    columns = ["row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest]
    assert Counter(map(tuple, scored.select(*columns).collect())) == expected_scores(ids_and_texts(), brute)
    assert alignment.score_links(spark, alignment.align(spark, empty, BPE, PIECES)).count() == 0


def test_partial_counts_are_folded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "PARTIAL_PAIRS", 8)
    rng = random.Random(6)
    rows = [[rng.randrange(30) for _ in range(rng.randrange(6))] for _ in range(200)]
    batches = [pa.record_batch([pa.array(rows[i : i + 7], pa.list_(pa.int64()))], ["pairs"]) for i in range(0, 200, 7)]
    total = Counter()
    for batch in alignment._count_batches(iter(batches)):
        for pair, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[pair] += n
    assert total == Counter(x for row in rows for x in row)
