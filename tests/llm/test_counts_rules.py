"""Token counts, host rules, repeats and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer, models

from basketry.llm import repeats
from basketry.llm.decontaminate import digest, drop_contaminated, mark_contaminated
from basketry.llm.host_rules import fit_prior, host_quality
from basketry.llm.queries import llm_queries
from basketry.llm.token_counts import MARK, Counter as TokenCounter, count_tokens, unigram_vocabulary
from tests.conftest import SF_DIR
from tests.llm.conftest import ids_and_texts, odd_rows, prose

QUERIES = llm_queries()


# Token counts ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return unigram_vocabulary()


def library(vocabulary):
    least = min(score for _, score in vocabulary)
    pieces = [("<unk>", 0.0), *[(f"<0x{i:02X}>", least) for i in range(256)], *vocabulary]
    return Tokenizer(models.Unigram(pieces, 0, True))


def library_count(tokenizer, text):
    marked = MARK + text.replace(" ", MARK) if text else ""
    return len(tokenizer.encode(marked, add_special_tokens=False).ids)


def test_tokens_as_the_library_counts_them(spark, vocabulary, documents):
    tokenizer = library(vocabulary)
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op1_token_counts"](spark, SF_DIR).collect()}
    assert got == {i: library_count(tokenizer, text or "") for i, text, _ in documents}


def test_tokens_of_ties_and_unknown_characters():
    rng = random.Random(4)
    # Equal scores everywhere: only the tie rule decides which path, and so how many pieces.
    pieces = {"".join(rng.choice("ab" + MARK) for _ in range(rng.randint(1, 3))) for _ in range(30)}
    pieces = [(p, -float(rng.choice([1, 2, 2, 3]))) for p in sorted(pieces) if MARK not in p.lstrip(MARK)]
    tokenizer, counter = library(pieces), TokenCounter(pieces)
    for _ in range(400):
        text = "".join(rng.choice("ab  cé") for _ in range(rng.randint(0, 25)))
        assert counter.count(text) == library_count(tokenizer, text)


def test_tokens_of_odd_rows(spark, odd, empty, vocabulary):
    tokenizer = library(vocabulary)
    got = [(r["row"]["doc_id"], r["n_tokens"]) for r in count_tokens(spark, odd).collect()]
    assert Counter(got) == Counter((i, library_count(tokenizer, t or "")) for i, t in ids_and_texts())
    assert count_tokens(spark, empty).count() == 0
    assert TokenCounter([]).count("né") == 6  # no vocabulary: bytes, the marks among them


# Repeats -----------------------------------------------------------------------------------


def cut(rows):
    """(id, bytes kept, spans) of (id, text) rows by looking up every 50-byte string."""
    first: dict[bytes, int] = {}
    order = [(10**18 if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, raw in order:
        for k in range(len(raw) - 49):
            s = raw[k : k + 50]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, i, raw in order:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < key:
                gone[k : k + 50] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        out.append((i, np.frombuffer(raw, np.uint8)[~gone].tobytes(), tuple(turns.tolist())))
    return out


def removed(df):
    return Counter((r["row"]["doc_id"], bytes(r["kept"]), tuple(r["spans"])) for r in df.collect())


def test_repeats_of_the_whole_table(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op2_repeats"](spark, SF_DIR).collect()}
    for i, kept, spans in cut([(i, t) for i, t, _ in documents]):
        raw = len((dict((d, t) for d, t, _ in documents)[i] or "").encode())
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (raw, raw - len(kept), len(spans) // 2)


@pytest.mark.parametrize("hot", [(8, 8), (1, 1), (2, 2)])
def test_repeats_of_odd_rows(spark, odd, empty, hot):
    got = repeats.remove_repeats(spark, odd, chunk_bytes=20_000, hot_docs=hot[0], hot_chunks=hot[1])
    assert removed(got) == Counter(cut(ids_and_texts()))
    assert repeats.remove_repeats(spark, empty).count() == 0


@pytest.mark.parametrize("hot", [(8, 8), (2, 2)])
def test_repeats_with_a_passage_in_a_third_of_all_documents(spark, hot):
    passage = prose(80, 99)
    rows = [
        (i, prose(30, 1000 + i) + (" " + passage if i % 3 == 0 else "") + " " + prose(20, 2000 + i % 7)) for i in range(150)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.remove_repeats(spark, docs, chunk_bytes=4_000, hot_docs=hot[0], hot_chunks=hot[1])
    assert removed(got) == Counter(cut(rows))


@pytest.mark.parametrize("parts", [1, 40])
def test_runs_of_all_messages_of_a_chunk_are_placed_at_once(monkeypatch, parts):
    """However many buckets answer, the chunk's occurrences are sorted once."""
    rng = random.Random(8)
    passages = ["".join(rng.choices("abcdefgh ", k=rng.randrange(40, 120))) for _ in range(40)]
    texts = ["".join(rng.choices(passages, k=8)).encode() for _ in range(20)]
    ids = list(range(len(texts)))
    docs = pa.table(
        [pa.array([0] * len(ids), pa.int64()), pa.array([{"doc_id": i} for i in ids]), pa.array(ids, pa.int64()), pa.array(texts, pa.binary())],
        names=["chunk", "row", "id", "text"],
    )

    def in_parts(sent, run):
        found = [run(sent.filter(pc.equal(sent["part"], part))) for part in sorted(set(sent["part"].to_pylist()))]
        return pa.concat_tables(found)

    shared = in_parts(repeats._send_minimizers(4, repeats.HOT_DOCS * 9)(docs), repeats._find_shared(8))
    back = pa.concat_tables([shared, in_parts(repeats._send_strings(4, parts)(docs, shared), repeats._resolve)])
    asked, holders = [], repeats.Chunk.holders
    monkeypatch.setattr(repeats.Chunk, "holders", lambda self, *of: asked.append(1) or holders(self, *of))
    out = repeats._cut(4, False)(docs, back).to_pylist()
    assert len(asked) == 1 and back.num_rows - shared.num_rows > parts / 2
    seen, want = set(), []
    for text in texts:
        gone = {k for a in range(len(text) - 49) if text[a : a + 50] in seen for k in range(a, a + 50)}
        want.append(bytes(c for k, c in enumerate(text) if k not in gone))
        seen |= {text[a : a + 50] for a in range(len(text) - 49)}
    assert [r["kept"] for r in out] == want


def test_merged_transforms_give_shared_prefixes_and_intervals():
    rng = random.Random(8)
    for _ in range(30):
        texts = [[rng.choice([0, 1, 2, 2]) for _ in range(rng.randint(1, 60))] + [0] for _ in range(4)]
        depth = rng.randint(1, 9)
        shards = [repeats.shard_of(np.array(t, np.uint8), depth) for t in texts]
        alive, interval, common = repeats.merge_transforms(shards, depth)
        suffixes = []
        for t, shard in zip(texts, shards, strict=True):
            suffixes += [t[at : t.index(0, at)][:depth] for at in shard.order]

        def longest(k):
            others = [s for j, s in enumerate(suffixes) if j != k]
            return max(sum(1 for n in range(1, len(s) + 1) if s[:n] == suffixes[k][:n]) for s in others)

        assert common.tolist() == [longest(k) for k in range(len(suffixes))]
        assert alive.tolist() == [k for k in range(len(suffixes)) if common[k] == depth]
        ranked = sorted(range(len(alive)), key=lambda k: interval[k])
        assert [suffixes[alive[k]] for k in ranked] == sorted(suffixes[k] for k in alive)
        assert len(set(interval.tolist())) == len({tuple(suffixes[k]) for k in alive})


def test_strings_on_a_common_minimizer_by_chance_are_not_sorted(monkeypatch):
    rng = random.Random(12)
    word = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    texts = [word(rng.randint(0, 60)) + b"the common sixteen" + word(rng.randint(0, 60)) for _ in range(300)]
    texts += [x[rng.randint(0, 40) :] + word(rng.randint(0, 30)) for x in rng.choices(texts[:40], k=40)]
    texts += [word(rng.randint(0, 30)) + x[: len(x) - rng.randint(0, 40)] for x in rng.choices(texts[:40], k=40)]
    sorted_symbols = []
    shard = repeats.shard_of
    monkeypatch.setattr(repeats, "shard_of", lambda symbols, depth: sorted_symbols.append(len(symbols)) or shard(symbols, depth))
    chunks = [pa.table({"chunk": [k], "row": [k], "id": [k], "text": [t]}) for k, t in enumerate(texts)]
    sent = pa.concat_tables([repeats._send_minimizers(1, 8)(c) for c in chunks])
    shared = repeats._find_shared(1 << 30)(sent).to_pylist()
    of = {r["chunk"]: pa.Table.from_pylist([r], sent.schema) for r in shared}
    strings = pa.concat_tables([repeats._send_strings(1, 1)(c, of.get(k, sent.slice(0, 0))) for k, c in enumerate(chunks)])
    back = repeats._resolve(strings).to_pylist() + shared
    for (k, kept, spans), chunk in zip(cut([(i, t.decode()) for i, t in enumerate(texts)]), chunks, strict=True):
        mine = pa.Table.from_pylist([r for r in back if r["chunk"] == k], sent.schema)
        got = repeats._cut(1, False)(chunk, mine).to_pylist()[0]
        assert (got["kept"], tuple(got["spans"])) == (kept, spans)
    in_bucket = sum(int.from_bytes(r["a"][:8], "little") for r in strings.to_pylist())
    assert sorted_symbols and sum(sorted_symbols) < 0.6 * in_bucket


@pytest.mark.parametrize("place", [0, 17, 34])
def test_strings_that_share_one_window_may_share(place):
    rng = random.Random(place)
    word = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    window = word(50)
    left = word(34 - place)
    strings = [window, left + window, window + word(place), left[1:] + window + word(place // 2), word(84), word(84)]
    places = np.array([place, 34, place, place + len(left[1:]), 34, 34])
    size = np.array([len(s) for s in strings])
    got = repeats.may_share(strings, size, places, np.full(len(strings), 7, np.uint64))
    assert got.tolist() == [True] * 4 + [False] * 2


def test_windows_shared_between_shards():
    rng = random.Random(3)
    for size in (60, 200, 1 << 18):
        base = bytes(rng.choice(b"ab") for _ in range(400))
        strings = sorted({base[a : a + rng.randint(50, 84)] for a in [rng.randrange(310) for _ in range(40)]})
        least = np.array([rng.randrange(100) for _ in strings])
        want: dict[bytes, int] = {}
        for s, low in zip(strings, least, strict=True):
            for k in range(len(s) - 49):
                want[s[k : k + 50]] = min(want.get(s[k : k + 50], 1000), low)
        for s, got in zip(strings, repeats.first_documents(strings, least, size), strict=True):
            assert [want[s[k : k + 50]] for k in range(len(s) - 49)] == got.tolist()


# Host rules --------------------------------------------------------------------------------


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def judged(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_host_rules_of_the_whole_table(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op3_host_rules"](spark, SF_DIR).collect()}
    fails = defaultdict(list)
    for i, text, source in documents:
        want = measures(text)
        assert judged(got[i]) == want
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        fails[source].append(got[i]["base_failed"])
    for i, _, source in documents:
        raw = sum(fails[source]) / len(fails[source])
        overall = sum(map(sum, fails.values())) / len(documents)
        assert min(raw, overall) - 1e-6 <= got[i]["host_rate"] <= max(raw, overall) + 1e-6
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["host_rate"] <= 0.5)


def test_bad_hosts_lose_good_documents_and_small_hosts_do_not(spark):
    good, bad = prose(80, 1) + " " + prose(80, 2), "too short"
    rows = [(k, bad if k % 20 else good, "bad") for k in range(100)]
    rows += [(1000 + k, good if k % 20 else bad, f"h{k % 9}") for k in range(400)] + [(5000, bad, "tiny"), (5001, good, "tiny")]
    got = host_quality(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[k] for k in range(100))
    assert all(kept[1000 + k] for k in range(400) if k % 20) and kept[5001] and not kept[5000]


def test_hosts_of_symbols_or_repeated_lines_or_odd_words_lose_all_documents(spark):
    rows = [(k, prose(120, k), f"h{k % 9}") for k in range(360)]
    rows += [(1000 + k, " ".join(f"{w}#|" for w in prose(120, k).split()), "symbols") for k in range(40)]
    lines = [f"a line of words that comes again {k}" for k in range(12)]
    rows += [(2000 + k, "\n".join([prose(130, 100 + k), *[lines[j // 2] for j in range(12)]]), "lines") for k in range(40)]
    rows += [(3000 + k, " ".join(w * 3 for w in prose(80, 200 + k).split()), "long") for k in range(40)]
    rows += [(4000, prose(120, 999) + " #" * 40, "h1")]  # one such document is not the whole host
    got = host_quality(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["host"] for r in got if not r["kept"]} == {"symbols", "lines", "long"}
    assert {r["host"] for r in got if r["kept"]} == {f"h{k}" for k in range(9)}
    rate = {r["host"]: r for r in got}
    for host, name in (("symbols", "symbol"), ("lines", "dup_line"), ("long", "word_length")):
        assert rate[host][f"host_{name}_rate"] > 0.9 and rate["h1"][f"host_{name}_rate"] < 0.1


def test_hosts_of_scripts_without_blanks_keep_their_documents(spark):
    rng = random.Random(8)
    segments = ["".join(chr(0x3041 + rng.randrange(80)) for _ in range(14)) for _ in range(4000)]
    rows = [(k, " ".join(rng.sample(segments, 80)), "jp.example") for k in range(100)]
    rows += [(1000 + k, prose(80, k), f"h{k % 4}") for k in range(100)]
    rows += [(2000 + k, " ".join("x" * 14 + str(rng.randrange(10**6)) for _ in range(80)), "codes.example") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in host_quality(spark, docs).where("kept").collect()}
    assert kept == {r[0] for r in rows if r[0] < 2000}


def test_host_rules_of_odd_rows(spark, odd, empty):
    got = host_quality(spark, odd).collect()
    assert Counter((r["doc_id"], *judged(r)) for r in got) == Counter((i, *measures(t)) for i, t in ids_and_texts())
    assert {r["host"] for r in got} == {r[2] for r in odd_rows()}
    assert host_quality(spark, empty).count() == 0
    assert fit_prior(spark.createDataFrame([], "host string, n_docs long, n_failed long")) == (0.0, 1.0)


# Decontamination ---------------------------------------------------------------------------


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination(rows, items, window=10):
    patterns = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            patterns[tuple(words[k : k + n])].add("null" if item is None else str(item))
    sizes = sorted({len(p) for p in patterns})
    for i, text in rows:
        words, hit, found = words_of(text), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in patterns:
                    hit.update(range(k, k + n))
                    found |= patterns[tuple(words[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield i, len(words), len(hit), len(found), digest, bool(hit)


def test_contamination_of_the_whole_table(spark, documents):
    got = Counter(tuple(r) for r in QUERIES["op6_decontaminate"](spark, SF_DIR).collect())
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = Counter(contamination([(i, t) for i, t, _ in documents], items))
    assert got == want and any(r[-1] for r in want)


@pytest.mark.parametrize("pass_bytes", [1 << 20, 300])
def test_contamination_of_odd_rows(spark, odd, empty, pass_bytes):
    items = [
        (1, prose(60, 3)),
        (2, "ONE"),
        (3, "one, two!"),
        (4, None),
        (5, "...,"),
        (None, "de de de de de de de de de de de"),
        (7, prose(400, 1)[:300]),
        (7, prose(400, 1)[:300]),
        (8, "日本語"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = digest(mark_contaminated(spark, odd, bench, pass_bytes=pass_bytes))
    assert Counter(tuple(r) for r in got.collect()) == Counter(contamination(ids_and_texts(), items))
    clean = Counter(i for i, *_, hit in contamination(ids_and_texts(), items) if not hit)
    left = drop_contaminated(spark, odd, bench, pass_bytes=pass_bytes)
    assert left.columns == odd.columns and Counter(r["doc_id"] for r in left.collect()) == clean
    assert mark_contaminated(spark, empty, bench).count() == 0
    none = digest(mark_contaminated(spark, odd, bench.where("item_id = 4"))).collect()
    assert not any(r["contaminated"] for r in none) and len(none) == len(odd_rows())
