"""SimHash, mixing, URL rules, page text, classifiers and the pipeline."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from html import unescape

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import html_text, mixing, quality_rank, simhash, url_filter
from basketry.llm.queries import llm_oracle, llm_queries
from basketry.llm.quality_rank import STEPS, quantile_cut, score_quality
from basketry.llm.toxicity import score_toxicity, training_rows
from check import compare, oracle_connection
from tests.conftest import SF_DIR
from tests.llm.conftest import ids_and_texts, odd_rows, prose

QUERIES = llm_queries()


# SimHash -----------------------------------------------------------------------------------


def fingerprint(text, width=3):
    words = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()).split()
    shingles = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, limit=2):
    prints = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= limit:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least: dict[int, int] = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [(i, f"{p:016x}", least.get(find(p))) for i, p in prints]


def test_classes_of_the_whole_table(spark, documents):
    got = Counter(tuple(r) for r in QUERIES["op9_simhash"](spark, SF_DIR).collect())
    assert got == Counter(classes([(i, t) for i, t, _ in documents]))


def test_classes_of_odd_rows(spark, odd, empty):
    got = Counter(tuple(r) for r in simhash.near_duplicates(spark, odd).collect())
    assert got == Counter(classes(ids_and_texts()))
    assert simhash.near_duplicates(spark, empty).count() == 0


def test_one_of_each_class_stays(spark, odd, empty):
    kept = simhash.keep_one(spark, odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    named = [c for i, _, c in classes(ids_and_texts()) if c is not None]
    assert sorted(i for i, _ in rows if i is not None) == sorted(set(named))
    assert (None, prose(100, 6)) in rows and len(rows) == len(set(named)) + 1
    assert simhash.keep_one(spark, empty).count() == 0


@pytest.mark.parametrize("limit", [0, 1, 2, 4])
def test_gray_index_finds_every_pair(limit):
    rng = np.random.default_rng(limit)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))) for b in base for _ in range(40)]
    codes = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64)]))
    index = simhash.GrayIndex(codes)
    q, at = index.within(codes, limit)
    got = set(zip(codes[q].tolist(), index.codes[at].tolist(), strict=True))
    every = {(a, b) for a in codes.tolist() for b in codes.tolist() if (a ^ b).bit_count() <= limit}
    assert got == every


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_chains_become_one_class(spark, limit):
    rng = random.Random(limit)
    chain = [rng.getrandbits(64)]
    for _ in range(60):
        step = 0
        for b in rng.sample(range(64), limit):
            step |= 1 << b
        chain.append(chain[-1] ^ step)
    signed = [(k, c - (1 << 64) if c >> 63 else c) for k, c in enumerate(dict.fromkeys(chain))]
    prints = spark.createDataFrame([(k, 0, c) for k, c in signed], "doc_id long, version long, bits long")
    assert {r["component_id"] for r in simhash.classes(prints, limit).collect()} == {0}


def test_hot_buckets_lose_no_link(spark):
    rng = random.Random(9)
    codes = {0, (1 << 64) - 1}
    while len(codes) < 1500:  # most agree in all but 14 bits, so blocks and parts are hot
        codes.add(rng.getrandbits(64) if rng.random() < 0.2 else 0x00FF00FF12340000 | rng.getrandbits(14) << rng.choice([0, 40]))
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in sorted(codes)]
    distinct = spark.createDataFrame(signed, "bits long").repartition(4)

    def roots(found):
        parent = {b: b for (b,) in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in found:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
        return {b: find(b) for (b,) in signed}

    every = [
        (a, b)
        for i, (a,) in enumerate(signed)
        for (b,) in signed[:i]
        if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    ]
    for hot_codes in (5, 400, 1 << 14):
        found = [(r["u"], r["v"]) for r in simhash.links(distinct, 2, hot_codes).collect()]
        assert roots(found) == roots(every)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_finer_masks_hold_a_part_of_every_near_pair(max_bits):
    rng = random.Random(max_bits)
    for _, mask in simhash.block_keys(max_bits):
        finer = simhash.finer_masks(mask, max_bits)
        assert all(m & mask == mask for m in finer)
        if max_bits == 2:
            assert max(64 - m.bit_count() for m in finer) <= 15
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(300):
            change = sum(1 << b for b in rng.sample(free, max_bits))
            assert any(not m & change for m in finer)


# Mixing ------------------------------------------------------------------------------------


def waterline(sizes, weights, most=3):
    """Targets by filling up, capping what is over and sharing its excess, until none is above."""
    target = {s: 0.0 for s in sizes}
    open_, left = set(sizes), float(sum(sizes.values()))
    while open_:
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, got):
    size_of = defaultdict(int)
    for _, t, s in rows:
        size_of[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(size_of, key=lambda s: (s is None, s or ""))
    want = waterline(size_of, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == size_of[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in size_of:
        assert taken[s] <= want[s] + 1e-6 and want[s] - taken[s] <= largest[s]


def test_mix_of_the_whole_table(spark, documents):
    got = QUERIES["op5_mixing"](spark, SF_DIR).collect()
    assert len(got) == len(documents)
    check_mix(documents, got)
    again = QUERIES["op5_mixing"](spark, SF_DIR).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    by_source = defaultdict(lambda: [0, 0.0])
    for r in got:
        by_source[r["source"]][0] += r["taken"]
        by_source[r["source"]][1] = r["target"]
    assert sum(t for t, _ in by_source.values()) >= 0.97 * sum(t for _, t in by_source.values())


def test_mix_of_odd_rows(spark, odd, empty):
    got = mixing.mix_documents(spark, odd).collect()
    assert len(got) == len(odd_rows())
    check_mix([(r[0], r[1], r[2]) for r in odd_rows()], got)
    assert mixing.mix_documents(spark, empty).count() == 0


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(1, "a", 10), (2, "b", 1000), (3, "c", 0), (4, None, 5), (5, "d", 400)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    size = {s: n for _, s, n in rows}
    want = waterline(size, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2})
    assert got == pytest.approx(want) and got["a"] == 30 and got["c"] == 0


def test_pareto_order_takes_documents_as_often_as_asked(spark):
    """Over many seeds the share of draws that the order puts among the first n is near p."""
    p = np.array([0.1, 0.3, 0.6, 0.9, 0.5, 0.6])
    rows = spark.range(2000).select("id", F.explode(F.array(*map(F.lit, range(len(p))))).alias("k"))
    rows = rows.withColumn("p", F.element_at(F.array(*[F.lit(float(x)) for x in p]), F.col("k") + 1))
    ranked = rows.withColumn("rank", mixing.pareto_rank(mixing.uniform("id", "k"), F.col("p")))
    first = ranked.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("rank", "k"))), 1, 3).alias("x"))
    drawn = first.select(F.explode("x.k").alias("k")).groupBy("k").count().collect()
    share = np.array([r["count"] for r in sorted(drawn)]) / 2000
    assert np.abs(share - p).max() < 0.05


# URL rules ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(llm_oracle()))
def test_query_matches_sql(spark, name):
    assert compare(spark, oracle_connection(SF_DIR), name, SF_DIR).startswith("ok")


URLS = [
    None,
    "",
    "no scheme.com/x",
    "http://",
    "HTTP://WWW.Example.COM/en/a?b#c",
    "http://example.com/en/x",
    "https://a.example.com/en/",
    "https://example.com",
    "https://notexample.com/en/y",
    "https://com/z",
    "https://x.net/es/1",
    "https://x.net/de/1?b=2&utm_source=q&a=1#f",
    "https://www.x.net:443/de/1/?a=1&b=2",
    "https://x.net/de/1?a=1&b=3",
    "https://É.net/fr/ü",
    "ftp://x.org//p://q",
    "https://y.org/" + "l" * 5000,
]


@pytest.mark.parametrize("broadcast_blocks", [1 << 17, 0])
def test_url_filter_of_odd_rows(spark, broadcast_blocks):
    rows = [(k, u, "clash") for k, u in enumerate(URLS)] + [(11, URLS[11], "clash"), (None, URLS[11], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("x.net/de/1?a=1&b=2",), ("y.org",), ("",), (None,)], "url string")
    got = {
        (r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
        for r in url_filter.filter_urls(spark, pages, listed, broadcast_blocks=broadcast_blocks).collect()
    }
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[0] == by_id[1] == by_id[2] == by_id[3] == ("", "", None, "allow")
    assert by_id[4] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert by_id[5][2:] == by_id[6][2:] == ("example.com/en/", "block")
    assert by_id[7] == ("example.com", "", None, "allow")
    assert by_id[8][2:] == by_id[9][2:] == ("com/", "allow")
    assert by_id[10][2:] == ("net/es/", "block")
    assert by_id[11][2:] == by_id[12][2:] == by_id[None][2:] == (None, "block")
    assert by_id[13][2:] == (None, "allow")
    assert by_id[14] == ("É.net", "/fr/ü", "net/fr/", "block")
    assert by_id[15] == ("x.org", "//p://q", None, "allow")
    assert url_filter.filter_urls(spark, pages.limit(0), listed).count() == 0
    assert url_filter.filter_urls(spark, pages, listed.limit(0)).where("verdict = 'block'").count() == 4


def test_filter_lets_all_listed_urls_through_and_few_others(spark):
    listed = spark.range(4000).select(F.concat(F.lit("h/"), "id").alias("url"))
    urls = spark.range(2000, 40000).select(F.concat(F.lit("h/"), "id").alias("url"))
    assert url_filter.on_list(urls, listed).count() == 2000
    blocks = 4000 // 16
    rows = url_filter.bloom_filter(listed, blocks)
    probed = urls.withColumn("block", url_filter._block(F.col("url"), blocks)).join(rows, "block")
    masks = url_filter._masks(F.col("url"))
    for k, mask in enumerate(masks):
        probed = probed.where(F.col(f"w{k}").bitwiseAND(mask) == mask)
    assert 2000 <= probed.count() < 2000 + 0.02 * 36000


def test_only_advertised_urls_of_a_listed_site_are_blocked(spark, monkeypatch):
    site = "https://spam-farm.example.org/en/"
    urls = [f"{site}{k}" + ("?utm_source=a" if k % 3 == 0 else "") for k in range(3000)]
    urls += [f"http://www.spam-farm.example.org/en/{k}/#top" for k in range(0, 3000, 6)]  # other spellings of listed URLs
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def blocked():
        found = url_filter.filter_urls(spark, pages, url_filter.site_list(pages)).where("verdict = 'block'")
        return {r["page_id"] for r in found.collect()}

    want = {*range(0, 3000, 3), *range(3000, 3500)}
    assert blocked() == want
    # A filter of so few bits that most unlisted URLs get through: the join alone decides.
    monkeypatch.setattr(url_filter, "_URLS_PER_BLOCK", 500)
    rows = url_filter.bloom_filter(url_filter.site_list(pages), 2)
    probe = pages.select(url_filter.canonical(F.col("url")).alias("url")).distinct()
    probe = probe.withColumn("block", url_filter._block(F.col("url"), 2)).join(rows, "block")
    for k, mask in enumerate(url_filter._masks(F.col("url"))):
        probe = probe.where(F.col(f"w{k}").bitwiseAND(mask) == mask)
    assert probe.count() > 2500
    assert blocked() == want
    monkeypatch.setattr(url_filter, "HASHED_URLS", 0)
    assert blocked() == want


def test_the_query_blocks_every_page_of_a_listed_site(spark, tmp_path):
    site = "https://spam-farm.example.org/en/"
    urls = [f"{site}{k}" + ("?utm_source=a" if k % 3 == 0 else "") for k in range(30)]
    urls += ["http://WWW.spam-farm.example.org:80/en/4/#top", "https://not-spam-farm.example.org/en/4", "no url", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op8_url_filter"](spark, str(tmp_path)).where("verdict = 'block'")
    assert {r["page_id"] for r in found.collect()} == set(range(31))


def test_url_filter_plan_has_no_python_and_no_pairwise_join(spark):
    plan = QUERIES["op8_url_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# Page text ---------------------------------------------------------------------------------


@pytest.mark.parametrize("sf_dir", [SF_DIR, SF_DIR.replace("0.001", "0.01"), SF_DIR.replace("0.001", "0.1")])
def test_page_text_is_the_article(spark, sf_dir):
    pages = duckdb.connect().execute(f"SELECT page_id, html FROM '{sf_dir}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in QUERIES["op4_html_text"](spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for i, html in pages:
        inner = re.search(r"<article>(.*)</article>", html, re.S).group(1)
        parts = [re.sub(r"</?b>|<br>", " ", x) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = [" ".join(unescape(x).split()) for x in parts]
        assert got[i]["text"] == "\n\n".join(x for x in want if x)
        assert got[i]["n_chars"] == len(got[i]["text"])


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &lt;text&gt; &amp; &#233;", "plain <text> & é"),
        ("<p>a<p>b <b>c</b><br>d", "a\n\nb c d"),
        ("<div class='site-header'>x</div><h1>T</h1><ul><li>a<li>b</ul>", "T\n\na\n\nb"),
        ("<main><p>a</p><div class=ad-box><p>x</p></div><aside>y</aside><p>b</p></main><p>c</p>", "a\n\nb"),
        ("<article><header><h1>T</h1></header><p>a</p><section id=comments><p>x</p></section></article>", "T\n\na"),
        ("<p>a</p><script>if (1<2) { x('</p>') }</script><style>p{}</style><!-- <p>x</p> --><p>b</p>", "a\n\nb"),
        ("<p>a</p><form><p>x</p><input></form><div hidden>y</div><p title='>'>b", "a\n\nb"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<p>unclosed <b>bold<p>next</p></article></div> tail", "unclosed bold\n\nnext\n\ntail"),
        ('<p>a <a href="x"">b</a> c</p><p title="a>b">d</p><p title=it\'s>e</p>', "a b c\n\nd\n\ne"),
        ('<p>a<script src="x>y">z</script></p><p>1 < 2 and <b', "a\n\n1 < 2 and <b"),
        ("<div role=navigation>x</div><p>a\n\t b&nbsp;c</p><script>never closed", "a b c"),
    ],
)
def test_blocks(html, text):
    blocks, main = html_text.page_blocks(html)
    assert "\n\n".join(b for b, ok in zip(blocks, main, strict=True) if ok) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p><svg width=1 /><p>b</p><p>c</p>", "a\n\nb\n\nc"),
        ("<p>a <svg><path d=x/><text>x</text></svg> b</p><p>c</p>", "a b\n\nc"),
        ("<p>a</p><svg><path d=x><p>b</p><p>c</p>", "a\n\nb\n\nc"),
        ("<svg><foreignObject><p>x</p></foreignObject></svg><p>b</p>", "b"),
        ("<svg><title/><style/></svg><p>b</p><svg><title>x</title></svg><p>c</p>", "b\n\nc"),
        ("<svg-icon name=x></svg-icon><p>b</p>", "b"),
        ("<title-bar>t</title-bar><p>b</p>", "t\n\nb"),
        ("<script-loader></script-loader><p>b</p><object-view>c</object-view>", "b\n\nc"),
        ("<object data=x><p>b</p>", "b"),
        ("<p>a</p><object data=x><p>x</p><object><p>y</p></object></object><p>b</p>", "a\n\nb"),
        ("<div><object data=x></div><p>b</p><object data=y>x</object><p>c</p>", "b\n\nc"),
        ("<p>a <object data=x> b", "a b"),
        ("<select><option>x<option>y<p>b</p>", "b"),
        ("<p>a</p><template><p>x</p></template><noscript><p>y</p></noscript><p>b</p>", "a\n\nb"),
        ("<script src=x /><p>b</p><script>x</script><p>c</p>", "b\n\nc"),
        ("<script src=x/>x</script><iframe src=y /><p>b</p>", "b"),
        ("<script>x</script foo><p>b</p><math><mi>x</mi></math><textarea>y</textarea>", "b"),
    ],
)
def test_embedded_elements_never_take_the_rest_of_the_page(html, text):
    blocks, main = html_text.page_blocks(html)
    assert "\n\n".join(b for b, ok in zip(blocks, main, strict=True) if ok) == text


@pytest.mark.parametrize("piece", ["<svg>", "<object>", "<svg><p>", "<svg><object>", "<script />", "<script></script ", "<svg><desc>", "</svg><svg>"])
def test_long_embedded_markup_is_read_in_time(piece):
    start = time.process_time()
    html_text.page_blocks(piece * (400_000 // len(piece)) + "<p>end")
    assert time.process_time() - start < 5


@pytest.mark.parametrize("piece", ["<a ", "<script ", "</ ", "<!x ", '<a "', "<a x='\"", "<div></i>", "<div><b>", "<b><div></b>", "<p><b>x", "< "])
def test_long_broken_markup_is_read_in_time(piece):
    start = time.process_time()
    html_text.page_blocks(piece * (400_000 // len(piece)) + "<p>end")
    assert time.process_time() - start < 5


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    slogan = "subscribe to our weekly letter and never miss a single story again"
    rows = []
    for k in range(700):  # several shards of one host
        rows.append((k, "http://big.org/x", f"<p>{prose(20, k)} {slogan} {prose(15, 5000 + k)}</p><p>{slogan}</p>"))
    rows += [(1000 + k, f"http://h{k}.org/", f"<p>{slogan}</p>") for k in range(5)]  # one page each: no repeats
    rows += [(2000, None, None), (2001, None, ""), (2002, "x", "<p>a</p>"), (2002, "x", "<p>a</p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = defaultdict(list)
    for r in html_text.extract_text(spark, pages).collect():
        got[r["row"]["page_id"]].append(r["text"])
    for k in range(700):
        assert got[k] == [f"{prose(20, k)} {prose(15, 5000 + k)}"]
    assert all(got[1000 + k] == [slogan] for k in range(5))
    assert got[2000] == got[2001] == [""] and got[2002] == ["a", "a"]
    assert html_text.extract_text(spark, pages.limit(0)).count() == 0


def test_boilerplate_of_part_of_a_host_goes(spark):
    shares = {"small": (60, (0.05, 0.2, 0.45)), "split": (1000, (0.06, 0.2, 0.45))}
    rows, want, number = [], {}, 0
    for host, (pages, parts) in shares.items():
        notices = {int(part * pages): prose(14, 90_000 + k) for k, part in enumerate(parts)}
        rare = prose(14, 99_000)  # on two pages of the small host, on ten of the other
        for k in range(pages):
            number += 1
            own = [prose(25, 100 + number), prose(20, 50_000 + number)]
            quote = [rare] if k % (pages // (2 if pages < 100 else 10)) == 0 else []
            extra = [text for many, text in notices.items() if (k * 7) % pages < many]
            rows.append((number, f"http://{host}.org/{k}", "".join(f"<p>{t}</p>" for t in [own[0], *extra, *quote, own[1]])))
            want[number] = "\n\n".join([own[0], *quote, own[1]])
    copied = prose(60, 98_000)
    for k in range(300):  # one article, in every shard of the host
        rows.append((10_000 + k, f"http://split.org/copy{k}", f"<nav>{prose(9, k)}</nav><p>{copied}</p>"))
        want[10_000 + k] = copied
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()}
    assert got == want


def test_versions_of_an_article_stay(spark):
    rows, want = [], {}
    for k in range(40):
        text = prose(150, 7).split()
        text[(k * 13) % 150] = text[(k * 29 + 70) % 150] = f"edit{k}"
        texts = [" ".join(text)] if k < 12 else [prose(40, 1000 + k)]
        want[k] = texts[0]
        texts += [prose(60, 8)] if k % 4 == 3 else []  # longer than the pages' own text
        rows.append((k, f"http://versions.org/{k}", "".join(f"<p>{t}</p>" for t in texts)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()} == want


@pytest.mark.parametrize("articles", [100, 480])
def test_verdicts_do_not_depend_on_shards(spark, monkeypatch, articles):
    rows, want = [], {}
    notice = prose(16, 77_000)
    for k in range(2 * articles):  # two versions of each article, a notice on a fifth of all pages
        text = prose(60, 300_000 + k // 2).split()
        text[k % 50] = f"edit{k}"
        want[k] = " ".join(text)
        rows.append((k, f"http://twins.org/{k}", f"<p>{want[k]}</p>" + (f"<p>{notice}</p>" if k % 10 < 2 else "")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")

    def texts():
        return {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()}

    for size in (64, 256, 4096):
        monkeypatch.setattr(html_text, "SHARD_PAGES", size)
        assert texts() == want
    monkeypatch.setattr(html_text, "BROADCAST_PASSAGES", 0)  # lists are joined
    assert texts() == want


def test_article_text_goes_only_where_most_pages_hold_it(spark):
    often, always = prose(12, 78_000), prose(12, 79_000)
    own = {k: prose(30, 400_000 + k) for k in range(60)}
    html = {k: f"<article><p>{own[k]}</p>{f'<p>{often}</p>' if k % 5 == 0 else ''}<p>{always}</p></article>" for k in own}
    pages = spark.createDataFrame([(k, "http://marked.org/", h) for k, h in html.items()], "page_id long, url string, html string")
    got = {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()}
    assert got == {k: own[k] + (f"\n\n{often}" if k % 5 == 0 else "") for k in own}


def test_versions_in_very_many_pages_are_dealt_over_shards(spark, monkeypatch):
    monkeypatch.setattr(html_text, "SHARD_PAGES", 16)
    base, rows, want = prose(200, 80_000).split(), [], {}
    for k in range(400):  # a third of the pages are versions of one article
        text = [*base[: k % 190], f"edit{k}", *base[k % 190 :]] if k % 3 == 0 else prose(40, 500_000 + k).split()
        want[k] = " ".join(text)
        rows.append((k, "http://hot.org/", f"<p>{want[k]}</p>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()} == want


def test_words_beside_boilerplate_stay():
    notice = list("abcdefghijkl")
    stream = {k: np.array([ord(c) for c in x]) for k, x in {"all": notice, "some": ["z", *notice]}.items()}
    found, pages = html_text.passages([stream["some" if k % 10 == 0 else "all"] for k in range(100)])
    assert sorted(pages) == [10, 100, 100, 100, 100, 100]
    token = np.array([ord(c) for c in ["x", "z", *notice, "y"]])
    assert html_text._covered(token, found, pages).tolist() == [False, False, *[True] * 12, False]


def test_one_article_under_many_addresses_stays_whole(spark):
    rows = [(k, f"http://copies.org/{k}", f"<nav>{prose(9, k)}</nav><p>{prose(60, 1)}</p>") for k in range(600)]
    rows += [(1000 + k, f"http://small.org/{k}", f"<article><p>{prose(40, 2)}</p></article>") for k in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["row"]["page_id"]: r["text"] for r in html_text.extract_text(spark, pages).collect()}
    assert got == {i: prose(60, 1) if i < 1000 else prose(40, 2) for i, _, _ in rows}


def test_suffix_groups_are_equal_runs_of_tokens():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 3, 300)
    tokens[[50, 51, 120, 299]] = -1
    for depth in (1, 2, 3, 5, 8):
        rank = html_text.suffix_groups(tokens, depth)
        inside = [k for k in range(300 - depth) if (tokens[k : k + depth] >= 0).all()]
        seen = {}
        for k in inside:
            assert seen.setdefault(tuple(tokens[k : k + depth]), rank[k]) == rank[k]
        assert len(set(seen.values())) == len(seen)


# Classifiers -------------------------------------------------------------------------------


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("name, label, cut, least", [("op7_quality_rank", "quality", 0.3, 0.97), ("op10_toxicity", "toxic", 0.5, 0.95)])
def test_held_out_accuracy(spark, name, label, cut, least):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = QUERIES[name](spark, folder).collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut) for r in got)
    asked = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in asked)
    assert right / len(asked) >= least
    some = [r["score"] for r in asked if labels[r["doc_id"]]]
    others = [r["score"] for r in asked if not labels[r["doc_id"]]]
    above = np.mean([a > b for a in some for b in others])
    assert above > 0.95


@pytest.mark.parametrize("score, label", [(score_quality, "quality"), (score_toxicity, "toxic")])
def test_scores_of_odd_rows(spark, odd, empty, score, label):
    labels = [(k, k % 2, "clash") for k in range(1, 16)] + [(None, 1, ""), (3, None, ""), (4, 7, ""), (99, 1, "")]
    labels = spark.createDataFrame(labels, f"doc_id long, {label} int, text string")
    got = score(spark, odd, labels).collect()
    assert Counter(r["row"]["doc_id"] for r in got) == Counter(r[0] for r in odd_rows())
    assert all(0 <= r["score"] <= 1 for r in got)
    unlabelled = score(spark, odd, labels.limit(0)).collect()
    assert len(unlabelled) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in unlabelled)
    assert score(spark, empty, labels).count() == 0


@pytest.mark.parametrize("score, label", [(score_quality, "quality"), (score_toxicity, "toxic")])
def test_ids_with_both_labels_are_not_learnt_from(spark, score, label):
    docs = [(k, prose(60, k) + (" # | # grisly" * 6 if k % 3 == 0 else "")) for k in range(90)]
    rows = [(k, int(k % 3 == 0)) for k, _ in docs]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    kind = f"doc_id long, {label} int"
    clear = [r for r in rows if r[0] % 4]
    want = {r["row"]["doc_id"]: r["score"] for r in score(spark, docs, spark.createDataFrame(clear, kind)).collect()}
    for seed in range(3):
        mixed = clear + [r for r in rows if r[0] % 4 == 0] + [(k, 1 - v) for k, v in rows if k % 4 == 0]
        random.Random(seed).shuffle(mixed)
        found = score(spark, docs, spark.createDataFrame(mixed, kind).repartition(seed + 1)).collect()
        assert {r["row"]["doc_id"]: r["score"] for r in found} == want


def test_quality_is_cut_at_the_share_of_bad_margins(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(2 * good, 1), good) for good in (0, 1, 1) * 400]
    cut = quantile_cut(spark.createDataFrame(rows, "margin double, label int"))
    below = sum(margin < cut for margin, _ in rows)
    near = sum(abs(margin - cut) <= 2 / STEPS for margin, _ in rows)
    assert abs(below - 400) <= near + 1
    assert quantile_cut(spark.createDataFrame([(1.5, 1), (2.5, 1)], "margin double, label int")) <= 1.5
    assert quantile_cut(spark.createDataFrame([(1.5, 0), (2.5, 0)], "margin double, label int")) > 2.5
    assert quantile_cut(spark.createDataFrame([], "margin double, label int")) == 0


def test_margins_minimise_the_pairwise_loss():
    rng = np.random.default_rng(3)
    label = (np.arange(300) % 3 > 0).astype(np.int64)
    x = rng.normal(label[:, None] * [1.5, 0.0], 1.0)
    edges, weights = quality_rank.fit(x, label)
    margin = weights[quality_rank._binned(x, edges)].sum(axis=1)

    def loss(m):
        return np.mean([np.log1p(np.exp(b - a)) for a in m[label == 1] for b in m[label == 0]])

    assert loss(margin) < loss(np.zeros(300)) and loss(margin) < 1.02 * min(loss(margin * f) for f in (0.5, 0.8, 1.25))


def test_unseen_spellings_share_pieces(spark):
    bad = ["horrid", "grisly", "vileness"]
    rng = random.Random(5)
    rows = []
    for k in range(600):
        text = prose(25, k).split()
        if k % 4 == 0:
            text.insert(rng.randrange(25), rng.choice(bad) + rng.choice(["", "s", "ly", "est", "er"]))
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    new = spark.createDataFrame(
        [(10_000, prose(20, 9001) + " horridness"), (10_001, prose(20, 9002) + " xgrisly"), (10_002, prose(20, 9003))],
        "doc_id long, text string",
    )
    found = score_toxicity(spark, docs.select("doc_id", "text").union(new), docs).collect()
    by_id = {r["row"]["doc_id"]: r["score"] for r in found}
    assert by_id[10_000] > 0.5 and by_id[10_001] > 0.5 and by_id[10_002] < 0.5


# Pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        had = {r["doc_id"]: r for r in before.collect()}
        has = docs.collect()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
            assert len({r["doc_id"] for r in has}) == len(has)
        now = {r["doc_id"]: r for r in has}
        if name == "toxicity":
            scores = score_toxicity(spark, before, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
            assert set(now) == {r["row"]["doc_id"] for r in scores if r["score"] < 0.5}
        elif name == "simhash_near_dedup":
            assert set(now) == {c for _, _, c in classes([(i, r["text"]) for i, r in had.items()])}
        elif name == "suffix_array_dedup":
            from tests.llm.test_counts_rules import cut

            for i, kept, spans in cut([(i, r["text"]) for i, r in had.items()]):
                text = kept.decode("utf-8", "ignore") if spans else had[i]["text"]
                assert (i in now) == bool(text.strip() or not spans)
                assert i not in now or (now[i]["text"], now[i]["n_chars"]) == (text, len(text))
        elif name == "benchmark_decontamination":
            from tests.llm.test_counts_rules import contamination

            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            marked = contamination([(i, r["text"]) for i, r in had.items()], items)
            assert set(now) == {i for i, *_, hit in marked if not hit}
        else:
            copies = Counter(r["doc_id"] for r in has)
            want = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(spark, before).collect()}
            assert copies == Counter({i: n for i, n in want.items() if n})
            assert all(had[r["doc_id"]]["text"] == r["text"] for r in has)
    assert corpus_pipeline.run(spark, SF_DIR).exceptAll(docs).count() == 0


def test_stages_keep_odd_rows_and_other_columns(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, empty):
            got = stage(spark, docs, SF_DIR)
            assert got.columns[: len(docs.columns)] == docs.columns, name
            rows = got.collect()
            assert len({(r["doc_id"], r["text"]) for r in rows}) <= len(odd_rows())
            assert docs is odd or not rows


def test_stages_keep_columns_named_like_their_own(spark):
    names = ["_id_hash", "_text_hash", "_copy", "id_hash", "nth", "copies", "row", "kept", "bits"]
    rows = [(k, prose(80, k), f"s{k % 2}", *range(k, k + len(names))) for k in range(6)]
    rows += [rows[0]] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF_DIR)
        assert got.columns[: len(docs.columns)] == docs.columns, name
        assert {tuple(r)[: len(docs.columns)] for r in got.collect()} <= set(rows), name


def test_repeated_rows_are_learnt_from_once(spark):
    docs = [(k, prose(60, k) + (" grisly" * 4 if k % 3 == 0 else "")) for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in docs], "doc_id long, toxic int")
    once = spark.createDataFrame(docs, "doc_id long, text string")
    often = spark.createDataFrame(docs + docs[:20] * 30, "doc_id long, text string")
    one, many = ({r["row"]["doc_id"]: r["score"] for r in score_toxicity(spark, d, labels).collect()} for d in (once, often))
    assert one == many
    assert training_rows(often, labels, "toxic", "doc_id", "text", 10)[0].count() <= 20
