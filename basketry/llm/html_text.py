"""HTML extraction (4): page blocks, and a suffix array per host that finds its boilerplate.

A page becomes text blocks. Scripts, styles, menus, headers outside the article, footers,
sidebars, notices, adverts, forms and reader comments are no part of the main text, by tag,
role, class or id; if a page has an article or main element, only what is inside counts.

The main texts of one host's pages are then one token stream. Its suffix array, sorted by
prefix doubling to ``REPEAT_TOKENS`` tokens, brings equal passages together; a passage that
``MIN_SHARE`` of the host's pages (three at least) hold is boilerplate, and the tokens that such
passages cover leave the main text. What runs remain of a block stay. Inside an article or main
element the markup says that a text is no boilerplate: from there only passages go that
``MOST_SHARE`` of the host's pages hold.

Pages with the same main text count as one: an article served under many addresses is no
boilerplate. Neither are versions of an article: pages of which such passages leave less than
``OWN_SHARE`` count only where a passage is on ``MOST_SHARE`` of all.

Three bytes a token are shuffled, to shards of about ``SHARD_PAGES`` pages of a host, which name
the passages that may be boilerplate; those are counted over the whole host. The pages, read
again, lose what their host's list holds, so no host meets in one task, however large.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.texts import mix, prepare, slices
from basketry.llm.url_filter import host_of

SHARD_PAGES = 256
REPEAT_TOKENS = 8
MIN_SHARE = 0.05
MOST_SHARE = 0.5
OWN_SHARE = 0.25
MIN_PAGES = 3
BROADCAST_HOSTS = 50_000
BROADCAST_PASSAGES = 1_000_000

# A quote opens a value only after "=", no tag reaches into the next one, and nothing is tried
# twice: markup broken in any way is read in time that grows with its length. Only raw text runs
# to its end tag or the end of the page; "/>" closes it if its next tag is not an end tag.
_ATTRS = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^<>]|<(?![a-zA-Z/!?]))*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>script|style|textarea|iframe|title|xmp|noembed|noframes)(?=[\s/>])"
    rf"{_ATTRS}>(?:(?<=/>)(?!(?:(?!</?(?P=raw)[\s/>]).)*+</)|.*?(?:</(?P=raw)(?:[\s/][^<>]*+)?+>|\Z))"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRS})>"
    r"|<[!?/][^<>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul hr".split()
)
_DROPPED = frozenset("nav footer aside form button menu dialog head select option fieldset".split())
_MAIN = frozenset(("article", "main"))
#: Elements that are no text as a whole, found by their own start and end tags.
_EMBEDDED = frozenset("svg math object select noscript template".split())
_EMBEDDED_START = re.compile(rf"<(?:{'|'.join(sorted(_EMBEDDED))})(?=[\s/>])", re.IGNORECASE)
_FOREIGN = frozenset(("svg", "math"))
#: Inside of these a block is part of the drawing or formula around it; elsewhere it ends that.
_HOLDS_BLOCKS = frozenset(("foreignobject", "desc", "annotation-xml", "mtext"))
#: Elements an unclosed one of the same kind ends at.
_ENDS_ITSELF = {
    "p": _BLOCK,
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
}
_MARK = re.compile(
    r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""",
    re.IGNORECASE,
)
_UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc "
    "header masthead topbar footer bottombar copyright colophon "
    "sidebar side aside rail widget widgets related recommended recommendations trending popular "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup "
    "login search share sharing social follow "
    "comment comments commentlist respond reply replies disqus discussion reactions form "
    "hidden skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
_SPACE = re.compile(r"\s+")


def _unwanted(tag: str, attrs: str, in_main: bool) -> bool:
    if tag in _DROPPED or (tag == "header" and not in_main):
        return True
    if not attrs:
        return False
    for m in _MARK.finditer(attrs):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=\d)", "-", value))
            if {"article", "entry", "post"}.intersection(words):
                words = [w for w in words if w != "header"]  # the heading of the article itself
            if not _UNWANTED.isdisjoint(words):
                return True
    return False


def _embedded_ends(html: str) -> dict[int, int]:
    """Where each embedded element starts, and where the page goes on after it.

    A block ends a drawing or formula, as in browsers. An element that is never closed ends at
    the next block's tag, and holds nothing if no block follows.
    """
    ends: dict[int, int] = {}
    opened: list[tuple[str, int, int]] = []  # element, start, end of its tag
    open_now: Counter[str] = Counter()
    next_block: dict[int, int] = {}
    fresh: list[int] = []  # starts that no block's tag has followed yet

    def close() -> tuple[str, int, int]:
        element = opened.pop()
        open_now[element[0]] -= 1
        return element

    for m in _TOKEN.finditer(html):
        if m.group("tag") is None:
            continue
        tag = m.group("tag").lower()
        if tag in _BLOCK and tag != "option":
            next_block.update((start, m.start()) for start in fresh)
            fresh.clear()
            while not m.group("close") and opened and opened[-1][0] in _FOREIGN:
                ends[close()[1]] = m.start()
        elif m.group("close"):
            while open_now[tag]:
                element = close()
                ends[element[1]] = m.end()
                if element[0] == tag:
                    break
        elif (tag in _EMBEDDED or (opened and tag in _HOLDS_BLOCKS)) and not m.group("attrs").endswith("/"):
            opened.append((tag, m.start(), m.end()))
            open_now[tag] += 1
            fresh.append(m.start())
    ends.update((start, next_block.get(start, end)) for _, start, end in opened)
    return ends


def page_blocks(html: str) -> tuple[list[str], list[bool]]:
    """Visible text blocks in page order, and whether each may be main text."""
    blocks, wanted = _blocks(html)
    any_main = any(ok and main for ok, main in wanted)
    return blocks, [ok and (main or not any_main) for ok, main in wanted]


def _main_blocks(html: str) -> tuple[list[str], bool]:
    """The main text's blocks, and whether an article or main element marks them as such."""
    blocks, wanted = _blocks(html)
    marked = any(ok and main for ok, main in wanted)
    return [b for b, (ok, main) in zip(blocks, wanted, strict=True) if ok and (main or not marked)], marked


def _blocks(html: str) -> tuple[list[str], list[tuple[bool, bool]]]:
    """Visible text blocks in page order; of each whether it is wanted, and whether it is in an article or main."""
    blocks: list[str] = []
    wanted: list[tuple[bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, unwanted from here on, inside main
    open_now: Counter[str] = Counter()  # of each element, how many are on the stack
    parts: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        if text:
            blocks.append(text)
            _, out, main = stack[-1] if stack else ("", False, False)
            wanted.append((not out, main))

    def close() -> str:
        tag = stack.pop()[0]
        open_now[tag] -= 1
        return tag

    at = 0
    embedded = _embedded_ends(html) if _EMBEDDED_START.search(html) else {}
    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue  # inside an embedded element
        parts.append(html[at : m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _EMBEDDED:
            at = embedded.get(m.start(), at)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if m.group("close"):
            # An inline end tag never ends a block around it.
            if open_now[tag] and (
                tag in _BLOCK or next(s[0] for s in reversed(stack) if s[0] == tag or s[0] in _BLOCK) == tag
            ):
                while close() != tag:
                    pass
            continue
        if tag in _VOID or m.group("attrs").endswith("/"):
            continue
        if tag in _BLOCK:
            while stack and (stack[-1][0] not in _BLOCK or tag in _ENDS_ITSELF.get(stack[-1][0], ())):
                if stack[-1][0] not in _BLOCK and not any(open_now[e] for e, ends in _ENDS_ITSELF.items() if tag in ends):
                    break
                close()
        _, out, main = stack[-1] if stack else ("", False, False)
        out = out or _unwanted(tag, m.group("attrs"), main)
        stack.append((tag, out, main or tag in _MAIN))
        open_now[tag] += 1
    parts.append(html[at:])
    flush()
    return blocks, wanted


def _tokens(blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks in order as 24-bit numbers, and how many each block has."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, texts in slices(pa.array(blocks, pa.string())):
        words = texts.words()
        hashes.append(words.hashes())
        counts.append(words.counts())
    return (np.concatenate(hashes) >> np.uint64(40)).astype(np.uint32), np.concatenate(counts)


def _packed(token: np.ndarray) -> bytes:
    return np.ascontiguousarray(token, "<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(tokens: bytes) -> np.ndarray:
    out = np.zeros((len(tokens) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(tokens, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def _stream_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Main texts as tokens, with a hash of them; of copies that one task meets, one goes on."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        main = [_main_blocks(html or "")[0] for html in batch.column(1).to_pylist()]
        token, per_block = _tokens([b for blocks in main for b in blocks])
        bounds = np.concatenate([[0], np.cumsum(per_block)])[np.cumsum([0, *map(len, main)])]
        rows = []
        for k, (host, shards) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2)), strict=True)):
            tokens = _packed(token[bounds[k] : bounds[k + 1]])
            article = int.from_bytes(blake2b(tokens, digest_size=8).digest(), "little", signed=True)
            if (host, article) not in seen:
                seen.add((host, article))
                rows.append((host, shards, article % shards, article, tokens))
        kinds = [pa.int64()] * 4 + [pa.binary()]
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["host", "shards", "shard", "article", "tokens"])


def suffix_groups(tokens: np.ndarray, depth: int) -> np.ndarray:
    """For each position the rank of its suffix by its first ``depth`` tokens.

    Prefix doubling: ranks by 2k tokens come from sorting pairs of ranks by k. Token -1 ends a
    page and equals nothing.
    """
    n = len(tokens)
    ends = tokens < 0
    _, rank = np.unique(tokens, return_inverse=True)
    rank = np.where(ends, rank.max(initial=0) + 1 + np.cumsum(ends), rank).astype(np.int64)
    known = 1
    while known < depth:
        step = min(known, depth - known)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        order = np.lexsort((after, rank))
        new = np.ones(n, dtype=bool)
        new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        known += step
    return rank


def _inside(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens are in a passage that begins at one of the starts."""
    hit = np.zeros(n + 1, dtype=np.int64)
    hit[starts] += 1
    hit[starts + REPEAT_TOKENS] -= 1
    return np.cumsum(hit[:-1]) > 0


def passages(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The passages of some pages' tokens: hash, and pages that hold it."""
    token = np.concatenate([np.append(p.astype(np.int64), -1) for p in pages])
    if len(token) < REPEAT_TOKENS:
        return (np.zeros(0, np.int64),) * 2
    page = np.repeat(np.arange(len(pages)), [len(p) + 1 for p in pages])
    ends = np.concatenate([[0], np.cumsum(token < 0)])
    starts = np.flatnonzero(ends[REPEAT_TOKENS:] == ends[:-REPEAT_TOKENS])
    rank = suffix_groups(token, REPEAT_TOKENS)[starts]
    pair = np.unique(rank * np.int64(len(pages)) + page[starts])
    holders = np.bincount(pair // len(pages), minlength=int(rank.max(initial=0)) + 1)
    which, first = np.unique(rank, return_index=True)
    return _passage_hashes(token)[starts[first]], holders[which]


def _passage_hashes(token: np.ndarray) -> np.ndarray:
    """A hash of the passage at each position that has enough tokens after it."""
    n = max(len(token) - REPEAT_TOKENS + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(REPEAT_TOKENS):
        h = mix(h, token[k : k + n].astype(np.uint64))
    return h.view(np.int64)


def _shards(rows: Iterator[tuple]) -> Iterator[tuple[int, int, list[tuple]]]:
    """(host, its shards, distinct articles) of every shard of a task, whose rows are in order of
    host, shard and article; copies come once from each task that met them."""
    for (host, shards, _), group in groupby(rows, key=itemgetter(0, 1, 2)):
        yield host, shards, [next(copies) for _, copies in groupby(group, key=itemgetter(3))]


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages that a share of ``MIN_SHARE`` of a shard's articles holds; a row without passage has their number."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for host, shards, articles in _shards(rows):
        found, pages = passages([_unpacked(row[4]) for row in articles])
        least = MIN_SHARE * len(articles)
        told = found[pages >= (max(MIN_PAGES, least) if shards == 1 else least)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([host] * (len(told) + 1), pa.int64()),
                pa.array([None, *told.tolist()], pa.int64()),
                pa.array([len(articles)] + [0] * len(told), pa.int64()),
            ],
            ["host", "passage", "articles"],
        )


class _Lists:
    """Passages by host, in order: for each its pages, and whether it goes from marked articles too."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("host", "ascending"), ("passage", "ascending")])
        hosts, self.first = np.unique(rows.column("host").to_numpy(), return_index=True)
        self.place = {host: k for k, host in enumerate(hosts.tolist())}
        self.first = np.append(self.first, len(rows))
        self.columns = [rows.column(c).to_numpy() for c in ("passage", "pages", "strong")]

    def of(self, host: int) -> tuple[np.ndarray, ...] | None:
        k = self.place.get(host)
        return None if k is None else tuple(c[self.first[k] : self.first[k + 1]] for c in self.columns)


def _list_of(shared, batch: pa.RecordBatch):
    """How to find the list of a row's host, which is broadcast or joined to the row."""
    if shared is not None:
        hosts = batch.column("host").to_pylist()
        return lambda k: shared.value.of(hosts[k])
    lists = batch.column("passages")

    def joined(k: int) -> tuple[np.ndarray, ...] | None:
        found = lists[k].values
        if found is None:
            return None
        columns = [found.field(c).to_numpy(zero_copy_only=False) for c in ("passage", "pages", "strong")]
        order = np.argsort(columns[0])
        return tuple(c[order] for c in columns)

    return joined


def _hits(hashes: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash its place among the passages (in order), and whether it is one of them."""
    at = np.minimum(np.searchsorted(passage, hashes), len(passage) - 1)
    return at, passage[at] == hashes


def _hold_batches(voters: bool):
    """(host, passage, n): how many articles of a shard hold each listed passage; or only those with
    text of their own, of which listed passages leave ``OWN_SHARE`` at least."""

    def job(shared):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                listed = _list_of(shared, batch)
                columns = (batch.column(c).to_pylist() for c in ("host", "shards", "shard", "article", "tokens"))
                for k, row in enumerate(zip(*columns, strict=True)):
                    yield *row, listed(k)

        def held(article: tuple) -> np.ndarray:
            token, mine = _unpacked(article[4]), article[5]
            hashes = _passage_hashes(token)
            hit = _hits(hashes, mine[0])[1]
            own = len(token) - _inside(np.flatnonzero(hit), len(token)).sum()
            return np.unique(hashes[hit]) if not voters or own >= OWN_SHARE * len(token) else hashes[:0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for host, _, articles in _shards(rows(batches)):
                found = [held(article) for article in articles if article[5] is not None]
                if found:
                    passage, n = np.unique(np.concatenate(found), return_counts=True)
                    columns = [np.full(len(n), host), passage, n]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["host", "passage", "n"])

        return run

    return job


def _covered(token: np.ndarray, passage: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """Tokens inside a listed passage.

    A passage less than half as frequent as one it shares tokens with is that one and a word that
    happens to stand beside it often.
    """
    hashes = _passage_hashes(token)
    if not len(hashes) or not len(passage):
        return np.zeros(len(token), dtype=bool)
    order = np.argsort(passage)
    at, hit = _hits(hashes, passage[order])
    if not hit.any():
        return np.zeros(len(token), dtype=bool)
    holders = np.where(hit, pages[order][at], 0)
    # The greatest of the 15 positions around each, by doubling.
    around, reach = np.pad(holders, REPEAT_TOKENS - 1), 1
    while reach < 2 * REPEAT_TOKENS - 1:
        step = min(reach, 2 * REPEAT_TOKENS - 1 - reach)
        around = np.maximum(around[:-step], around[step:])
        reach += step
    return _inside(np.flatnonzero(hit & (2 * holders >= around)), len(token))


def _main_text(blocks: list[str], boilerplate: tuple[np.ndarray, np.ndarray] | None) -> str:
    """Main blocks of a page, less the tokens that its host's boilerplate covers."""
    if boilerplate is None:
        return "\n\n".join(blocks)
    token, per_block = _tokens(blocks)
    gone = _covered(token, *boilerplate)
    at, kept = 0, []
    for text, n in zip(blocks, per_block, strict=True):
        off = gone[at : at + n]
        at += n
        if not off.any():
            kept.append(text)
        elif not off.all():
            kept.append(b" ".join(w for w, out in zip(text.encode().split(), off, strict=True) if not out).decode())
    return "\n\n".join(kept)


def _text_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed, texts = _list_of(shared, batch), []
            for k, html in enumerate(batch.column("html").to_pylist()):
                blocks, marked = _main_blocks(html or "")
                mine = listed(k) if blocks else None
                if mine is not None:
                    passage, pages, strong = mine
                    mine = (passage[strong], pages[strong]) if marked else (passage, pages)
                    mine = mine if len(mine[0]) else None
                texts.append(_main_text(blocks, mine))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return run


def _with_lists(spark: SparkSession, rows: DataFrame, listed: DataFrame, job, kind: str, order=()) -> DataFrame:
    """``rows`` (with a host) through ``job``, which knows the lists of the hosts: 17 bytes a passage are
    broadcast up to ``BROADCAST_PASSAGES``, more are joined, and the rows dealt and put in ``order`` again."""
    if listed.count() <= BROADCAST_PASSAGES:
        return rows.mapInArrow(job(spark.sparkContext.broadcast(_Lists(listed.toArrow()))), kind)
    lists = listed.groupBy("host").agg(F.collect_list(F.struct("passage", "pages", "strong")).alias("passages"))
    joined = rows.join(lists, "host", "left")
    if order:
        joined = joined.repartition(*order[:-1]).sortWithinPartitions(*order)
    return joined.mapInArrow(job(None), kind)


def host_boilerplate(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``host``, ``passage``, ``pages``, ``strong``: the boilerplate of each host that has any.

    A passage that a share of all articles holds has that share in a shard at least, so what no
    shard names is none. What one names is counted over the whole host, and then once more over
    the pages with text of their own; so the verdict does not depend on how pages are dealt.
    """
    large = pages.groupBy("host").count().where(F.col("count") > SHARD_PAGES)
    large = large.select("host", F.ceil(F.col("count") / SHARD_PAGES).alias("shards")).checkpoint(eager=True)
    if large.count() <= BROADCAST_HOSTS:  # 16 bytes a host
        large = F.broadcast(large)
    known = pages.join(large, "host", "left").select("host", "html", F.coalesce("shards", F.lit(1).cast("long")).alias("shards"))
    order = ("host", "shards", "shard", "article")
    streams = known.mapInArrow(_stream_batches, "host long, shards long, shard long, article long, tokens binary")
    # A shard is in one partition, its rows together, and stays so: the tokens are shuffled once.
    streams = streams.repartition(*order[:-1]).sortWithinPartitions(*order).checkpoint(eager=True)
    named = streams.mapInArrow(_candidate_batches, "host long, passage long, articles long")
    named = named.groupBy("host", "passage").agg(F.sum("articles").alias("articles")).checkpoint(eager=True)
    hosts = named.where("passage IS NULL").select("host", "articles")
    named = named.where("passage IS NOT NULL").select("host", "passage", F.lit(0).alias("pages"), F.lit(False).alias("strong"))

    def count(listed: DataFrame, name: str, voters: bool) -> DataFrame:
        kind = "host long, passage long, n long"
        held = _with_lists(spark, streams, listed, _hold_batches(voters), kind, order)
        return held.groupBy("host", "passage").agg(F.sum("n").alias(name))

    least, most = (F.greatest(F.lit(MIN_PAGES), F.lit(s) * F.col("articles")) for s in (MIN_SHARE, MOST_SHARE))
    often = count(named, "pages", voters=False).join(hosts, "host").where(F.col("pages") >= least)
    often = often.withColumn("strong", F.col("pages") >= most).checkpoint(eager=True)
    listed = often.join(count(often, "voters", voters=True), ["host", "passage"], "left")
    listed = listed.where(F.col("strong") | (F.col("voters") >= least))
    return listed.select("host", "passage", "pages", "strong").checkpoint(eager=True)


def extract_text(
    spark: SparkSession, pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``row`` (page_id, url), main ``text`` of every page.

    Null and empty html give an empty text; a null url is on the host without a name. Broken
    markup is read as far as it goes. Repeated rows are pages each. Very long pages are read whole, one at
    a time; an empty table gives no rows. No order decides, so there are no ties. Other columns are not read.
    """
    prepare(spark)
    host = F.coalesce(host_of(F.col(url)), F.lit(""))
    row = F.struct(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    read = pages.select(row.alias("row"), F.xxhash64(host).alias("host"), F.col(html).alias("html"))
    listed = host_boilerplate(spark, read.select("host", "html"))
    kind = read.schema["row"].dataType.simpleString()
    return _with_lists(spark, read, listed, _text_batches, f"row {kind}, text string")
