"""URL filters (8), in DataFrame functions only.

Rules on host and path decide first, the longest that fits. For other pages a blocked Bloom
filter of the listed canonical URLs lets possible hits through to an exact hash join with the
list, which removes the false positives.

A block has four longs; a URL's hash picks its block and two bits of each long. The filter is a
table of one row per block, built by an aggregate and sized by the list (16 bits a URL). Up to
``BROADCAST_BLOCKS`` blocks it is broadcast (40 bytes a block, a few MB); a larger one is joined
by shuffling on the block, from distinct canonical URLs, so that copies of one URL meet once.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import tune

#: (action, host and path): fixed values.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Site names whose pages make up the block list of the registered query.
LISTED_SITES = ("spam-farm", "cheap-pills", "casino-win", "free-bets", "ads-track", "adult-x")
BROADCAST_BLOCKS = 1 << 17
#: Listed URLs that one task may hold in a hash table; with more, the join is left to the planner.
HASHED_URLS = 1 << 20
_URLS_PER_BLOCK = 16
_LONGS = 4
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|$)"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://`` or url."""
    host = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``? #``."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, default port and last dot, path without last slash, then the
    query's parts in order without tracking parameters. Scheme and fragment do not count."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"\.$|^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(_TRACKING))
    kept = F.array_join(F.array_sort(parts), "&")
    return F.coalesce(F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its action, null if none fits."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(action)
    return rule, action


def _masks(url: Column) -> list[Column]:
    """What a URL sets in each long of its block: two bits."""
    bits = F.xxhash64(url, F.lit("bits"))

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * k).bitwiseOR(bit(2 * k + 1)) for k in range(_LONGS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks).cast("long"))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """One row per used block of the filter over ``listed.url`` (canonical, distinct)."""
    longs = [F.bit_or(mask).alias(f"w{k}") for k, mask in enumerate(_masks(F.col("url")))]
    return listed.groupBy(_block(F.col("url"), blocks).alias("block")).agg(*longs)


def on_list(urls: DataFrame, listed: DataFrame, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``urls`` (one column ``url``, canonical, distinct) that are on ``listed`` (same, distinct)."""
    listed_urls = listed.count()
    blocks = max(1, -(-listed_urls // _URLS_PER_BLOCK))
    filter_rows = bloom_filter(listed, blocks)
    if blocks <= broadcast_blocks:
        filter_rows = F.broadcast(filter_rows)
    probed = urls.withColumn("block", _block(F.col("url"), blocks)).join(filter_rows, "block")
    set_bits = [F.col(f"w{k}").bitwiseAND(mask) == mask for k, mask in enumerate(_masks(F.col("url")))]
    possible = probed.where(reduce(and_, set_bits)).select("url")
    # Distinct URLs spread evenly, so the count tells the size of each task's hash table.
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exact = listed.hint("shuffle_hash") if listed_urls <= HASHED_URLS * tasks else listed
    return possible.join(exact, "url", "left_semi")


def pages_of_sites(pages: DataFrame, url: str = "url", sites: tuple[str, ...] = LISTED_SITES) -> DataFrame:
    """The block list of the registered query: canonical URLs of all pages on the named sites."""
    named = reduce(or_, (host_of(F.col(url)).rlike(rf"(^|\.){re.escape(s)}\.") for s in sites))
    return pages.where(named).select(canonical(F.col(url)).alias("url")).distinct()


def site_list(pages: DataFrame, url: str = "url", sites: tuple[str, ...] = LISTED_SITES) -> DataFrame:
    """A narrower list: canonical URLs on the named sites that some page's address advertises, with
    a tracking parameter. Other pages of these sites are not on it; a page whose own address has no
    such parameter is, if another spelling of its URL has one."""
    query = F.regexp_extract(after_scheme(F.col(url)), r"^[^?#]*\?([^#]*)", 1)
    advertised = F.exists(F.split(query, "&"), lambda part: part.rlike(_TRACKING))
    return pages_of_sites(pages.where(advertised), url, sites)


def filter_urls(
    spark: SparkSession,
    pages: DataFrame,
    listed: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    broadcast_blocks: int = BROADCAST_BLOCKS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row: the rule's verdict, else block if the
    canonical URL is on ``listed`` (one column ``url``, canonical), else allow.

    A null url, or one without ``://``, has an empty host, path and canonical URL, fits no rule
    and is allowed. Repeated pages and listed URLs are as good as one. No other column is read.
    """
    tune(spark)
    wanted = listed.select("url").where("url <> ''").distinct()
    read = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    read = read.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = read.withColumn("rule", rule).withColumn("action", action)
    judged = judged.withColumn("url", F.when(F.col("rule").isNull(), canonical(F.col("_url"))).otherwise(F.lit("")))
    asked = judged.where("url <> ''").select("url").distinct()
    hits = on_list(asked, wanted, broadcast_blocks).select(F.col("url").alias("_hit"))
    # Pages a rule decides have no key to meet; they are spread by their id instead.
    key = F.when(F.col("url") == "", F.concat(F.lit("\u0000"), F.xxhash64("page_id").cast("string"))).otherwise(F.col("url"))
    found = judged.withColumn("_key", key).join(hits, F.col("_key") == F.col("_hit"), "left")
    verdict = F.coalesce("action", F.when(F.col("_hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
