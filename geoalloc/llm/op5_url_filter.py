"""URL filter: a blocked Bloom filter of listed canonical URLs before an exact hash join.

The filter has one 64-bit word for each block; a URL's hash names its block and four bits
there. The table of words is of fixed greatest size, so it is broadcast; only URLs whose bits
are all set go on to the exact join with the list, which removes false hits. A longer list
than the filter was made for raises the share that goes on, never the result. Rules of host
and path prefix come first. All of it is native expressions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MOST_BLOCKS, KEYS_PER_BLOCK, BITS = 1 << 18, 4, 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` and path without closing slashes; null for no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", "")))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def mask_of(key: Column) -> Column:
    bits = F.xxhash64(F.lit("bits"), key)
    out = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """``block, word``: at most ``blocks`` rows for the column ``key``."""
    return keys.groupBy(block_of(F.col("key"), blocks).alias("block")).agg(F.bit_or(mask_of(F.col("key"))).alias("word"))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; nulls where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, prefix, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(prefix))
        text, verdict = F.when(fits, rule_host + prefix).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages``.

    ``listed`` names URLs to block; both sides are compared in canonical form. A null URL, or
    one without ``://``, has an empty host and path, fits no rule and is never listed: allowed.
    Repeated rows and null ids are judged row by row. Empty lists and tables are allowed, other
    columns not read. ``rules`` is a short fixed list; of rules of equal length the later wins.
    """
    keys = listed.select(canonical(host_of(F.col(listed_col)), path_of(F.col(listed_col))).alias("key")).where("key is not null").distinct()
    blocks = min(MOST_BLOCKS, 1 << max(4, (keys.count() // KEYS_PER_BLOCK).bit_length()))
    words = F.broadcast(bloom_filter(keys, blocks))  # at most MOST_BLOCKS rows of two longs
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("key", canonical(F.col("host"), F.col("path")))
    tested = rows.join(words, block_of(F.col("key"), blocks) == F.col("block"), "left")
    may = F.coalesce(F.col("word").bitwiseAND(mask_of(F.col("key"))) == mask_of(F.col("key")), F.lit(False))
    tested = tested.withColumn("may", may).drop("block", "word")
    hits = tested.where("may").join(keys.withColumn("listed", F.lit(True)), "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = tested.where("not may").withColumn("listed", F.lit(False))
    both = hits.unionByName(rest)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return both.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """All pages; listed are the URLs of pages under a non-commercial licence."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, pages.where(F.contains("html", F.lit("CC BY-NC"))).select("url"))


SQL = """
with parts as (
  select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
split as (
  select page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
keyed as (
  select *, case when host <> '' then regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') end as key from split),
ruled as (
  select *, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule,
    coalesce(key in (select key from keyed where contains(html, 'CC BY-NC') and key is not null), false) as listed from keyed)
select page_id, host, path, rule, listed,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' when rule is not null then 'allow'
    when listed then 'block' else 'allow' end as verdict
from ruled
"""
