"""URL filter: host and path rules, and for the rest a list of canonical URLs behind a blocked Bloom filter.

A listed URL sets eight bits of one 256-bit block, two in each of its four 64-bit words; the filter is a table of blocks
(an OR over the listed URLs), so that looking at one row of it judges a page. Pages whose bits are not all set cannot
be listed and stay where they are. The others, the listed ones and few more, are moved to an exact hash join with the
list, which takes false positives out. The filter is broadcast: it has at most ``MOST_BLOCKS`` blocks whatever the list's
length. A longer list lets more pages pass to the join; no verdict depends on that.

The canonical form of a URL: scheme and fragment dropped, host in lower case without leading ``www.`` and without the
ports 80 and 443, path without slashes at its end, parameters of the query sorted and without those that only track.

Nulls, empties, ties and repeats: a URL that is null or has no ``://`` has empty host and path, fits no rule, is never
listed and is allowed; a listed null or such a URL lists nothing; repeated rows and repeated list entries are judged
alike; of two fitting rules of one length the one with the longer host wins; an empty list lists nothing; an empty
table gives no rows. The columns ``host, path, rule, listed, verdict`` are added; columns of ``pages`` with these names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import lower_ascii, read_table, written

#: (verdict, host, path); a policy written by hand, so its length is bounded.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
MOST_RULES = 500
#: Parameters that say where a visitor came from and not what the page is.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$"
#: Words of host names that put a page's URL on the list of ``op13_bloom_urls``.
FLAGGED = ["adult", "ads", "bets", "casino", "pills", "spam"]
KEY_BITS, BLOCK_BITS, WORDS, PROBES, MOST_BLOCKS = 12, 256, 4, 8, 1 << 20


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, in lower case."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The canonical form (see above); null where there is no ``://``."""
    rest = _rest(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    told = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(rest.isNotNull(), F.concat(host, path, F.when(F.size(told) > 0, F.concat(F.lit("?"), F.array_join(told, "&"))).otherwise("")))


def rule_of(host: Column, path: Column, rules: list) -> Column:
    """(rule, verdict) of the longest rule whose host is ``host`` or a domain above it and whose path begins ``path``; else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules; list URLs instead")
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _words(key: Column) -> list[Column]:
    """The bits of a key in each word of its block: two a word."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))
    return [bit(w).bitwiseOR(bit(w + WORDS)) for w in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom(keys: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """The filter of ``n`` keys as rows (block, w0 to w3), and its number of blocks."""
    blocks = max(1, min(MOST_BLOCKS, -(-n * KEY_BITS // BLOCK_BITS)))
    bits = keys.select(_block(F.col(key), blocks).alias("__rl_block"), *[w.alias(f"__rl_w{i}") for i, w in enumerate(_words(F.col(key)))])
    return bits.groupBy("__rl_block").agg(*[F.bit_or(f"__rl_w{i}").alias(f"__rl_w{i}") for i in range(WORDS)]), blocks


def possible(rows: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``__rl_maybe``: false only where ``key`` was not among the filter's keys. No row moves."""
    both = rows.withColumn("__rl_block", _block(F.col(key), blocks)).join(F.broadcast(filter_), "__rl_block", "left")
    held = F.lit(True)
    for i, w in enumerate(_words(F.col(key))):
        held = held & (F.col(f"__rl_w{i}").bitwiseAND(w) == w)
    return both.withColumn("__rl_maybe", F.coalesce(held, F.lit(False))).drop("__rl_block", *[f"__rl_w{i}" for i in range(WORDS)])


def listed_pages(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """``rows`` with ``listed``: whether ``key`` is in ``listed.url``, a table of canonical URLs without repeats.

    Only pages that the filter lets pass are shuffled. A page that is often met is one hot key of that join; the list is a
    written table, so that both sides are shuffled and AQE can split it.
    """
    filter_, blocks = bloom(listed, "url", listed.count())
    marked = possible(rows, key, filter_, blocks)
    sure = marked.filter(~F.col("__rl_maybe")).drop("__rl_maybe").withColumn("listed", F.lit(False))
    names = listed.select(F.col("url").alias("__rl_url"))
    maybe = marked.filter("__rl_maybe").drop("__rl_maybe").join(names.hint("shuffle_hash"), F.col(key) == F.col("__rl_url"), "left")
    return sure.unionByName(maybe.withColumn("listed", F.col("__rl_url").isNotNull()).drop("__rl_url"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, the rule that fits, whether the URL is listed (``listed``: a column of URLs), and the verdict.

    The verdict is the rule's; without a rule a listed URL is blocked and any other allowed. ``listed`` is judged for all pages.
    """
    u = F.col(url).cast("string")
    entries = listed.select(canonical(F.col(listed.columns[0]).cast("string")).alias("url")).filter(F.col("url").isNotNull()).distinct()
    rows = pages.withColumns({"__rl_key": canonical(u), "__rl_host": host_of(u), "__rl_path": path_of(u)})
    rows = rows.withColumn("__rl_rule", rule_of(F.col("__rl_host"), F.col("__rl_path"), RULES if rules is None else rules))
    both = listed_pages(rows.drop("listed"), "__rl_key", written(entries, "listed-urls"))
    verdict = F.coalesce(F.col("__rl_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    new = {"host": F.col("__rl_host"), "path": F.col("__rl_path"), "rule": F.col("__rl_rule.rule"), "verdict": verdict}
    return both.withColumns(new).drop("__rl_key", "__rl_host", "__rl_path", "__rl_rule")


def flagged(pages: DataFrame, words: list | None = None, url: str = "url") -> DataFrame:
    """The URLs whose host has one of ``words`` as a part between dots and hyphens."""
    named = rf"(^|[.-])({'|'.join(FLAGGED if words is None else words)})([.-]|$)"
    return pages.filter(host_of(F.col(url)).rlike(named)).select(F.col(url).alias("url"))


def op13_bloom_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every page's host, path, rule and verdict; listed are the URLs of hosts with a flagged word."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, flagged(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


OP13_SQL = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$'))) AS told
  FROM cut
), named AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(path, '/+$', '') || CASE WHEN len(told) > 0 THEN '?' || array_to_string(told, '&') ELSE '' END END AS key
  FROM parts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hosts AS (SELECT DISTINCT host, path FROM named),
fit AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path
), listed AS (
  SELECT DISTINCT key FROM named WHERE key IS NOT NULL AND regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)')
)
SELECT page_id, n.host, n.path, f.rule, coalesce(f.verdict, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.key IS NOT NULL AS listed
FROM named n LEFT JOIN fit f ON n.host = f.host AND n.path = f.path LEFT JOIN listed l ON n.key = l.key
"""
