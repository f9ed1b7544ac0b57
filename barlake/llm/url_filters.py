"""URL filter: host/path rules, then listed URLs through a blocked Bloom filter.

The listed canonical URLs are folded into a table of Bloom blocks (four 64-bit words
each, one bit per word and URL).  The block count is a fixed parameter, so the broadcast
side has at most ``blocks`` rows whatever the list's length; a longer list only raises
the share of possible hits.  Possible hits pass an exact hash join with the list, which
removes false positives; all other URLs are settled without a shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path, matches no
rule and no listed URL, and is allowed.  Repeated pages are judged row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import ascii_lower

# The rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKS = 1 << 16  # 256 bits each: 2 MiB of filter, under 1 % false hits up to about 1.4 million URLs
WORDS = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` / ``m.``, path without ``.html`` and closing slashes;
    scheme, query and fragment are left out.  Null when the host is empty."""
    url = F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""),
                   F.regexp_replace(F.regexp_replace(path, r"\.html\z", ""), r"/+\z", ""))
    return F.when(host != "", url)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _bloom_keys(url: Column, blocks: int) -> list[Column]:
    """Block number and one bit mask per word."""
    bits = F.xxhash64(url, F.lit("bits"))
    masks = [F.call_function("shiftleft", F.lit(1).cast("bigint"),
                             F.shiftrightunsigned(bits, 6 * w).bitwiseAND(F.lit(63)).cast("int"))
             for w in range(WORDS)]
    return [F.pmod(F.xxhash64(url), F.lit(blocks)), *masks]


def bloom_blocks(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Bloom table of a frame with a column ``listed_url``: at most ``blocks`` rows."""
    block, *masks = _bloom_keys(F.col("listed_url"), blocks)
    return (listed.where(F.col("listed_url").isNotNull())
            .select(block.alias("bloom_block"), *[m.alias(f"bloom_m{w}") for w, m in enumerate(masks)])
            .groupBy("bloom_block")
            .agg(*[F.bit_or(f"bloom_m{w}").alias(f"bloom_w{w}") for w in range(WORDS)]))


def url_filter(pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every row of ``pages`` (page_id, url).

    ``listed`` has a column ``url``; its canonical forms are the blocked URLs.  A rule
    decides first, then the list: a listed URL is blocked, any other allowed.
    """
    lh, lp = url_parts(F.col("url"))
    names = (listed.select(canonical(lh, lp).alias("listed_url"))
             .where(F.col("listed_url").isNotNull()).distinct())
    host, path = url_parts(F.col("url"))
    base = (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("key", canonical(F.col("host"), F.col("path"))))
    block, *masks = _bloom_keys(F.col("key"), blocks)
    # at most ``blocks`` rows: the bound of this broadcast is a parameter
    probed = base.withColumn("bloom_block", block).join(
        F.broadcast(bloom_blocks(names, blocks)), "bloom_block", "left")
    hit = reduce(lambda a, b: a & b, [
        F.col(f"bloom_w{w}").bitwiseAND(m) == m for w, m in enumerate(masks)])
    probed = probed.withColumn("maybe", F.coalesce(hit & F.col("key").isNotNull(), F.lit(False)))
    cols = ["page_id", "host", "path", "key"]
    settled = probed.where(~F.col("maybe")).select(*cols, F.lit(False).alias("listed"))
    exact = (probed.where(F.col("maybe")).select(*cols)
             .join(names.hint("shuffle_hash"), F.col("key") == F.col("listed_url"), "left")
             .select(*cols, F.col("listed_url").isNotNull().alias("listed")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return settled.unionByName(exact).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed")
