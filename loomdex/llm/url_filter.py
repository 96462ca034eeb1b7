"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of blocks of four 64-bit words; a listed URL sets one bit in each word of its
block. URLs that miss a bit are certainly unlisted. Those that pass go to an exact join on the canonical
URL, which removes the false positives. The filter is broadcast: its size has a fixed upper bound
(`max_blocks` blocks of 32 bytes), beyond which only the share of false positives grows.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed;
repeated urls are judged alike; an empty list blocks nothing; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm import bloom

#: (host, path, verdict): fits the host and its subdomains where the path starts alike; the longest wins.
Rule = tuple[str, str, str]


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty if there is none."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower_ascii(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host without `www.`, path without closing slashes, query without campaign parameters; no scheme, no fragment."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))), "&")
    return F.concat(host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def rule_verdict(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; both null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge(df: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url", max_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """Adds host, path, rule, verdict and, for urls no rule fits, what the filter said (`bloom_hit`).

    `listed` has one column of canonical URLs.
    """
    listed = listed.toDF("listed_url").filter("listed_url is not null").distinct()
    size = bloom.blocks_for(listed.count(), max_blocks)
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, says = rule_verdict(F.col("host"), F.col("path"), rules)
    known = df.drop("host", "path", "rule", "verdict", "bloom_hit").withColumns({"host": host, "path": path})
    known = known.withColumns({"rule": rule, "_says": says})

    ruled = known.filter("_says is not null").select("*", F.lit(None).cast("boolean").alias("bloom_hit"), F.col("_says").alias("verdict"))
    open_ = known.filter("_says is null").withColumn("_key", F.when(F.col("host") != "", canonical_url(F.col(url))))
    table = bloom.build(listed.select(F.xxhash64("listed_url").alias("hash")), "hash", size)
    tested = bloom.test(open_.withColumn("_hash", F.when(F.col("_key").isNotNull(), F.xxhash64("_key"))), table, "bloom_hit", "_hash", size)

    clear = tested.filter("not bloom_hit").withColumn("verdict", F.lit("allow"))
    exact = tested.filter("bloom_hit").join(listed, F.col("_key") == F.col("listed_url"), "left").withColumn(
        "verdict", F.when(F.col("listed_url").isNotNull(), "block").otherwise("allow")
    ).drop("listed_url")
    out = [*known.columns[:-1], "bloom_hit", "verdict"]
    return ruled.select(out).unionByName(clear.select(out)).unionByName(exact.select(out))
