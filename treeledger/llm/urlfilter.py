"""URL filtering: rules on host and path, and a list of URLs behind a blocked Bloom filter.

A listed URL is found in two steps. Every distinct canonical URL is first set against one block of a
Bloom filter: a block is 8 words of 64 bits, and a URL sets one bit in each word of its block, so a
test reads one row of the filter table. What passes goes to an exact join on the URL itself, which
takes out the false positives. The filter is a table that is joined on the block number, so it may
grow with the list; Spark broadcasts it only where its size check allows.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
never listed (``allow``). Repeated rows are judged alike. An empty list allows all. Other columns of
the pages are not looked at, whatever their names.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.text import LOWER, UPPER
from treeledger.sources.store import stored

WORDS = 8
# Keys a block of 512 bits takes: 16 bits a key, about one false positive in a thousand.
KEYS_PER_BLOCK = 32

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a final ``.html`` or slashes, and the sorted query without
    ``utm_*`` and ``ref``. Scheme and fragment go. Null where there is no ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_") & ~p.startswith("ref=")
    ))
    bare = F.concat(
        F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), r"(\.html)?/*$", "")
    )
    whole = F.when(F.size(kept) > 0, F.concat(bare, F.lit("?"), F.array_join(kept, "&"))).otherwise(bare)
    return F.when(F.contains(url, F.lit("://")), whole)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    at = F.shiftright(F.xxhash64(key, F.lit("bit")), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row ``(block, w0 .. w7)`` for each block that has a key."""
    words = [F.bit_or(_bit(F.col(key), i)).alias(f"w{i}") for i in range(WORDS)]
    return listed.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def possible_hits(keys: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Keys whose bits are all set: every listed one, and a few others."""
    fits = F.lit(True)
    for i in range(WORDS):
        bit = _bit(F.col(key), i)
        fits = fits & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    return (
        keys.withColumn("block", _block(F.col(key), blocks)).join(bloom, "block").where(fits).select(key)
    )


def listed_hits(keys: DataFrame, listed: DataFrame, key: str, keys_per_block: int = KEYS_PER_BLOCK) -> DataFrame:
    """The distinct keys that are listed. ``keys_per_block`` sets the filter's size, not the result."""
    listed = stored(listed.select(key).where(F.col(key).isNotNull()).distinct(), "listed")
    blocks = max(1, -(-listed.count() // keys_per_block))
    possible = possible_hits(
        keys.select(key).where(F.col(key).isNotNull()).distinct(), key,
        bloom_filter(listed, key, blocks), blocks,
    )
    return possible.join(listed, key, "left_semi")


def longest_rule(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null. The rules are text of the caller's
    program, so their number is small."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url",
    keys_per_block: int = KEYS_PER_BLOCK,
) -> DataFrame:
    """``(key, host, path, rule, verdict, listed)`` for every page: the verdict of the longest rule,
    else ``block`` for a listed URL, else ``allow``. ``listed`` has a column ``canonical``."""
    judged = pages.select(
        F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
        canonical(F.col(url)).alias("canonical"),
    )
    hits = listed_hits(judged, listed, "canonical", keys_per_block)
    # Pages without a canonical URL get keys of their own that nothing equals, so that they are not
    # sent to one task.
    own = F.concat(F.lit("\0"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    judged = judged.withColumn("_key", F.coalesce("canonical", own))
    hits = hits.select(F.col("canonical").alias("_key"), F.lit(True).alias("_hit"))
    hit = F.coalesce("_hit", F.lit(False))
    return judged.join(hits, "_key", "left").select(
        key, "host", "path",
        longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.name).alias("rule"),
        F.coalesce(
            longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.verdict),
            F.when(hit, BLOCK).otherwise(ALLOW),
        ).alias("verdict"),
        hit.alias("listed"),
    )


def shared_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """Canonical URLs that two or more rows share, as a list for ``filter_urls``."""
    return (
        pages.select(canonical(F.col(url)).alias("canonical"))
        .where(F.col("canonical").isNotNull())
        .groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("canonical")
    )
