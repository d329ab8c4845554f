"""URL rules: a blocked Bloom filter of the listed canonical URLs, then an exact hash join of its hits.

A listed URL is a host and a path, joined as they stand (``example.com/en/``). Each page URL
gives candidate keys: every suffix of its host that has no more labels than some listed host,
with every prefix of its path that is as long as some listed path. Most candidates end at the
filter; those that pass meet the list in an exact join, which removes false positives.

Defined results. Null URL, or none with ``://``: host and path empty, no rule. Empty table: empty
result. Repeated rows: each kept. Empty list: no rule for any page. A host or path listed twice:
``block`` wins. Columns of the pages with the names used here are replaced; others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, salted_join

#: Odd multipliers of the eight words of a block; fixed values of the split-block design in the Parquet format.
WORD_SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
BITS_PER_KEY = 16
#: A filter or list of up to so many bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(key), 32), F.lit(blocks))


def _mask(key: Column, word: int) -> Column:
    low = F.xxhash64(key).bitwiseAND(F.lit(0x7FFFFFFF))
    bit = F.shiftrightunsigned((low * F.lit(WORD_SALTS[word])).bitwiseAND(F.lit(0xFFFFFFFF)), 27)
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block that has a bit: its number and eight 32-bit words."""
    return keys.select(_block(F.col("key"), blocks).alias("block"), *(_mask(F.col("key"), i).alias(f"m{i}") for i in range(8))).groupBy("block").agg(*(F.bit_or(f"m{i}").alias(f"w{i}") for i in range(8)))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """``pages`` (with ``url``) plus host, path, rule (null: none fits) and verdict. ``rules``: host, path, verdict."""
    listed = rules.select(F.concat("host", "path").alias("key"), "host", "path", "verdict").groupBy("key").agg(F.max("verdict").alias("listed_verdict"), F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.length("path")).alias("path_len"))
    # One row: the number of keys and their bytes, most labels, and the distinct path lengths (as many as the longest listed path has characters, at most).
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0)).alias("bytes"), F.max("labels").alias("labels"), F.sort_array(F.collect_set("path_len")).alias("lens")).first()
    n, labels, lens = facts["n"], facts["labels"] or 0, facts["lens"] or []
    blocks = max(1, -(-n * BITS_PER_KEY // 256))
    listed = listed.select("key", "listed_verdict")
    fits = lambda df, size: F.broadcast(df) if size <= BROADCAST_BYTES else df

    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    at, found = fresh(pages, "at", "best")
    seen = pages.select(*own).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn(at, F.concat_ws("\n", "host", "path"))
    parts = F.split("host", r"\.")
    count = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(count, F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice(parts, count - k + 1, k), "."))
    lengths = F.filter(F.array(*(F.lit(x) for x in lens)) if lens else F.array().cast("array<int>"), lambda x: x <= F.length("path"))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(lengths, lambda x: F.concat(s, F.substring("path", F.lit(1), x)))))
    asked = seen.select(at, "host", "path").distinct().select(at, F.explode(keys).alias("key"))
    filled = bloom_blocks(listed, blocks)
    possible = asked.withColumn("block", _block(F.col("key"), blocks)).join(fits(filled, blocks * 80), "block")
    for i in range(8):
        possible = possible.where(F.col(f"w{i}").bitwiseAND(_mask(F.col("key"), i)) != 0)
    # The listed keys of hosts such as "com" are asked for by a large share of the pages: past the broadcast bound, deal those over salts.
    possible = possible.select(at, "key")
    exact = possible.join(F.broadcast(listed), "key") if facts["bytes"] <= BROADCAST_BYTES else salted_join(possible, listed, "key", [at], "inner")
    best = exact.groupBy(at).agg(F.max(F.struct(F.length("key"), "key", "listed_verdict")).alias(found))
    return (
        salted_join(seen, best, at, ["url"], "left")
        .withColumns({"rule": F.col(f"{found}.key"), "verdict": F.coalesce(f"{found}.listed_verdict", F.lit(otherwise))})
        .select(*own, "host", "path", "rule", "verdict")
    )
