"""URL filter: a blocked Bloom filter of listed (host, path) keys lets possible hits through to an exact hash join.

A block is eight 64-bit words; a key sets one bit in each word of its block. Filter, probe and join are DataFrame
operations, so list and pages may both be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.shared import written

WORDS, KEY_BITS, BLOCK_BITS = 8, 16, 512
#: The filter is sent to all executors up to this size, 72 bytes a block; a larger one is joined by block.
SENT_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(host, path, verdict) rules as a table; a long list is better kept as a table from the start."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased; path: from there up to `?`, `#` or end. Both empty
    for a null or a url without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _bit(i: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(spread, {6 * i}) & 63 as int))")


def _hashed(keys: DataFrame, blocks: int) -> DataFrame:
    """With the key's block and one bit per word."""
    keys = keys.withColumn("block", F.pmod(F.xxhash64("host", "path"), F.lit(blocks).cast("long"))).withColumn("spread", F.xxhash64(F.lit("bits"), "host", "path"))
    return keys.withColumns({f"bit{i}": _bit(i) for i in range(WORDS)}).drop("spread")


def bloom_filter(keys: DataFrame) -> tuple[DataFrame, int]:
    """(block, w0 .. w7) of the distinct (host, path) of `keys`, and the number of blocks."""
    keys = keys.select("host", "path").distinct()
    blocks = max(1, -(-keys.count() * KEY_BITS // BLOCK_BITS))
    return _hashed(keys, blocks).groupBy("block").agg(*[F.bit_or(f"bit{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def passed(candidates: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Candidates (host, path, ...) whose key may be in the filter."""
    known = F.broadcast(bloom) if blocks * 9 * WORDS <= SENT_BYTES else bloom
    hits = _hashed(candidates, blocks).join(known, "block")
    every = F.lit(True)
    for i in range(WORDS):
        every = every & (F.col(f"w{i}").bitwiseAND(F.col(f"bit{i}")) != 0)
    return hits.where(every).select(candidates.columns)


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Columns of `pages` (url among them) with host, path, rule (host and path in one) and verdict.

    A rule fits its host and all subdomains of it if the url's path starts with the rule's. The longest fitting rule wins, among equally
    long ones that of the longer host, then `block`. A url that no rule fits, also null or empty, has no rule and
    the verdict `default`. Rules with a null part are left out. Repeated pages are judged each; columns of `pages` with the
    names of the made ones are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = rules.where("host is not null and path is not null and verdict is not null").distinct()
    shapes = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").where("url is not null").distinct().select("url", host.alias("whole_host"), path.alias("whole_path"))
    hosts = F.array_distinct(F.array(*[F.substring_index("whole_host", ".", -n) for n in sorted(shapes["labels"])] or [F.lit("")]))
    starts = F.array(*[F.when(F.length("whole_path") >= n, F.substring("whole_path", 1, n)) for n in sorted(shapes["lengths"])] or [F.lit("")])
    candidates = urls.select("url", F.explode(hosts).alias("host"), "whole_path").select("url", "host", F.explode(F.array_compact(starts)).alias("path"))
    bloom, blocks = bloom_filter(rules)
    fits = passed(candidates, bloom, blocks).join(rules, ["host", "path"])
    order = F.struct(F.length(F.concat("host", "path")), F.length("host"), F.col("verdict") == "block", F.concat("host", "path").alias("rule"), "verdict")
    best = fits.groupBy("url").agg(F.max(order).alias("best")).select("url", "best.rule", "best.verdict")
    rows = pages.join(written(best, "url-verdicts"), "url", "left")
    return rows.select(*[f"`{c}`" for c in pages.columns], host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
