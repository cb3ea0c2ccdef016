"""URL rules by a Bloom filter cascade: exact membership for every key of a corpus, without joins.

A rule is `host/path`: it fits its host and all subdomains where the url's path starts with the
rule's. Of several that fit, the longest wins. The keys a url can match are its host's last labels
followed by the first characters of its path, in the few shapes (labels, characters) that occur in
the rules. Level 1 of a cascade encodes the listed keys; level 2 the keys of the corpus that pass
level 1 though they aren't listed; level 3 the listed keys that pass level 2; and so on until no
key passes wrongly. For keys of the corpus the answer is then exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bits and hashes for each key: many on the first level, since it decides how much the next holds.
FIRST, LATER = (12, 6), (4, 2)
MAX_LEVEL_BYTES = 8 * 1024 * 1024


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: the bits as 64-bit words."""

    words: tuple[int, ...]
    hashes: int
    salt: int

    def positions(self, key: Column) -> list[Column]:
        return bit_positions(key, len(self.words) * 64, self.hashes, self.salt)

    def may_hold(self, key: Column) -> Column:
        # A text of numbers folds into one array literal, whatever its length.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        hit = [F.get(words, F.shiftright(at, 6).cast("int")).bitwiseAND(bit(at)) != 0 for at in self.positions(key)]
        return reduce(lambda a, b: a & b, hit)


def bit(at: Column) -> Column:
    """The bit's value in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))


def bit_positions(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(salt * 64 + i), key), F.lit(bits)) for i in range(hashes)]


class LevelTooLarge(ValueError):
    """A Bloom filter over `MAX_LEVEL_BYTES`."""


def build_level(keys: DataFrame, salt: int, shape: tuple[int, int]) -> Level | None:
    """The Bloom filter of a column `key`; None without keys. Only its words come to the driver."""
    n = keys.count()
    if n == 0:
        return None
    words, hashes = -(-n * shape[0] // 64), shape[1]
    if words * 8 > MAX_LEVEL_BYTES:
        raise LevelTooLarge(f"a level of {words * 8} bytes is too large to send to every task: {n} keys")
    at = F.explode(F.array(*bit_positions(F.col("key"), words * 64, hashes, salt)))
    filled = [0] * words
    found = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(bit(F.col("at"))).alias("bits")).toArrow())
    for word, bits in zip(found.column("word").to_pylist(), found.column("bits").to_pylist()):
        filled[word] = bits
    return Level(tuple(filled), hashes, salt)


@dataclass(frozen=True)
class Cascade:
    """Bloom filters that encode listed keys and false positives by turns."""

    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the corpus that the cascade was built over."""
        result = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            result = F.when(self.levels[i].may_hold(key), result).otherwise(F.lit(i % 2 == 1))
        return result


def build_cascade(listed: DataFrame, universe: DataFrame, first: tuple[int, int] = FIRST,
                  later: tuple[int, int] = LATER) -> Cascade:
    """The cascade of `listed` over `universe`; both have a column `key` without nulls.

    `first`, `later`: bits and hashes for each key. The next level's keys are those of this level's
    other side that pass it. The universe is read again for each even level, without a join of its
    own: only what passes all levels so far meets the (small) listed side. Where so much passes a level that the next one would be
    too large, it is built anew with twice the bits, so that any universe will do. Only the listed keys are bound by `MAX_LEVEL_BYTES`:
    5 million of them or so; more raise.
    """
    listed, universe = listed.select("key").distinct(), universe.select("key")
    levels: list[Level] = []
    sides: list[tuple[DataFrame, DataFrame]] = []
    shapes: dict[int, tuple[int, int]] = {0: first}
    inside, outside = listed, universe
    while True:
        try:
            level = build_level(inside, len(levels), shapes.get(len(levels), later))
        except LevelTooLarge:
            if not levels:
                raise
            levels.pop()
            inside, outside = sides.pop()
            bits, hashes = shapes.get(len(levels), later)
            shapes[len(levels)] = (2 * bits, min(2 * hashes, 40))
            continue
        if level is None:
            return Cascade(tuple(levels))
        levels.append(level)
        sides.append((inside, outside))
        wrong = outside.where(level.may_hold(F.col("key")))
        if len(levels) == 1:
            wrong = wrong.distinct().join(listed, "key", "left_anti")
        inside, outside = wrong, inside


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_shapes(rules: Sequence[str]) -> list[tuple[int, int]]:
    """The pairs (labels of the host, characters of the path) that occur in the rules."""
    return sorted({(host.count(".") + 1, len(path)) for host, path in map(split_rule, rules)})


def key_of(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The host's last labels and the first characters of the path; null where the url has fewer."""
    labels, chars = shape
    tail = F.substring_index(host, ".", -labels)
    enough = (F.length(path) >= chars) & (host != "")
    if labels > 1:
        enough = enough & (F.length(host) - F.length(F.translate(host, ".", "")) >= labels - 1)
    return F.when(enough, F.concat(tail, F.left(path, F.lit(chars))))


def judge_urls(pages: DataFrame, id_col: str, url_col: str, block: Sequence[str], allow: Sequence[str],
               default: str = "allow") -> DataFrame:
    """One row per row of `pages`: the id, host, path, rule and verdict.

    Null urls and urls without `://` have an empty host and path, fit no rule, and get `default`, as
    do all that fit none. Of rules equally long, the one with the longer host wins. Repeated rows and
    null ids stay as they are; an empty table gives no rows; other columns aren't read. A rule in
    both lists, or without a host, is an error.
    """
    rules = [*block, *allow]
    if len(set(rules)) < len(rules) or not all(split_rule(r)[0] and "/" in r for r in rules):
        raise ValueError("each rule must be host/path, and stand in one list once")
    url = F.col(f"`{url_col}`")
    urls = pages.select(F.col(f"`{id_col}`").alias(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    if not rules:
        return urls.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shapes = rule_shapes(rules)
    keys = [key_of(F.col("host"), F.col("path"), s) for s in shapes]
    universe = urls.select(F.explode(F.array_compact(F.array(*keys))).alias("key")).distinct()
    spark = pages.sparkSession
    lists = {verdict: build_cascade(_keys(spark, listed), universe)
             for verdict, listed in (("block", block), ("allow", allow)) if listed}
    found = []
    for key, (labels, _) in zip(keys, shapes):
        for verdict, cascade in lists.items():
            found.append(F.when(key.isNotNull() & cascade.contains(key), F.struct(
                F.length(key).alias("long"), F.lit(labels).alias("labels"),
                key.alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.greatest(*found, F.lit(None).cast("struct<long:int,labels:int,rule:string,verdict:string>"))
    return (urls.withColumn("best", best)
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def _keys(spark: SparkSession, listed: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in listed], "key string")


BLOCK, ALLOW = ("net/", "example.com/de/"), ("example.net/en/", "org/fr/")

SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(rhost, rpath, verdict)),
m AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""


@query("op4_url_filter", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", BLOCK, ALLOW)
