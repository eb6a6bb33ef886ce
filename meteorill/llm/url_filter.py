"""Exact membership of URL keys in a list, by a cascade of Bloom filters over all keys of a corpus.

Level 1 encodes the listed keys. Level 2 encodes those other keys of the corpus that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until nothing is let through
wrongly. A key of that corpus is listed if the first level that does not hold it is an even one.
No table is joined: the levels are literals in an expression.

Null and empty keys are keys like any other. A key outside the universe the cascade was built on
gets an answer that may be wrong, as with any Bloom filter. An empty list makes a cascade without
levels, which lists nothing. Repeated keys are one key, listed if any of their rows is. Rules of equal length are
taken in the order of their texts. Very long urls are keys like any other; an empty table has an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import LOWER, UPPER, stored


@dataclass(frozen=True)
class Level:
    """A Bloom filter: `words` are its bits, 64 in each number."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for position in _positions(key, self.seed, self.bits, self.hashes):
            word = F.get(words, (position / 64).cast("int"))
            found = found & (F.getbit(word, (position % 64).cast("int")) == 1)
        return found


def _positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    """Places of a key's bits, from two hashes of 31 bits each."""
    mask = F.lit(0x7FFFFFFF).cast("bigint")
    one = F.xxhash64(F.lit(2 * seed), key).bitwiseAND(mask)
    two = F.xxhash64(F.lit(2 * seed + 1), key).bitwiseAND(mask)
    return [(one + two * i) % F.lit(bits).cast("bigint") for i in range(hashes)]


def build_level(keys: DataFrame, count: int, seed: int, bits_per_key: float, hashes: int, max_bits: int) -> Level:
    """A level over column `key` of `keys`, which has `count` rows.

    The bits are set by an aggregation with a map-side part; its at most `max_bits / 64` numbers
    come to the driver.
    """
    bits = 64 * max(1, math.ceil(count * bits_per_key / 64))
    if bits > max_bits:
        raise ValueError(f"{count} keys need {bits} bits, more than max_bits={max_bits}; split the list")
    places = keys.select(F.explode(F.array(*_positions(F.col("key"), seed, bits, hashes))).alias("position"))
    numbers = (
        places.groupBy((F.col("position") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(position % 64 as int))")).alias("set"))
        .collect()
    )
    words = [0] * (bits // 64)
    for row in numbers:
        words[row["word"]] = row["set"]
    return Level(seed, bits, hashes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether `key` is listed: exact for every key of the universe."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number, level in reversed(list(enumerate(self.levels, 1))):
            answer = F.when(level.has(key), answer).otherwise(F.lit(number % 2 == 0))
        return answer


def build_cascade(
    universe: DataFrame, *, bits_per_key: float = 10, hashes: int = 6, later_bits: float = 3, later_hashes: int = 2, max_bits: int = 1 << 30
) -> Cascade:
    """The cascade for `universe`: rows of (`key`, `listed`), repeated ones welcome.

    A key that any row lists is listed. The distinct keys are written once to the shared folder;
    each level reads what the two before it left, which shrinks fast.
    """
    keys = stored(universe.groupBy("key").agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed")))
    inside, outside = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    levels: list[Level] = []
    count = inside.count()
    while count:
        first = not levels
        level = build_level(inside, count, len(levels), bits_per_key if first else later_bits, hashes if first else later_hashes, max_bits)
        levels.append(level)
        inside, outside = outside.filter(level.has(F.col("key"))), inside
        count = inside.count()
    return Cascade(tuple(levels))


def url_host(url: Column) -> Column:
    """From the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`verdict` for a host, all its subdomains, and paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def first_rule(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """`value(rule)` of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        chosen = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(chosen)
    return chosen


def judge(pages: DataFrame, cascade: Cascade, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, listed, verdict) of every page.

    Listed keys are host and path together. A rule outranks the list. A null or odd url has an
    empty host and path, which is a key of its own. Other columns of `pages` play no part.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    listed = cascade.lists(F.concat(host, path))
    return parsed.select(
        "page_id",
        "host",
        "path",
        first_rule(rules, host, path, lambda r: r.text).alias("rule"),
        listed.alias("listed"),
        F.coalesce(first_rule(rules, host, path, lambda r: r.verdict), F.when(listed, "block").otherwise("allow")).alias("verdict"),
    )
