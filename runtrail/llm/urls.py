"""URL filters: longest-match rules, then exact membership in a list by a Bloom filter cascade.

Level 1 encodes the listed keys, level 2 the unlisted keys of the corpus that pass level 1,
level 3 the listed keys that pass level 2, and so on until no key passes wrongly. Over the keys
it was built on, a cascade answers exactly. Every level is a bitmap that Spark builds with
``bit_or`` and reads as a scalar subquery, so that rows are judged in place, without a join.

A bitmap has at most ``max_bits`` bits. When the list needs more, the keys are dealt by hash into
as many segments as it takes; each has its own cascade, and its rows are judged in a scan of
their own, so a task never holds more than one segment's bitmaps.

Defined results: a null url, or one without ``://``, has an empty host and path. A key outside
the universe is answered like any other, without the promise of exactness. Urls of any length are
read whole; repeated rows are judged alike; of rules that tie the one with the longer host counts,
then the first by text; an empty table or list gives no rows or no listed ones. Further columns are
not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import ascii_lower, written

#: Share of keys that pass a level wrongly, after the first level.
LATER_RATE = 1 / 16


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return own & F.startswith(path, F.lit(self.path))


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    text = verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = rule.fits(host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


@dataclass
class Level:
    """One Bloom filter: its number, bits, hashes, and the one-row table of its words."""

    number: int
    bits: int
    hashes: int
    table: DataFrame

    def positions(self) -> list[Column]:
        a = F.pmod(F.xxhash64(F.lit(2 * self.number), "h1", "h2"), F.lit(self.bits))
        b = F.pmod(F.xxhash64(F.lit(2 * self.number + 1), "h1", "h2"), F.lit(self.bits))
        return [(a + b * i) % self.bits for i in range(self.hashes)]

    def passes(self) -> Column:
        words = self.table.scalar()
        tests = [
            F.bit_get(F.get(words, F.floor(at / 32)), (at % 32).cast("int")) == 1
            for at in self.positions()
        ]
        return reduce(Column.__and__, tests)


def _level(number: int, keys: DataFrame, n: int, rate: float) -> Level:
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(n * hashes / math.log(2)))
    level = Level(number, bits, hashes, keys)
    set_words = keys.select(F.explode(F.array(*level.positions())).alias("at")).groupBy(
        F.floor(F.col("at") / 32).alias("id")
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 32).cast("int"))).alias("word"))
    every = keys.sparkSession.range(bits // 32 + 1).join(set_words, "id", "left")
    words = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word")))).alias("w"))
    level.table = written(words.select(F.col("w.word").alias("words")), "bloom-level")
    return level


def build_cascade(keys: DataFrame) -> list[Level]:
    """Levels over a written table of distinct keys: ``h1``, ``h2``, ``listed``."""
    inside, outside = keys.where("listed"), keys.where("NOT listed")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    kept = []
    while n_in:
        rate = LATER_RATE
        if not levels and n_out:
            rate = min(0.5, max(n_in / n_out / math.sqrt(2), 2.0**-20))
        levels.append(_level(len(levels), inside, n_in, rate))
        kept.append(outside.where(levels[-1].passes()).persist())
        inside, outside, n_in = kept[-1], inside, kept[-1].count()
    # The levels are written: what they were built from is needed no more.
    for wrong in kept:
        wrong.unpersist()
    return levels


def listed_by(levels: list[Level]) -> Column:
    """Whether the key ``h1``, ``h2`` is listed; stops at the first level it does not pass."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.passes(), F.lit(level.number % 2 == 1)).otherwise(answer)
    return answer


def member_of_list(rows: DataFrame, listed: DataFrame, key: str, max_bits: int = 1 << 28) -> DataFrame:
    """``rows`` with ``listed``: whether their key is in the list (one column named as ``key``).

    The universe is every key of ``rows``. Null keys are not listed.
    """
    marked = rows.select(key, F.lit(False).alias("listed")).union(listed.select(key, F.lit(True)))
    seen = marked.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("listed").alias("listed"))
    keyed = lambda frame: frame.withColumn("h1", F.xxhash64(key)).withColumn("h2", F.xxhash64(F.lit(1), key))
    universe = written(keyed(seen).select("h1", "h2", "listed"), "url-keys")
    n_listed = universe.where("listed").count()
    segments = max(1, math.ceil(n_listed * 30 / max_bits))
    parts = []
    for s in range(segments):
        mine = F.pmod(F.col("h1"), F.lit(segments)) == s
        levels = build_cascade(universe.where(mine) if segments > 1 else universe)
        part = keyed(rows)
        if segments > 1:
            part = part.where(mine)
        parts.append(part.withColumn("listed", F.col(key).isNotNull() & listed_by(levels)))
    return reduce(DataFrame.union, parts).drop("h1", "h2")


def filter_urls(
    pages: DataFrame, rules: list[Rule], listed_url: Column, id_col: str = "page_id", url_col: str = "url",
    max_bits: int = 1 << 28,
) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``listed_url`` says of a row's column ``url`` whether it puts host and path on the block list;
    a page without a rule is blocked if any url of the corpus listed its host and path.
    """
    urls = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
    host, path = host_and_path(F.col("url"))
    parsed = urls.select("page_id", host.alias("host"), path.alias("path"), listed_url.alias("lists"))
    parsed = parsed.withColumn("key", F.when(F.col("host") != "", F.concat("host", "path")))
    block_list = parsed.where("lists").where(F.col("key").isNotNull()).select("key")
    judged = member_of_list(parsed, block_list, "key", max_bits)
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
