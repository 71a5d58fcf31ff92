"""URL filter by a cascade of Bloom filters over hosts.

The first filter holds the listed hosts; the second those hosts of the corpus that the
first takes for listed though they are not; the third the listed ones that the second
would let go, and so on until nothing is mistaken.  Over the corpus's own hosts, all of
which took part, membership is exact, and a page looks its host up without a join.

Hosts are dealt out to shards by hash, each with a cascade of its own, so that no task
holds more than a bounded number of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.llm.common import mixed

# The rules, as (what to do, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Names within hosts that put a host on the list.
LISTED = ("adult", "bets", "casino", "porn", "spam", "xxx", "warez")
# Hosts of a shard, about; bytes of cascades that executors hold at a time.
SHARD_HOSTS, MOST_BYTES = 500_000, 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Bloom:
    """Bits that answer "perhaps" for every key put in, and for few others."""

    def __init__(self, bits: np.ndarray, probes: int, level: int):
        self.bits, self.probes, self.level = bits, probes, level

    @classmethod
    def of(cls, keys: np.ndarray, rate: float, level: int) -> Bloom:
        probes = max(1, round(-log(rate) / log(2)))
        n_bits = max(64, ceil(len(keys) * -log(rate) / log(2) ** 2))
        one = cls(np.zeros(-(-n_bits // 8), np.uint8), probes, level)
        for at in one._places(keys):
            np.bitwise_or.at(one.bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        return one

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        size = np.uint64(8 * len(self.bits))
        for probe in range(self.probes):
            salt = np.uint64((self.level * 64 + probe + 1) * 0x9E3779B97F4A7C15 % 2**64)
            yield (mixed(keys ^ salt) % size).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at in self._places(keys):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


def build_cascade(keys: np.ndarray, listed: np.ndarray, rate: float = 0.1) -> list[Bloom]:
    """Filters that together tell ``listed`` keys from the others exactly."""
    inside, outside, levels = np.unique(keys[listed]), np.unique(keys[~listed]), []
    while len(inside):
        levels.append(Bloom.of(inside, rate, len(levels)))
        inside, outside = outside[levels[-1].holds(outside)], inside
    return levels


def ask_cascade(levels: Sequence[Bloom], keys: np.ndarray) -> np.ndarray:
    """Whether keys are listed: how many filters in a row take them is odd."""
    taken, live = np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
    for bloom in levels:
        live &= bloom.holds(keys)
        taken += live
    return taken % 2 == 1


def url_parts(url: str) -> tuple[Column, Column]:
    """Host and path: what lies between ``://`` and the first of / ? #, and on to ? or #."""
    one = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(one, "://")
    rest = F.when(at > 0, F.substring(one, at + 3, F.length(one))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(out)
    return out


def listed_host(host: Column, names: Sequence[str] = LISTED) -> Column:
    """Whether one of the names is a part of the host, between dots and dashes."""
    return host.rlike(r"(^|[.-])(" + "|".join(names) + r")([.-]|$)")


def cascades(hosts: DataFrame) -> tuple[DataFrame, int]:
    """Staged cascades of the shards of ``hosts`` (host, listed, one row each), and how many shards."""
    n = max(1, -(-hosts.count() // SHARD_HOSTS))
    keyed = hosts.select(
        F.xxhash64("host").alias("key"), "listed", F.pmod(F.xxhash64("host", F.lit(1)), F.lit(n)).cast("int").alias("shard")
    )

    def built(shard: pd.DataFrame) -> pd.DataFrame:
        levels = build_cascade(shard["key"].to_numpy().view(np.uint64), shard["listed"].to_numpy())
        rows = [(shard["shard"].iloc[0], b.level, b.probes, b.bits.tobytes()) for b in levels]
        return pd.DataFrame(rows, columns=["shard", "level", "probes", "bits"])

    made = keyed.groupBy("shard").applyInPandas(built, "shard int, level int, probes int, bits binary")
    return stage(made, "cascades"), n


def _groups(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Shards in runs of at most ``most`` bytes together, one at least."""
    out, held = [[]], 0
    for shard, size in sizes:
        if out[-1] and held + size > most:
            out.append([])
            held = 0
        out[-1].append(shard)
        held += size
    return out


def _asking(given: Broadcast):
    """Whether hosts, by key and shard, are listed in the broadcast cascades."""

    @F.pandas_udf("boolean")
    def asked(key: pd.Series, shard: pd.Series) -> pd.Series:
        keys, shards = key.to_numpy().view(np.uint64), shard.to_numpy()
        out = np.zeros(len(keys), bool)
        for one in np.unique(shards):
            at = shards == one
            out[at] = ask_cascade(given.value.get(int(one), []), keys[at])
        return pd.Series(out)

    return asked


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    listed=listed_host,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """page_id, host, path, rule, listed and verdict of every page.

    ``listed`` says of a host column which hosts are listed.  The longest rule that fits
    decides; else a page is blocked if the cascade takes its host.  Without ``://``, or for
    a null url, host and path are empty; equal rows give equal results, an empty table
    none; other columns are not looked at.  While all cascades together are small, pages
    are read once; beyond that, in as many passes as there are groups of shards, each page
    taking part in one.
    """
    host, path = url_parts("url")
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = parts.select("host").distinct().withColumn("listed", listed(F.col("host")))
    made, n = cascades(universe)
    sizes = made.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).orderBy("shard").collect()
    sizes = {r["shard"]: r["n"] for r in sizes}
    shard = F.pmod(F.xxhash64("host", F.lit(1)), F.lit(n)).cast("int")
    keyed = parts.select("*", F.xxhash64("host").alias("_key"), shard.alias("_shard"))
    asked = []
    groups = _groups([(s, sizes.get(s, 0)) for s in range(n)], most_bytes)
    for some in groups:
        rows = made.filter(F.col("shard").isin(some)).orderBy("shard", "level").collect()
        held: dict[int, list[Bloom]] = {}
        for r in rows:
            bits = np.frombuffer(bytes(r["bits"]), np.uint8)
            held.setdefault(r["shard"], []).append(Bloom(bits, r["probes"], r["level"]))
        given = pages.sparkSession.sparkContext.broadcast(held)

        mine = keyed if len(groups) == 1 else keyed.filter(F.col("_shard").isin(some))
        asked.append(mine.withColumn("listed", _asking(given)("_key", "_shard")))
    whole = asked[0]
    for more in asked[1:]:
        whole = whole.unionByName(more)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    return whole.select("*", rule.alias("_rule")).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), "listed",
        F.coalesce("_rule.verdict", verdict).alias("verdict"),
    )
