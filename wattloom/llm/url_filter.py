"""URL filters: allow and block rules, and a Bloom filter cascade for exact membership without joins.

The cascade knows the listed keys and all other keys of the corpus. Level 1 is a Bloom filter of the
listed keys, level 2 one of the other keys that pass level 1, level 3 one of the listed keys that pass
level 2, and so on until nothing passes that should not. The first level that a key fails at tells
whether it is listed. For keys of the universe that it was built from, the answer is exact.

Keys are dealt by hash to shards of bounded size, each of which builds its own small cascade in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.sources.tables import stage

# Keys of the universe in one shard, so the memory of the task that builds it.
SHARD_KEYS = 100_000
# Bytes of cascades that are broadcast at once. Longer lists are judged in as many branches as needed.
BROADCAST_BYTES = 64 << 20
# Bits per key and hashes of the first level; the later ones have few keys and need one hash.
FIRST_BITS, FIRST_HASHES = 8, 3
LATER_BITS = 2

_LEVELS = "shard bigint, level int, bits binary"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The name of the longest rule that fits, or null; of two equally long ones, the first by name.

    The rules are a short list that is written into the expression.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ordered]
    return F.coalesce(*(F.when(fit, F.lit(r.name)) for fit, r in zip(fits, ordered)), F.lit(None).cast("string"))


def _spots(one: np.ndarray, two: np.ndarray, level: int, n_bits: int, n_hashes: int) -> Iterator[np.ndarray]:
    """Bit positions of keys by double hashing; each level has its own."""
    with np.errstate(over="ignore"):
        step = two | np.uint64(1)
        at = one + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        at = (at ^ (at >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        for _ in range(n_hashes):
            yield (at >> np.uint64(16)) % np.uint64(n_bits)
            at = at + step


def _hashes(level: int) -> int:
    return FIRST_HASHES if level == 0 else 1


def _passes(bits: np.ndarray, level: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    found = np.ones(len(one), bool)
    for spot in _spots(one, two, level, len(bits) * 8, _hashes(level)):
        found &= (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _encode(level: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    n_bytes = max(8, len(one) * (FIRST_BITS if level == 0 else LATER_BITS) // 8 + 1)
    flags = np.zeros(n_bytes * 8, np.uint8)
    for spot in _spots(one, two, level, n_bytes * 8, _hashes(level)):
        flags[spot.astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little")


def build_levels(one: np.ndarray, two: np.ndarray, listed: np.ndarray) -> list[np.ndarray]:
    """The levels for one shard: bit arrays, none if nothing is listed."""
    inside, outside = (one[listed], two[listed]), (one[~listed], two[~listed])
    levels = []
    while len(inside[0]):
        bits = _encode(len(levels), *inside)
        wrong = _passes(bits, len(levels), *outside)
        levels.append(bits)
        if len(levels) > 200:
            raise ValueError("a listed and an unlisted key have the same two hashes")
        inside, outside = (outside[0][wrong], outside[1][wrong]), inside
    return levels


def test_levels(levels: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the number of levels it passes in a row is odd."""
    found, alive = np.zeros(len(one), bool), np.arange(len(one))
    for level, bits in enumerate(levels):
        alive = alive[_passes(bits, level, one[alive], two[alive])]
        found[alive] = level % 2 == 0
    return found


def _keyed(key: Column, n_shards: int) -> list[Column]:
    return [
        F.xxhash64(F.lit(1), key).alias("one"),
        F.xxhash64(F.lit(2), key).alias("two"),
        F.pmod(F.xxhash64(F.lit(3), key), F.lit(n_shards)).alias("shard"),
    ]


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    one, two = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("one", "two"))
    levels = build_levels(one, two, pdf["listed"].to_numpy(bool))
    return pd.DataFrame(
        {"shard": [pdf["shard"].iloc[0]] * len(levels), "level": range(len(levels)), "bits": [b.tobytes() for b in levels]},
        columns=["shard", "level", "bits"],
    )


class Cascade:
    """Cascades of all shards in a written table, a row for each level."""

    def __init__(self, levels: DataFrame, n_shards: int):
        self.levels, self.n_shards = levels, n_shards

    @staticmethod
    def build(universe: DataFrame, key: str, listed: Column, shard_keys: int = SHARD_KEYS) -> Cascade:
        """From all keys of the corpus and a condition that says which are listed.

        Repeated keys count once; a key is listed if any of its rows says so. Null keys are left out.
        """
        named = universe.select(F.col(key).alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
        keys = stage(named.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "keys")
        n_shards = max(1, -(-keys.count() // shard_keys))
        dealt = keys.select(*_keyed(F.col("key"), n_shards), "listed")
        return Cascade(stage(dealt.groupBy("shard").applyInPandas(_build_shard, _LEVELS), "cascade"), n_shards)

    def _branches(self, limit: int) -> list[tuple[int, int]]:
        """Ranges of shards whose cascades fit one broadcast; the driver sees a sum for each thousandth of the shards."""
        width = max(1, self.n_shards // 1000)
        sums = self.levels.groupBy((F.col("shard") / width).cast("bigint").alias("part")).agg(F.sum(F.length("bits")).alias("n"))
        branches, start, size = [], 0, 0
        for part, n in sorted(sums.collect()):
            if size and size + n > limit:
                branches.append((start, part * width))
                start, size = part * width, 0
            size += n
        return [*branches, (start, self.n_shards)]

    def mark(self, rows: DataFrame, key: str, out: str = "is_listed", limit: int = BROADCAST_BYTES) -> DataFrame:
        """``rows`` with a boolean column; null keys are not listed.

        No row is shuffled. One scan serves every ``limit`` bytes of cascades.
        """
        spark, n_shards = rows.sparkSession, self.n_shards
        branches = self._branches(limit)

        def branch(low: int, high: int) -> DataFrame:
            part = self.levels.where(F.col("shard").between(low, high - 1)).orderBy("shard", "level").collect()
            found: dict[int, list[bytes]] = {}
            for shard, _, bits in part:
                found.setdefault(shard, []).append(bytes(bits))
            sent = spark.sparkContext.broadcast(found)

            @F.pandas_udf("boolean")
            def is_listed(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
                arrays = {s: [np.frombuffer(b, np.uint8) for b in levels] for s, levels in sent.value.items()}
                for one, two, shard in batches:
                    h1, h2 = (x.to_numpy(np.int64).view(np.uint64) for x in (one, two))
                    owner = shard.to_numpy(np.int64)
                    answer = np.zeros(len(owner), bool)
                    for s in np.unique(owner):
                        at = np.flatnonzero(owner == s)
                        answer[at] = test_levels(arrays.get(int(s), []), h1[at], h2[at])
                    yield pd.Series(answer)

            one, two, shard = _keyed(F.col(key), n_shards)
            chosen = rows
            if len(branches) > 1:
                chosen = rows.where(F.coalesce(shard, F.lit(0)).between(low, high - 1))
            return chosen.withColumn(out, F.col(key).isNotNull() & is_listed(one, two, shard))

        return reduce(DataFrame.unionByName, (branch(*b) for b in branches))


def judge_urls(
    pages: DataFrame, rules: list[Rule], listed: Column, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, is_listed, verdict.

    The longest rule that fits decides. Where none does, pages of a listed host are blocked and all
    others allowed; ``listed`` says over the columns host and path which hosts are listed, and a host
    is if any of its pages is. A null url or one without ``://`` has an empty host and path, so no
    rule fits; a very long one is judged whole. Repeated rows are judged alike, rows without a page_id too; an empty
    table gives no rows; other columns aren't read.
    """
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    marked = Cascade.build(urls, "host", listed).mark(urls, "host")
    rule = longest_rule(rules, F.col("host"), F.col("path"))
    verdict_of = reduce(lambda w, r: w.when(F.col("rule") == r.name, r.verdict), rules, F.when(F.lit(False), ""))
    return marked.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", "is_listed",
        F.coalesce(verdict_of, F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"),
    )
