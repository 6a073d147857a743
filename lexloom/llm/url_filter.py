"""Exact URL filtering by a cascade of Bloom filters.

Level 0 holds the listed keys. Of the corpus's other keys some pass it: these false positives are level 1. Of the listed keys
some pass that: they are level 2, and so on until no key passes wrongly. Over the complete key universe of the corpus the
level at which a key first fails tells exactly whether it is listed, so a page is judged without a join, by filters of a few
bits a listed key.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import mix

#: Bits for each key of a level, hash functions, and the largest filter that may be held by every task.
BITS, HASHES, MAX_BYTES = 8, 5, 128 << 20
#: Bits of a level at least, so that small levels shrink too; levels that a cascade may have (a few are usual).
LEAST_BITS, MAX_LEVELS = 256, 64


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_keys(name: Column) -> Column:
    """A host and every domain above it: a.b.c, b.c, c."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


class Cascade:
    """The levels as bit arrays; positions come from two 64-bit hashes of a key."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    @staticmethod
    def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
        """Each level mixes both hashes anew, so keys that meet in one are as likely as any to part in the next."""
        with np.errstate(over="ignore"):
            salt = np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
            a, b = mix(h1.view(np.uint64) + salt), mix(h2.view(np.uint64) ^ mix(np.atleast_1d(salt)))
            return (a + np.arange(HASHES, dtype=np.uint64)[:, None] * (b | np.uint64(1))) % np.uint64(bits)

    def passes(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        words = self.levels[level]
        at = self.positions(h1, h2, level, len(words) * 64)
        return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(0)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether keys of the universe are listed: those whose first failing level is odd."""
        out, open_, level = np.zeros(len(h1), bool), np.arange(len(h1)), 0
        while level < len(self.levels) and len(open_):
            through = self.passes(h1[open_], h2[open_], level)
            out[open_[~through]] = level % 2 == 1
            open_, level = open_[through], level + 1
        out[open_] = len(self.levels) % 2 == 1
        return out


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def build(universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade | None:
    """The cascade of listed (key) over universe (key), both distinct strings; None if a level would exceed max_bytes, or after MAX_LEVELS (two keys of equal hashes): then keys are joined."""
    spark = universe.sparkSession
    scratch = Scratch(spark, "cascade")
    wanted = listed.select(F.col("key").cast("string").alias("key")).dropna().distinct()
    marked = universe.select("key").distinct().join(wanted.withColumn("on", F.lit(True)), "key", "left")  # once, to build; pages need no join
    keys = scratch.write(marked.select(*_hashes(F.col("key")), F.coalesce("on", F.lit(False)).alias("on")).distinct())
    sides = {True: keys.where("on"), False: keys.where("not on")}
    cascade, side = Cascade([]), True
    while True:
        current = sides[side]
        n = current.count()
        if not n:
            break
        words, level = math.ceil(max(LEAST_BITS, n * BITS) / 64), len(cascade.levels)
        if words * 8 > max_bytes or level == MAX_LEVELS:
            return None

        def bits(batches, level=level, words=words):
            for b in batches:
                if b.num_rows:
                    at = Cascade.positions(b.column(0).to_numpy(), b.column(1).to_numpy(), level, words * 64).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["w", "bit"])

        filled = np.zeros(words, np.uint64)
        for r in current.select("h1", "h2").mapInArrow(bits, "w long, bit long").groupBy("w").agg(F.bit_or("bit").alias("bit")).toLocalIterator():
            filled[r.w] = np.int64(r.bit).view(np.uint64)
        cascade.levels.append(filled)
        other = sides[not side]

        def wrong(batches, cascade=Cascade(list(cascade.levels)), level=level):
            for b in batches:
                yield b.filter(pa.array(cascade.passes(b.column(0).to_numpy(), b.column(1).to_numpy(), level)))

        sides[not side] = scratch.write(other.select("h1", "h2").mapInArrow(wrong, "h1 long, h2 long"))
        side = not side
    return cascade


def listed_hosts(pages: DataFrame, listed: DataFrame, url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """pages' columns plus _host, _path and _listed boolean: whether the host or a domain above it is among listed (key).

    Null urls and those without :// have the empty host. Lists beyond ``max_bytes`` of filter are joined instead.
    """
    seen = pages.withColumn("_host", host(F.col(url_col))).withColumn("_path", path(F.col(url_col)))
    keys = seen.select(F.explode(host_keys(F.col("_host"))).alias("key")).distinct()
    cascade = build(keys, listed, max_bytes)
    if cascade is None:
        bad = keys.join(listed.select("key").distinct(), "key", "left_semi")
        hosts = seen.select("_host").distinct().select("_host", F.explode(host_keys(F.col("_host"))).alias("key")).join(bad, "key", "left_semi").select("_host").distinct()
        return seen.join(hosts.withColumn("_on", F.lit(True)), "_host", "left").withColumn("_listed", F.coalesce("_on", F.lit(False))).drop("_on")
    held = pages.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("boolean")
    def judged(h1, h2):
        import pandas as pd

        size = h1.map(len)
        flat = held.value.listed(np.concatenate([*h1, np.zeros(0, np.int64)]), np.concatenate([*h2, np.zeros(0, np.int64)]))
        return pd.Series(np.logical_or.reduceat(flat, np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)) if len(flat) else np.zeros(len(h1), bool))

    keys = host_keys(F.col("_host"))
    return seen.withColumn("_listed", judged(F.transform(keys, lambda k: F.xxhash64(k)), F.transform(keys, lambda k: F.xxhash64(F.lit(1), k))))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", id_col: str = "page_id", max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule string (the longest that fits, else null), verdict string.

    rules: (verdict, host/path); a rule fits its host and all subdomains where the url's path starts with its own. Without a
    rule the verdict is block for listed hosts and their subdomains and allow for others.
    """
    seen = listed_hosts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), listed, "url", max_bytes)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("_listed"), "block").otherwise("allow")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((F.col("_host") == name) | F.col("_host").endswith("." + name)) & F.col("_path").startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return seen.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"), verdict.alias("verdict"))
