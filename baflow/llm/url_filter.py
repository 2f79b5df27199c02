"""URL filter: rules and a host list held as Bloom filter cascades, exact for every key of the corpus.

A cascade answers "is this key listed?" without error for all keys of a known universe. Level 0 is a Bloom
filter of the listed keys; level 1 holds the unlisted keys that level 0 takes for listed; level 2 the listed
keys that level 1 takes back wrongly, and so on until a level has no false positive. The universe is every
distinct key of the pages table (each host suffix with each path start that has the length of a rule's path;
and every host), so the answer is exact for every page.

Building is a Spark job: distinct keys with their listed flag are dealt by hash into shards of about
``SHARD_KEYS`` keys, and one task builds the cascade of a shard. Filters are joined to no page: they are sent to all
tasks while they take at most ``SEND_BYTES``; beyond that pages travel to the shard of their keys
(``member_by_shard``), dealt over several tasks per shard.

Null urls and urls without ``://`` have empty host and path and fit no rule. A rule given twice counts once; a key
both allowed and blocked is blocked. Empty tables and empty lists give empty results and no listed key.
Repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import save
from baflow.llm.words import mix

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: words that put a host on the list when they are a whole part of one of its names
LISTED_WORDS = ("adult", "bets", "casino", "pills", "spam")
SHARD_KEYS = 200_000
SEND_BYTES = 64 << 20
FALSE_RATE = 0.02


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z as a-z) and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


# ------------------------------------------------------------------------------------------ one cascade
def _bits(keys: np.ndarray, level: int, size: int, hashes: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        one = mix(keys + np.uint64(2 * level + 1) * np.uint64(0x9E3779B97F4A7C15))
        two = mix(one) | np.uint64(1)
        return np.stack([(one + np.uint64(k) * two) % np.uint64(size) for k in range(hashes)])


def _has(filters: tuple, keys: np.ndarray, level: int) -> np.ndarray:
    size, hashes, bits = filters
    found = np.ones(len(keys), dtype=bool)
    for at in _bits(keys, level, size, hashes):
        found &= ((bits[(at >> np.uint64(3)).astype("i8")] >> (at & np.uint64(7)).astype("u1")) & 1).astype(bool)
    return found


def build_cascade(listed: np.ndarray, others: np.ndarray) -> list[tuple]:
    """Levels (bits, hashes, bytes) that separate the two disjoint sets of 64-bit keys."""
    levels, inside, outside = [], np.unique(listed), np.unique(others)
    while len(inside):
        rate = FALSE_RATE if levels else min(0.5, max(0.001, len(inside) / (2.0 * max(1, len(outside)))))
        size = max(64, int(-len(inside) * math.log(rate) / math.log(2) ** 2) + 1)
        hashes = max(1, round(size / len(inside) * math.log(2))) if len(inside) > 8 else 6
        bits = np.zeros((size + 7) // 8, "u1")
        at = _bits(inside, len(levels), size, hashes).ravel()
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype("i8"), np.uint8(1) << (at & np.uint64(7)).astype("u1"))
        levels.append((size, hashes, bits))
        wrong = outside[_has(levels[-1], outside, len(levels) - 1)]
        inside, outside = wrong, inside
    return levels


def in_cascade(levels: list[tuple], keys: np.ndarray) -> np.ndarray:
    """True for listed keys: the level where a key first fails decides by its parity."""
    answer = np.zeros(len(keys), dtype=bool)
    rows = np.arange(len(keys))
    for k, level in enumerate(levels):
        hit = _has(level, keys[rows], k)
        answer[rows[~hit]] = k % 2 == 1
        rows = rows[hit]
    answer[rows] = len(levels) % 2 == 1
    return answer


def _pack(levels: list[tuple]) -> bytes:
    head = np.array([len(levels)] + [v for size, hashes, _ in levels for v in (size, hashes)], "<i8")
    return head.tobytes() + b"".join(bits.tobytes() for *_, bits in levels)


def _unpack(raw: bytes) -> list[tuple]:
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(-1, 2), 8 + 16 * n, []
    for size, hashes in head.tolist():
        out.append((size, hashes, np.frombuffer(raw, "u1", (size + 7) // 8, at)))
        at += (size + 7) // 8
    return out


# ------------------------------------------------------------------------------------------ the operator
class Cascades:
    """Cascades of one list by shard; ``sent`` holds them on every task when they are small enough."""

    def __init__(self, table: DataFrame, shards: int, send_bytes: int):
        self.shards, self.table = shards, table
        size = table.agg(F.sum(F.length("filter"))).first()[0] or 0
        self.sent = None
        if size <= send_bytes:
            rows = {r["shard"]: bytes(r["filter"]) for r in table.collect()}
            self.sent = table.sparkSession.sparkContext.broadcast(rows)

    def member(self, keys: Column) -> Column:
        """Whether each key of an array column of 64-bit keys is listed."""
        sent, shards = self.sent, self.shards
        opened: dict[int, list] = {}

        @F.pandas_udf("array<boolean>")
        def member(arrays: pd.Series) -> pd.Series:
            sizes = arrays.map(len).to_numpy()
            flat = np.concatenate([*arrays, np.zeros(0, "i8")]).astype("i8")
            answer = np.zeros(len(flat), dtype=bool)
            shard = flat % shards
            for s in np.unique(shard):
                if s not in opened:
                    opened[s] = _unpack(sent.value[s]) if s in sent.value else []
                rows = np.flatnonzero(shard == s)
                answer[rows] = in_cascade(opened[s], flat[rows].view("u8"))
            return pd.Series([a.tolist() for a in np.split(answer, sizes.cumsum()[:-1])] if len(sizes) else [])

        return member(keys)

    def member_by_shard(self, rows: DataFrame, id_col: str, deals: int = 8) -> DataFrame:
        """(id_col, key) of the listed ones among ``rows`` (id_col, key), for cascades too large to send."""
        deal = F.pmod(F.xxhash64(id_col), F.lit(deals)).cast("int")
        left = rows.withColumn("shard", F.pmod("key", F.lit(self.shards))).withColumn("deal", deal)
        right = self.table.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))

        def run(a, b):
            keys = a.column("key").to_numpy().astype("i8")
            f = b.column("filter").to_pylist()
            ok = in_cascade(_unpack(f[0]), keys.view("u8")) if f else np.zeros(len(keys), bool)
            return a.select([id_col, "key"]).filter(pa.array(ok))

        kind = rows.schema[id_col].dataType.simpleString()
        return left.groupBy("shard", "deal").cogroup(right.groupBy("shard", "deal")).applyInArrow(
            run, f"{id_col} {kind}, key long")


def cascades(universe: DataFrame, shard_keys: int = SHARD_KEYS, send_bytes: int = SEND_BYTES) -> Cascades:
    """Build from (key long, listed boolean): every key of the corpus, listed or not."""
    keys = save(universe.groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    shards = max(1, -(-keys.count() // shard_keys))

    def run(key, table):
        k, listed = table.column("key").to_numpy().astype("i8").view("u8"), table.column("listed").to_numpy(zero_copy_only=False)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                         "filter": pa.array([_pack(build_cascade(k[listed], k[~listed]))], pa.binary())})

    built = keys.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard").applyInArrow(
        run, "shard long, filter binary")
    return Cascades(save(built.where(F.length("filter") > 8), "cascades"), shards, send_bytes)


def judge(pages: DataFrame, rules=RULES, listed_hosts: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    The longest rule that fits decides; where none fits, hosts of ``listed_hosts`` (host) are blocked
    and all others allowed.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    # every rule key a page can have: a suffix of its host with a start of its path
    depths = sorted({h.count(".") + 1 for _, h, _ in rules})
    sizes = sorted({len(p) for _, _, p in rules})
    labels = F.split("host", r"\.", -1)
    made = [F.when((F.col("host") != "") & (F.size(labels) >= d) & (F.length("path") >= n),
                   F.concat(F.array_join(F.slice(labels, -d, d), "."), F.substring("path", 1, n)))
            for d in sorted(depths, reverse=True) for n in sorted(sizes, reverse=True)]
    names = F.array_sort(F.filter(F.array_distinct(F.array(*made)), lambda x: x.isNotNull()),
                         lambda a, b: F.length(b) - F.length(a)) if made else F.array().cast("array<string>")
    keyed = rows.withColumn("names", names).withColumn("keys", F.transform("names", lambda x: F.xxhash64(x)))
    given = [(v, h + p) for v, h, p in rules]
    every = keyed.select(F.explode("keys").alias("key")).distinct().withColumn("listed", F.lit(False))

    def listed(verdict):
        mine = spark.createDataFrame([(k,) for v, k in given if v == verdict], "name string")
        return cascades(every.union(mine.select(F.xxhash64("name").alias("key"), F.lit(True).alias("listed"))))

    block, allow = listed("block"), listed("allow")
    hosts = rows.select("host").distinct()
    if listed_hosts is None:
        listed_hosts = hosts.where("false")
    taken = cascades(hosts.select(F.xxhash64("host").alias("key"), F.lit(False).alias("listed")).union(
        listed_hosts.select(F.xxhash64("host").alias("key"), F.lit(True).alias("listed"))))
    if taken.sent is not None:
        told = keyed.withColumn("on_list", F.element_at(taken.member(F.array(F.xxhash64("host"))), 1))
    else:
        pairs = hosts.select("host", F.xxhash64("host").alias("key"))
        told = keyed.join(taken.member_by_shard(pairs, "host").select("host", F.lit(True).alias("on_list")), "host", "left")
    told = told.withColumn("b", block.member(F.col("keys"))).withColumn("a", allow.member(F.col("keys")))
    # names run from long to short, so the first one that a cascade lists is the rule
    at = F.least(F.nullif(F.array_position("b", True), F.lit(0)), F.nullif(F.array_position("a", True), F.lit(0)))
    told = told.withColumn("at", at)
    rule = F.when(F.col("at").isNotNull(), F.element_at("names", F.col("at").cast("int")))
    blocked = F.when(F.col("at").isNotNull(), F.element_at("b", F.col("at").cast("int"))).otherwise(
        F.coalesce("on_list", F.lit(False)))
    return told.select("page_id", "host", "path", rule.alias("rule"),
                       F.when(blocked, "block").otherwise("allow").alias("verdict"))


def hosts_with_words(pages: DataFrame, words=LISTED_WORDS) -> DataFrame:
    """(host): the hosts of ``pages`` with one of the words as a part of a name, split at dots and hyphens."""
    host, _ = url_parts(F.col("url"))
    return pages.select(F.col("url").cast("string").alias("url")).select(host.alias("host")).distinct().where(
        F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(w) for w in words])))
