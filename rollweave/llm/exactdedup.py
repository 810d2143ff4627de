"""Exact deduplication against a minimal perfect hash over the distinct digests of history.

History's distinct digests are cut into shards by digest; each shard is a minimal perfect hash (levels of bit vectors,
Limasset et al., 2017) whose slots hold the full 32-byte digest and the winner's locator (doc_id) with its count. New
digests look their slot up and compare all 32 bytes: members take the slot's winner and add to its count, nonmembers form
groups of their own. Nothing else brings history and new rows together. Everything that is looked up or built is a distinct digest, so copies never make a shard or a group large.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.common import Scratch, normalised, salted, table, whole_row

#: Distinct digests per shard at most on average; a shard of this size takes about 4 MB.
SHARD_KEYS = 65_536
SALTS = 64
_GAMMA = 2.0
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def _spot(words: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = words[:, 0] + np.uint64(level + 1) * _GOLDEN * (words[:, 1] | np.uint64(1))
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Maps each of n distinct digests to its own number in 0..n-1; other digests to any number or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            rank = np.cumsum(bits, dtype=np.int64) - bits + before
            self.ranks.append(rank)
            before += int(bits.sum())

    @classmethod
    def build(cls, words: np.ndarray) -> PerfectHash:
        levels, left = [], words
        while len(left):
            if len(levels) > 200:
                raise ValueError("digests are not distinct")
            size = max(8, math.ceil(_GAMMA * len(left)))
            spot = _spot(left, len(levels), size)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[spot]]
        return cls(levels)

    def find(self, words: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            spot = _spot(words[open_], level, len(bits))
            hit = bits[spot] == 1
            out[open_[hit]] = rank[spot[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return sizes + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, blob: bytes) -> PerfectHash:
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(blob, "<u4", n, 4), 4 * (n + 1), []
        for size in map(int, sizes):
            m = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, m, at), count=size))
            at += m
        return cls(levels)


_SLOT = [("digest", "V32"), ("winner", "<i8"), ("n", "<i8")]
INDEX_SCHEMA = "shard int, hash binary, slots binary"


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(x) for x in group["digest"]]
    words = _words(digests)
    found = PerfectHash.build(words)
    slots = np.zeros(len(group), _SLOT)
    at = found.find(words)
    slots["digest"][at] = np.frombuffer(b"".join(digests), "V32")
    slots["winner"][at] = group["keep_id"].to_numpy(np.int64)
    slots["n"][at] = group["n"].to_numpy(np.int64)
    return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "hash": [found.to_bytes()], "slots": [slots.tobytes()]})


def shard_of(digest: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def build_index(distinct: DataFrame, shards: int) -> DataFrame:
    """(digest, keep_id, n), a row for each digest -> the index: a row (shard, hash, slots) for each shard that has keys."""
    return distinct.withColumn("shard", shard_of("digest", shards)).groupBy("shard").applyInPandas(_pack, INDEX_SCHEMA)


def members(digests: list[bytes], found: PerfectHash, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, whether that slot holds the very digest) for each digest; all 32 bytes are compared."""
    if not len(slots) or not digests:
        return np.zeros(len(digests), np.int64), np.zeros(len(digests), bool)
    at = found.find(_words(digests))
    own = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    held = np.ascontiguousarray(slots["digest"][np.maximum(at, 0)]).view(np.uint8).reshape(-1, 32)
    return np.maximum(at, 0), (at >= 0) & (own == held).all(axis=1)


def _resolve(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    digests, n = [bytes(x) for x in probes["digest"]], probes["n"].to_numpy(np.int64)
    slots = np.frombuffer(index["slots"].iloc[0], _SLOT).copy() if len(index) else np.zeros(0, _SLOT)
    found = PerfectHash.from_bytes(index["hash"].iloc[0]) if len(index) else PerfectHash([])
    at, repeats = members(digests, found, slots)
    np.add.at(slots["n"], at[repeats], n[repeats])  # members join their slot and take its winner
    alone = np.flatnonzero(~repeats)
    return pd.DataFrame(
        {
            "digest": [x.tobytes() for x in slots["digest"]] + [digests[i] for i in alone],
            "keep_id": pd.concat([pd.Series(slots["winner"], dtype="Int64"), probes["keep_id"].astype("Int64").iloc[alone]], ignore_index=True),
            "group_size": np.concatenate([slots["n"], n[alone]]),
        }
    )


def resolve(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(digest, keep_id, group_size) of all groups: the index's slots with the members found among ``distinct`` (digest,
    keep_id, n; a row for each new digest), and each nonmember as a group of its own."""
    left = distinct.withColumn("shard", shard_of("digest", shards)).groupBy("shard")
    return left.cogroup(index.groupBy("shard")).applyInPandas(_resolve, "digest binary, keep_id long, group_size long")


def decide(rows: DataFrame, scratch: Scratch, digests: DataFrame | None = None) -> DataFrame:
    """Adds keep_id, group_size and kept to rows that hold doc_id and digest.

    History is the lower half of the range of doc_id, so its winners precede every later row; rows without doc_id count
    as later. ``digests``: the (doc_id, digest) of the same rows, where that is cheaper to read than rows. Rows that
    repeat doc_id and digest are one document: the first of them stays. A group without any doc_id keeps one row, and
    its keep_id is null.
    """
    digests = rows.select("doc_id", "digest") if digests is None else digests
    low, high, n = digests.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    shards = max(16, math.ceil(n / SHARD_KEYS))
    old = F.lit(False) if low is None else F.coalesce(F.col("doc_id") <= (low + high) // 2, F.lit(False))

    def distinct(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))

    history = scratch.keep(distinct(digests.where(old)), "history", 64 * n)
    index = scratch.keep(build_index(history, shards), "index")
    groups = scratch.keep(resolve(distinct(digests.where(~old)), index, shards), "groups", 64 * n)
    scratch.drop(history, index)
    salts = digests.select("digest", salted(F.col("doc_id"), SALTS).alias("salt")).groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("rows"))
    stats = salts.join(groups, "digest").select("digest", "salt", "keep_id", "group_size")
    first = F.row_number().over(Window.partitionBy("digest", "salt", "doc_id").orderBy("doc_id")) == 1
    return (
        rows.withColumn("salt", salted(F.col("doc_id"), SALTS))
        .join(stats, ["digest", "salt"])
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & first)
        .drop("salt")
    )


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


#: Ids of dropped rows are broadcast up to this many (some 10 MB with their hash table); beyond, the join shuffles.
BROADCAST_IDS = 250_000


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with docs' own columns, whatever they are called; doc_id and text are needed.

    Where every doc_id occurs once, rows are decided on their digests alone and only the dropped ids meet docs; else
    digests tell the rows of one doc_id apart.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    narrow = scratch.keep(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    if not narrow.groupBy("doc_id").count().where("count > 1").isEmpty():
        rows = docs.select("doc_id", whole_row(docs).alias("row"), digest(F.col("text")).alias("digest"))
        return decide(rows, scratch, narrow).where("kept").select("row.*")
    gone = scratch.keep(decide(narrow, scratch).where("not kept").select(F.col("doc_id").alias("gone")), "gone", 16 * narrow.count())
    ids = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.select("doc_id", whole_row(docs).alias("row")).join(ids, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti").select("row.*")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "exact")
    rows = scratch.keep(table(spark, sf_dir, "documents").select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    found = decide(rows, scratch)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
