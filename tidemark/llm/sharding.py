"""Sharding by jump consistent hashing, in DataFrame expressions only.

A row's shard depends on its id and the number of shards, nothing else: no ring table, no state, no
shuffle. Growing from n to n + 1 shards moves a row either nowhere or to the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import gapless_index

#: Fixed values of jump consistent hashing: the 64-bit multiplier, as 32-bit halves and 16-bit parts of the low half.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW_HI, _LOW_LO = _LOW >> 16, _LOW & 0xFFFF
_M32, _M16 = 0xFFFFFFFF, 0xFFFF


def key_halves(key: Column) -> tuple[Column, Column]:
    """First 64 bits of the md5 of a key's text as two unsigned 32-bit numbers; null counts as ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64, in halves whose products stay below 2**63."""
    cross = lo * F.lit(_LOW_HI)
    low = lo * F.lit(_LOW_LO) + 1 + F.shiftleft(cross.bitwiseAND(F.lit(_M16)), 16)
    carry = F.shiftright(low, 32) + F.shiftright(cross, 16)
    high = hi * F.lit(_LOW_LO) + F.shiftleft((hi * F.lit(_LOW_HI)).bitwiseAND(F.lit(_M16)), 16)
    high = high.bitwiseAND(F.lit(_M32)) + (lo * F.lit(_HIGH)).bitwiseAND(F.lit(_M32)) + carry.bitwiseAND(F.lit(_M32))
    return high.bitwiseAND(F.lit(_M32)), low.bitwiseAND(F.lit(_M32))


def jump_hash(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard among ``shards`` and among ``shards + 1``.

    A jump goes at least one shard on, so ``shards`` steps always suffice. The jump that ends the walk
    tells the shard among one more: the new one if it lands exactly there, else the same.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    hi, lo = key_halves(key)
    n = F.lit(shards).cast("long")
    start = F.struct(hi.alias("hi"), lo.alias("lo"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def jump(s: Column, _: Column) -> Column:
        high, low = _step(s["hi"], s["lo"])
        return F.when(
            s["j"] < n,
            F.transform(
                F.array(F.struct(high.alias("hi"), low.alias("lo"))),
                lambda k: F.struct(
                    k["hi"].alias("hi"),
                    k["lo"].alias("lo"),
                    s["j"].alias("b"),
                    F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(k["hi"], 1) + 1).cast("double"))).alias("j"),
                ),
            )[0],
        ).otherwise(s)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards)),
        start,
        jump,
        lambda s: F.struct(s["b"].cast("int").alias("shard"), F.when(s["j"] == n, n).otherwise(s["b"]).cast("int").alias("grown")),
    )


def shard_documents(documents: DataFrame, shards: int = 40, blocks: int = 1024) -> DataFrame:
    """Every document with its shard, its gapless slot there, and its shard after one more is added.

    Input columns ``doc_id`` and ``text``; any others are ignored, whatever their names. The law is
    ``key``: documents with one id share a shard, whatever their texts. A null id counts as the empty key.
    A null or empty text has size 16 (no bytes plus the fixed 16) and crc 0. Repeated rows keep one slot
    each; ties in the id are ordered by crc, then size, and rows equal in all three are interchangeable.
    An empty table gives an empty result. Only (id, size, crc) rows are shuffled, never texts; a shard's
    rows are numbered in ``blocks`` blocks, so no task holds a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(F.col("doc_id"), shards).alias("_j"),
    ).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_j.shard").alias("shard"), F.col("_j.grown").alias("grown_shard"))
    # blocks follow the whole row, so one id, or none, on many texts is no hot block
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    rest = F.conv(F.substring(F.md5(named), 17, 8), 16, 10).cast("long")
    out = gapless_index(rows, "shard", rest, [F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")], "slot", blocks)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
