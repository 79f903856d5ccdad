"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key runs through a 64-bit linear congruential generator; each draw
gives the next shard count at which the key moves. The last jump below
the shard count is the key's shard. No ring or table is kept, and when
a shard is added the only keys that move are those that go to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import gapless_rank, shared_table

SHARDS = 16

# Fixed value: multiplier of the generator, as published.
MULTIPLIER = 2862933555777941757

_LOW16, _LOW32 = 0xFFFF, 0xFFFFFFFF


def _times(half: Column, factor: int) -> tuple[Column, Column]:
    """(low 32 bits, rest) of a 32-bit half times a 32-bit constant,
    in products of at most 48 bits so that no long overflows."""
    low, high = half * F.lit(factor & _LOW16), half * F.lit(factor >> 16)
    total = low + F.shiftleft(high.bitwiseAND(F.lit(_LOW16)), 16)
    return total.bitwiseAND(F.lit(_LOW32)), F.shiftright(total, 32) + F.shiftright(high, 16)


def _draw(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's next state, key * MULTIPLIER + 1 modulo 2^64."""
    m_hi, m_lo = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    low, carry = _times(lo, m_lo)
    low = low + 1
    high = carry + F.shiftright(low, 32) + _times(hi, m_lo)[0] + _times(lo, m_hi)[0]
    return high.bitwiseAND(F.lit(_LOW32)), low.bitwiseAND(F.lit(_LOW32))


def jump_shards(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the key's shard of ``shards`` and of one
    more. ``key`` is a long, taken as its 64 bits; null counts as 0."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(hi: Column, lo: Column, jump: Column, shard: Column, grown: Column) -> Column:
        return F.struct(hi.alias("hi"), lo.alias("lo"), jump.cast("long").alias("jump"),
                        shard.cast("int").alias("shard"), grown.cast("int").alias("grown"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _draw(s["hi"], s["lo"])
        top = F.shiftright(hi, 1) + 1
        jump = F.floor((s["jump"] + 1) * (F.lit(2147483648.0) / top))
        moved = state(hi, lo, jump, F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"]), s["jump"])
        return F.when(s["jump"] > shards, s).otherwise(moved)

    zero = F.lit(0)
    start = state(F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(_LOW32)), zero, zero, zero)
    # Jumps strictly increase, so shards + 1 steps always suffice.
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step,
                       lambda s: F.struct(s["shard"].alias("shard"), s["grown"].alias("grown")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Deal documents into ``shards`` shards by id; one row per input row.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law
    (``key``), shard, slot (place in the shard by id, gapless from 0)
    and grown_shard (the shard with one more shard). The id and the
    shard count alone decide the shard, so repeated ids share one and
    rows of a null id go where id 0 goes. Null text counts as empty; an
    empty table gives an empty result; other columns are not read.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    dealt = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"),
        jump_shards(F.col(id_col), shards).alias("to"))
    dealt = dealt.select("doc_id", "size", "text_crc32", "law", F.col("to.shard").alias("shard"),
                         F.col("to.grown").alias("grown_shard"))
    narrow = shared_table(dealt, "dealt")
    return gapless_rank(narrow, ["shard"], ["doc_id", "size", "text_crc32"], "slot")
