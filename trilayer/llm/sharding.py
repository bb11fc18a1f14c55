"""Jump consistent hashing: a shard for each key without a ring table.

The keyed generator's draws say how far a key jumps to the next shard number; the last jump below the number of shards is
the key's shard.  One more shard takes exactly the keys whose next jump lands on it, and no key moves between old shards.
All in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trilayer.llm.common import id_and_text

#: The generator: state * MULTIPLIER + 1, modulo 2^64; the top 31 bits are the draw.  Fixed values of the published method.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW))


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """One step of the generator on 32-bit halves: 64-bit columns refuse to overflow, so no product may reach 2^63."""
    m_low, m_high = MULTIPLIER & LOW, MULTIPLIER >> 32

    def by(half: Column, factor: int) -> Column:
        """half * factor modulo 2^32."""
        upper = (half * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF))
        return (half * F.lit(factor & 0xFFFF) + F.shiftleft(upper, 16)).bitwiseAND(F.lit(LOW))

    above = low * F.lit(m_low >> 16)
    below = low * F.lit(m_low & 0xFFFF) + F.lit(1) + F.shiftleft(above.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftrightunsigned(below, 32) + F.shiftrightunsigned(above, 16)
    return (carry + by(low, m_high) + by(high, m_low)).bitwiseAND(F.lit(LOW)), below.bitwiseAND(F.lit(LOW))


def jumps(key: Column, shards: int) -> Column:
    """Struct of `shard`, the key's shard among `shards`, and `after`, the first shard number that would take the key
    away from it.  A key's shard among `shards + 1` is `after` if that equals `shards`, else `shard`."""
    high, low = _halves(key.cast("long"))
    start = F.struct(high.alias("high"), low.alias("low"), F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("after"))

    def jump(state: Column, _: Column) -> Column:
        up, down = _next_state(state["high"], state["low"])
        draw = F.shiftrightunsigned(up, 1) + F.lit(1)
        target = F.floor((state["after"] + 1) * (F.lit(float(1 << 31)) / draw)).cast("long")
        moved = F.struct(up.alias("high"), down.alias("low"), state["after"].alias("shard"), target.alias("after"))
        return F.when(state["after"] < shards, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)


def _text_digest() -> list[Column]:
    text = F.coalesce(F.col("document.text").cast("string"), F.lit(""))
    return [(F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def shard_documents(docs: DataFrame, shards: int = 24, cells: int = 1024) -> DataFrame:
    """Puts every row of `docs` into a shard and a place in it.

    Columns: doc_id, size (UTF-8 bytes + 8), text_crc32, law (`key`), shard, slot, grown_shard (with one more shard) and
    document, a struct of all columns of `docs`.

    A null text counts as empty, a null id as key 0.  Rows with equal ids share a shard and have slots of their own.
    Slots are gapless from 0 in each shard: rows are numbered within `cells` cells of the shard, a cell's numbers start
    where the counts of the cells before it end.  So no task holds a whole shard, and the first pass reads ids only.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(0))

    def placed(rows: DataFrame) -> DataFrame:
        up, down = _next_state(*_halves(key))
        # The draw is the top 31 bits; a cell takes the bits below these, which the shard does not depend on.
        cell = F.pmod(F.shiftleft(up.bitwiseAND(F.lit(1)), 20) + F.shiftrightunsigned(down, 12), F.lit(cells))
        jumped = rows.withColumn("jump", jumps(key, shards)).withColumn("cell", cell)
        return jumped.select(
            *[c for c in jumped.columns if c != "jump"],
            F.col("jump.shard").cast("int").alias("shard"),
            F.when(F.col("jump.after") == shards, F.col("jump.after")).otherwise(F.col("jump.shard")).cast("int").alias("grown_shard"),
        )

    narrow = id_and_text(docs)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("document"))
    counts = placed(narrow.select("doc_id")).groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    rows = placed(whole.select("doc_id", *_text_digest(), "document"))
    within = W.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.join(starts, ["shard", "cell"])
        .withColumn("slot", F.col("first_slot") + F.row_number().over(within) - 1)
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "document")
    )


def shard_digest(docs: DataFrame, **options) -> DataFrame:
    """The placed rows with size and checksum of the texts that they carry in place of the documents."""
    return shard_documents(docs, **options).select("doc_id", *_text_digest(), "law", "shard", "slot", "grown_shard")
