"""Sets of integer ids as bitmaps: one row ``(bucket, bits)`` per 32,768 neighbouring ids, so a set grows with its ids' spread.

Any 64-bit id has a place: the buckets above 0 hold positive ids, bucket 0 and those below hold 0 and negative ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "bucket bigint, bits binary"
_IDS = 32_768


def bitmaps(ids: DataFrame, id: str = "user_id") -> DataFrame:
    """The set of the ids that occur; null ids are in no set."""
    placed = ids.where(F.col(id).isNotNull()).select(F.bitmap_bucket_number(id).alias("bucket"), F.bitmap_bit_position(id).alias("bit"))
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _byte(bits: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(bits, at + 1, F.lit(1))), 16, 10).cast("int")


def members(sets: DataFrame, id: str = "user_id") -> DataFrame:
    """The ids in a set."""
    bytes_ = sets.select("bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(_IDS // 8 - 1))).alias("at"))
    bytes_ = bytes_.select("bucket", "at", _byte(F.col("bits"), F.col("at")).alias("byte")).where("byte > 0")
    bits = bytes_.select("bucket", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
    bits = bits.where(F.expr("(shiftright(byte, k) & 1) = 1"))
    position = F.col("at") * 8 + F.col("k")
    value = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * _IDS + position + 1).otherwise(F.col("bucket") * _IDS - position)
    return bits.select(value.cast("bigint").alias(id))


def without(rows: DataFrame, sets: DataFrame, id: str = "user_id") -> DataFrame:
    """The rows whose id is not in the set: one bit decides.

    A set is small (at most 4 KB for 32,768 ids), so Spark mostly broadcasts it by its size; otherwise it splits the rows of a
    crowded bucket.
    """
    at = F.bitmap_bit_position(id)
    listed = rows.select("*", F.bitmap_bucket_number(id).alias("bucket"), at.alias("bit")).join(sets, "bucket", "left")
    bit = _byte(F.col("bits"), F.floor(F.col("bit") / 8).cast("int"))
    inside = F.pmod(F.floor(bit / F.pow(F.lit(2), F.pmod(F.col("bit"), F.lit(8)))), F.lit(2)) == 1
    return listed.where(F.col("bits").isNull() | ~inside).select(*rows.columns)
