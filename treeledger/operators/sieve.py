"""Dropping rows without a match before a join shuffles them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A bitmap has 32,768 bits (4 KB), so all bitmaps together take 16 MB at most, however many keys there are.
BITS = 1 << 27
BITMAP_BITS = 1 << 15


def sift(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` that may have a key of ``keys``: all that have one, and of the others about as many as bits
    are set, which is 1 in 13 for ten million keys. The join that comes next decides.

    That must not be a semi or anti join, which Spark would move to before this one.

    Nothing of ``rows`` is shuffled. Keys leave a bit each, at a place given by their hash, in bitmaps that
    are broadcast by hint, since their size is bounded.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(BITS))
    bitmap, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit(BITMAP_BITS - 1))
    # Bits are made distinct first, so that a key that comes very often is no hot task.
    marks = keys.select(bitmap.alias("_bitmap"), bit.alias("_bit")).distinct()
    bitmaps = marks.repartition("_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.substring(F.col("_bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    columns = rows.columns
    return rows.join(F.broadcast(bitmaps), bitmap == F.col("_bitmap")).where(is_set).select(*columns)
