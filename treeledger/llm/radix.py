"""Ranks of a whole table by a distributed LSD radix sort.

Keys are integers, the first of them the most significant. They are sorted digit by digit from the last
key's lowest digit on, each pass a stable counting sort: count the rows of every digit in every part,
turn the counts into the first destination of each (digit, part) by sums over the digits and, within a
digit, over the parts before; a row's destination is that number and its place among the rows of its
part with the same digit. Destinations have no gaps, so a part is a run of a fixed number of them and no
part is ever larger, however often a key occurs. After the last pass the destination is the rank.

Digits are taken only from bits in which a key's values differ at all; a pass moves every row once, by
(digit, part). Each pass is a table in the shared folder: a lost executor costs tasks, not passes. What
comes to the driver is the count of each digit, at most 2 to the power of DIGIT_BITS numbers.

Rows with equal keys keep the order in which they were stored. No rows give no rows.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treeledger.llm.text import unused
from treeledger.sources.store import stored

DIGIT_BITS = 11
# Rows of a part, at most.
PART_ROWS = 1 << 20
_SIGN = -(1 << 63)


def digits_of(low: int, high: int, bits: int = DIGIT_BITS) -> list[tuple[int, int]]:
    """``(shift, width)`` of the digits, lowest first, in which 64-bit numbers from ``low`` to ``high``
    can differ."""
    width = ((low ^ high) & ((1 << 64) - 1)).bit_length()
    step = math.ceil(width / max(1, math.ceil(width / bits)))
    return [(at, min(step, width - at)) for at in range(0, width, step)] if width else []


def radix_rank(rows: DataFrame, keys: list[str], rank: str, bits: int = DIGIT_BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with a column ``rank``: their place from 0 on, ascending by ``keys``, bigint columns
    without nulls."""
    spark = rows.sparkSession
    part, digit, local, first = (unused(rows, stem) for stem in ("part", "digit", "local", "first"))
    now = stored(
        rows.withColumn(part, F.spark_partition_id().cast("bigint")).withColumn(rank, F.monotonically_increasing_id()),
        "radix",
    )
    edges = now.agg(
        F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]
    ).first()
    n = edges["n"]
    if not n:
        return now.drop(part)
    size = max(1, min(part_rows, math.ceil(n / int(spark.conf.get("spark.sql.shuffle.partitions")))))
    passes = [
        (key, shift, width)
        for i, key in reversed(list(enumerate(keys)))
        for shift, width in digits_of(edges[f"min{i}"], edges[f"max{i}"], bits)
    ]
    for key, shift, width in passes or [(keys[-1], 0, 1)]:  # equal keys are numbered by one pass
        unsigned = F.col(key).bitwiseXOR(F.lit(_SIGN))
        value = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit((1 << width) - 1))
        now = now.withColumn(digit, value.cast("int"))
        counts = stored(now.groupBy(digit, part).agg(F.count(F.lit(1)).alias("n")), "counts")
        start, starts = 0, []
        for row in sorted(counts.groupBy(digit).agg(F.sum("n").alias("n")).collect()):
            starts += [F.lit(row[0]), F.lit(start)]
            start += row[1]
        before = Window.partitionBy(digit).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(
            digit, part,
            (F.element_at(F.create_map(*starts), F.col(digit)) + F.coalesce(F.sum("n").over(before), F.lit(0))).alias(first),
        )
        among = Window.partitionBy(digit, part).orderBy(rank)
        moved = now.withColumn(local, F.row_number().over(among) - 1).join(offsets, [digit, part])
        place = F.col(first) + F.col(local)
        now = stored(
            moved.withColumn(rank, place.cast("bigint")).withColumn(part, F.floor(F.col(rank) / size))
            .drop(digit, local, first), "radix",
        )
    return now.drop(part)
