"""Data generators Q16 and Q17.

* ``repeated_ints(number, times)`` -- each of 1..number, ``times`` times in
  ascending order: ``spark.range`` spreads the numbers over tasks and
  ``array_repeat`` + ``explode`` expand them inside each task, no shuffle.
* ``int_sets(values, width, stride)`` -- keyed sets ``(i, data)``: value v
  belongs to set ``(v - 1) div stride`` when ``(v - 1) mod stride < width``
  (so every ``stride``-th value falls between two sets, quirk Z13, and the last
  set stops at the largest value). A set is held as bitmaps (``set_bitmaps``), one
  of 4 KB for each 32,768 neighbouring values, built by every task for itself and
  merged by *or*: only bitmaps are shuffled, however often a value is repeated, and
  sets of two runs are merged the same way (``merged_bitmaps``). A set spans at most
  ``width / 32768 + 2`` bitmaps, so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sizes the reference generates.
REFERENCE_NUMBER = 2014 * 512
REFERENCE_TIMES = 256
REFERENCE_WIDTH = 20000
REFERENCE_STRIDE = 20001
# Values of one of Spark's bitmaps.
BITMAP_BITS = 32_768


def repeated_ints(spark: SparkSession, number: int, times: int,
                  num_partitions: int | None = None) -> DataFrame:
    """Q16: ``(v int)``; in partition order the values ascend."""
    base = spark.range(1, number + 1, numPartitions=num_partitions) if num_partitions \
        else spark.range(1, number + 1)
    return base.select(F.explode(F.array_repeat(F.col("id").cast("int"), times)).alias("v"))


def run_length_expand(df: DataFrame, value: str, times: str) -> DataFrame:
    """S7 over a table: every ``value`` repeated ``times`` times."""
    return df.select(F.explode(F.array_repeat(F.col(value), F.col(times).cast("int"))).alias(value))


def int_sets(values: DataFrame, width: int = REFERENCE_WIDTH,
             stride: int = REFERENCE_STRIDE, column: str = "v") -> DataFrame:
    """Q17: ``(i int, data array<int>)``, data sorted and distinct."""
    v = F.col(column).cast("bigint")
    return sets_of_bitmaps(set_bitmaps(values, width, stride, column))


def set_bitmaps(values: DataFrame, width: int = REFERENCE_WIDTH, stride: int = REFERENCE_STRIDE,
                column: str = "v") -> DataFrame:
    """The keyed sets as ``(i int, bucket bigint, bits binary)``."""
    v = F.col(column).cast("bigint")
    keyed = values.where(((v - 1) % stride) < width).select(
        F.call_function("div", v - 1, F.lit(stride)).cast("int").alias("i"), v.alias("v"))
    return keyed.groupBy("i", F.bitmap_bucket_number("v").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))


def merged_bitmaps(*parts: DataFrame) -> DataFrame:
    """The union of sets held as bitmaps."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("i", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sets_of_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """``(i int, data array<int>)`` of keyed sets held as bitmaps, data in order."""
    # a set has few bitmaps, bounded by its width; they are opened where they have met
    held = bitmaps.groupBy("i").agg(F.collect_list(F.struct("bucket", "bits")).alias("maps"))
    return held.select("i", F.sort_array(F.flatten(F.transform("maps", lambda m: values_of(m["bucket"], m["bits"])))).alias("data"))


def values_of(bucket: Column, bits: Column) -> Column:
    """The values (array<int>) of one bitmap; a byte's bits count from the lowest."""
    byte = lambda k: F.conv(F.hex(F.substring(bits, k + 1, F.lit(1))), 16, 10).cast("int")
    held = F.filter(F.transform(F.sequence(F.lit(0), F.octet_length(bits) - 1),
                                lambda k: F.struct((k * 8).alias("first"), byte(k).alias("byte"))), lambda b: b["byte"] > 0)
    places = F.flatten(F.transform(held, lambda b: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(7)), lambda j: F.getbit(b["byte"], j) == 1), lambda j: b["first"] + j)))
    size = F.lit(BITMAP_BITS)
    return F.transform(places, lambda p: F.when(bucket > 0, (bucket - 1) * size + p + 1).otherwise(bucket * size - p).cast("int"))


def set_summary(sets: DataFrame) -> DataFrame:
    """``(i, size, first, last, total)`` of keyed sets, for checks and oracles."""
    return sets.select(
        "i", F.size("data").cast("bigint").alias("size"),
        F.element_at("data", 1).cast("bigint").alias("first"),
        F.element_at("data", -1).cast("bigint").alias("last"),
        F.aggregate("data", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"))
