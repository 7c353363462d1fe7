"""Ordinals at scale (W1/D3): equal to row_number, also with a hot group."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators.ordinal import ordered_lines, with_global_ordinal, with_group_ordinal


def test_global_ordinal_equals_row_number(spark):
    df = spark.range(0, 20000).select(
        (F.col("id") * 7919 % 20000).alias("k"), (F.col("id") % 13).alias("v"))
    got = with_global_ordinal(df, [F.col("k")], name="o", num_partitions=7)
    ref = df.withColumn("o", F.row_number().over(Window.orderBy("k")))
    assert got.select("k", "o").exceptAll(ref.select("k", "o")).count() == 0
    assert got.count() == 20000


def test_group_ordinal_with_hot_group(spark):
    # One key holds two thirds of the rows; it must be split over partitions.
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("g"),
        F.col("id").alias("x"))
    got = with_group_ordinal(df, ["g"], [F.desc("x")], name="r", num_partitions=9)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("x"))))
    assert got.select("g", "x", "r").exceptAll(ref.select("g", "x", "r")).count() == 0
    # The hot group really spans several range partitions.
    from quire.operators.ordinal import _ranged
    parts = _ranged(df, ["g", F.desc("x")], 9).where("g = -1").select("_q_pid").distinct().count()
    assert parts > 1


def test_group_ordinal_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, x int")
    got = {(r.g, r.x): r.r for r in with_group_ordinal(df, ["g"], ["x"], name="r").collect()}
    assert got == {(None, 1): 1, (None, 3): 2, ("a", 2): 1}


def test_ordered_lines_over_many_splits(spark, tmp_dir):
    p = os.path.join(tmp_dir, "big.txt")
    with open(p, "w") as f:
        for i in range(1, 5001):
            f.write(f"line {i:05d} {'x' * (i % 17)}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = ordered_lines(spark, p)
        assert spark.read.text(p).rdd.getNumPartitions() > 10
        rows = lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5000
    assert all(int(r.value.split()[1]) == r.line_no for r in rows)


def test_ordered_lines_files_in_path_order(spark, tmp_dir):
    for name, n in (("b.txt", 3), ("a.txt", 2)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("".join(f"{name}{i}\n" for i in range(n)))
    got = [(r.line_no, r.value) for r in ordered_lines(spark, tmp_dir).orderBy("line_no").collect()]
    assert got == [(1, "a.txt0"), (2, "a.txt1"), (3, "b.txt0"), (4, "b.txt1"), (5, "b.txt2")]
    per_file = ordered_lines(spark, tmp_dir, per_file=True)
    assert sorted(r.line_no for r in per_file.collect()) == [1, 1, 2, 2, 3]


def test_group_ordinal_hot_group_default_aqe_path(spark):
    # Same hot group, partition count left to AQE (the path queries use).
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("g"),
        F.col("id").alias("x"))
    got = with_group_ordinal(df, ["g"], [F.desc("x")], name="r")
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("x"))))
    assert got.select("g", "x", "r").exceptAll(ref.select("g", "x", "r")).count() == 0
    assert got.count() == 30000
    ordered = with_global_ordinal(df, [F.col("x")], name="o")
    assert ordered.where("o != x + 1").count() == 0
