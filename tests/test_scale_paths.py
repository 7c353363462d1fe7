"""Paths that only fire on big inputs, forced on small ones."""

import os

from pyspark.sql import functions as F

import quire.operators.ordinal as ordinal
import quire.sources.xml as X
from quire.session import checked_broadcast, spread
from quire.sources.literal import literal_table


def _text(tmp_dir, n=3000):
    p = os.path.join(tmp_dir, "t.txt")
    with open(p, "w") as f:
        f.write("".join(f"{i}\n" for i in range(1, n + 1)))
    return p


def test_line_numbers_over_many_splits(spark, tmp_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows = ordinal.ordered_lines(spark, _text(tmp_dir)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3000 and all(int(r.value) == r.line_no for r in rows)


def test_part_numbers_are_ordered_as_numbers(spark, tmp_dir):
    for part, text in ((99999, "first"), (100000, "second"), (7, "zero")):
        with open(os.path.join(tmp_dir, f"part-{part:05d}-x.txt"), "w") as f:
            f.write(text + "\n")
    rows = sorted(ordinal.ordered_lines(spark, tmp_dir).collect(), key=lambda r: r.line_no)
    assert [r.value for r in rows] == ["zero", "first", "second"]


def test_xml_over_many_splits(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.xml")
    with open(p, "w") as f:
        f.write("<bib>\n" + "".join(
            f'<article key="k{i}">\n<author>A</author>\n<title>T{i}.</title>\n<year>2001</year>\n'
            f"</article>\n" for i in range(300)) + "</bib>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = X.load_publications(spark, p).select("pub_key", "title").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.pub_key for r in got) == sorted(f"k{i}" for i in range(300))
    assert all(r.title == f"T{r.pub_key[1:]}." for r in got)


def test_spread_only_small_inputs(spark):
    small = spark.range(0, 10, numPartitions=1)
    big = spark.range(0, 10, numPartitions=spark.sparkContext.defaultParallelism)
    assert spread(small, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(big, "id") is big


def test_checked_broadcast_and_literal_tables(spark):
    t = literal_table(spark, [(1, "a"), (2, "b")], "k bigint, v string")
    assert sorted(tuple(r) for r in t.collect()) == [(1, "a"), (2, "b")]
    assert literal_table(spark, [], "k bigint").count() == 0
    joined = spark.range(0, 5).withColumnRenamed("id", "k").join(checked_broadcast(t, 10), "k")
    assert sorted(r.v for r in joined.collect()) == ["a", "b"]
    assert F is not None


def test_scratch_tables_go_and_derived_ones_are_made_again(spark):
    from quire.session import clear_scratch, derive, file_system, scratch_path
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    made = []
    first = derive(spark, ("test", "x"), lambda p: made.append(p) or spark.range(2).write.parquet(p))
    assert derive(spark, ("test", "x"), made.append) == first and made == [first]
    assert clear_scratch(spark)
    fs, path = file_system(spark, kept)
    assert not fs.exists(path)
    again = derive(spark, ("test", "x"), lambda p: spark.range(2).write.parquet(p))
    assert again != first and spark.read.parquet(again).count() == 2


def test_persisted_table_is_let_go(spark):
    from quire.operators.containment import persisted
    with persisted(spark.range(10)) as kept:
        assert kept.count() == 10 and kept.storageLevel.useMemory
    assert not kept.storageLevel.useMemory
