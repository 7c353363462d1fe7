"""Q16-Q21: generators, chunk plans, ordered copies."""

import os

from pyspark.sql import functions as F

from quire.plans import copying, generate


def test_repeated_ints_q16(spark):
    assert [r.v for r in generate.repeated_ints(spark, 3, 2).collect()] == [1, 1, 2, 2, 3, 3]


def test_int_sets_small_q17(spark):
    vals = generate.repeated_ints(spark, 12, 3)
    got = {r.i: r.data for r in generate.int_sets(vals, width=4, stride=5).collect()}
    assert got == {0: [1, 2, 3, 4], 1: [6, 7, 8, 9], 2: [11, 12]}


def test_int_sets_reference_size_z13(spark):
    vals = spark.range(1, generate.REFERENCE_NUMBER + 1).select(F.col("id").alias("v"))
    s = generate.set_summary(generate.int_sets(vals)).orderBy("i").collect()
    assert len(s) == 52
    assert sum(r.size for r in s) == 1_031_117
    assert s[-1].size == 11_117


def test_chunk_bounds_x15_x16():
    assert copying.chunk_bounds(6, 4) == [(0, 0, 2), (1, 2, 4), (2, 4, 6), (3, 6, 6)]
    assert copying.chunk_bounds(5, 4) == [(0, 0, 2), (1, 2, 4), (2, 4, 5), (3, 5, 5)]


def test_chunk_plan_q18(spark):
    t = spark.range(0, 6).select((F.col("id") * 10).alias("k"))
    rows = copying.chunk_plan(spark, t, ["k"], "k", sizes_n=(4,)).orderBy("chunk").collect()
    assert [(r.begin, r.end, r.rows, r.min_key, r.max_key) for r in rows] == [
        (0, 2, 2, 0, 10), (2, 4, 2, 20, 30), (4, 6, 2, 40, 50), (6, 6, 0, None, None)]


def test_range_copy_q19_order_and_content(spark, tmp_dir):
    src = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"),
                                      (F.col("id") % 7).alias("v"))
    checksum = src.agg(F.sum(F.xxhash64("k", "v").cast("decimal(38,0)"))).first()[0]
    checks = copying.copy_sweep(spark, src, "k", os.path.join(tmp_dir, "sweep")).collect()
    for r in checks:
        assert r.rows == 5000 and r.checksum == checksum and r.same and r.millis > 0
    assert [r.n for r in checks] == list(copying.SWEEP)
    assert [r.tasks for r in checks] == sorted({r.tasks for r in checks})   # n decides how many write
    parts = copying.part_ranges(spark, os.path.join(tmp_dir, "sweep", "n=8"), "k") \
        .orderBy("part").collect()
    assert [p.part for p in parts] == list(range(8))
    for a, b in zip(parts, parts[1:]):
        assert a.max_key < b.min_key       # ascending and disjoint by part number


def test_single_part_copy_is_written_in_parallel(spark, tmp_dir):
    src = spark.range(0, 4000).select(F.col("id").alias("k"))
    dest = os.path.join(tmp_dir, "one")
    copying.range_copy(src, "k", 1, dest, parallelism=8)
    files = [f for f in os.listdir(os.path.join(dest, "part=0")) if f.endswith(".parquet")]
    assert len(files) == 8
    assert copying.read_copy(spark, dest).count() == 4000


def test_append_and_upsert_k5_k7(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([(0, [1, 2]), (1, [3])], "i int, data array<int>")
    copying.range_copy(a, "i", 1, dest)
    copying.range_copy(spark.createDataFrame([(2, [4])], "i int, data array<int>"), "i", 1, dest,
                       mode="append")
    assert copying.table_size(copying.read_copy(spark, dest)).first().coun == 3
    up = copying.upsert(copying.read_copy(spark, dest),
                        spark.createDataFrame([(1, [9])], "i int, data array<int>"), "i")
    assert {r.i: r.data for r in up.collect()} == {0: [1, 2], 1: [9], 2: [4]}


def test_keyed_table_copy_and_scan_s6(spark, tmp_dir):
    sets = generate.int_sets(generate.repeated_ints(spark, 120, 3), width=10, stride=11)
    dest = os.path.join(tmp_dir, "sets")
    copying.range_copy(sets, "i", 4, dest)
    back = copying.read_copy(spark, dest)
    assert back.exceptAll(sets).count() == 0 and sets.exceptAll(back).count() == 0
    keys = [r.i for r in copying.keyed_scan(back, "i").collect()]
    assert keys == sorted(keys) and keys[0] == 0


def test_file_length_s9(spark, tmp_dir):
    from quire.plans.loadlog import file_length
    p = os.path.join(tmp_dir, "f.txt")
    with open(p, "w") as f:
        f.write("x" * 1234)
    assert file_length(spark, p) == 1234
    assert file_length(spark, os.path.join(tmp_dir, "missing")) == -1


def test_upsert_keeps_the_last_row_per_key_and_writes_it(spark, tmp_dir):
    path = os.path.join(tmp_dir, "keyed")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string")
    first = copying.upsert_table(spark, f"{path}/none", rows, "k", f"{path}/1", order=["at"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, 2, "b"), (2, 1, "c")]
    new = spark.createDataFrame([(2, 5, "x"), (2, 4, "y"), (3, 1, "z")], "k int, at int, v string")
    second = copying.upsert_table(spark, f"{path}/1", new, "k", f"{path}/2", order=["at"])
    assert sorted(tuple(r) for r in second.collect()) == [(1, 2, "b"), (2, 5, "x"), (3, 1, "z")]


def test_slices_are_those_of_the_chunk_plan(spark, tmp_dir):
    src = spark.range(0, 103).withColumnRenamed("id", "k")
    dest = copying.slice_copy(src, ["k"], 8, os.path.join(tmp_dir, "slices"))
    got = sorted((r.part, r.rows, r.min_key, r.max_key) for r in copying.part_ranges(spark, dest, "k").collect())
    assert got == [(c, e - b, b, e - 1) for c, b, e in copying.chunk_bounds(103, 8)]


def test_copies_are_observed_while_they_are_written(spark, tmp_dir, monkeypatch):
    """Only the source and the last copy are read; a copy that lacks rows is told by its observation."""
    src = spark.range(0, 300).withColumnRenamed("id", "k")
    reads = []
    real = copying.read_copy
    monkeypatch.setattr(copying, "read_copy", lambda s, d, c=None: reads.append(d) or real(s, d, c))
    copying.copy_sweep(spark, src, "k", os.path.join(tmp_dir, "s"), sizes_n=(1, 2, 4)).collect()
    assert [r.rsplit("/", 1)[1] for r in reads] == ["n=4"]
    cut = copying.ranged
    monkeypatch.setattr(copying, "ranged", lambda t, *a, **k: cut(t.where("k <> 7"), *a, **k))
    got = copying.copy_sweep(spark, src, "k", os.path.join(tmp_dir, "t"), sizes_n=(2,)).first()
    assert got.rows == 299 and not got.same


def test_sweep_deals_and_sorts_the_table_once(spark, tmp_dir, monkeypatch):
    """one shuffle for all copies; every file is in order, and files follow each other within a part."""
    rows = [((i * 37) % 500 if i % 3 else None, i % 11) for i in range(900)] + [(7, 1)] * 100
    src = spark.createDataFrame(rows, "k int, v int").repartition(5)
    dealt, cut = [], copying.ranged
    monkeypatch.setattr(copying, "ranged", lambda *a, **k: dealt.append(1) or cut(*a, **k))
    checks = copying.copy_sweep(spark, src, "k", os.path.join(tmp_dir, "s"), sizes_n=(1, 3, 4)).collect()
    assert len(dealt) == 1 and [r.rows for r in checks] == [1000] * 3 and all(r.same for r in checks)
    for r in checks:
        dest = os.path.join(tmp_dir, "s", f"n={r.n}")
        back = copying.read_copy(spark, dest)
        assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
        keys, files = [], 0
        for part in range(r.n):
            names = sorted(f for f in os.listdir(os.path.join(dest, f"part={part}")) if f.endswith(".parquet"))
            files += len(names)
            for name in names:
                keys += [x.k for x in spark.read.parquet(os.path.join(dest, f"part={part}", name)).coalesce(1).collect()]
        assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
        assert files <= r.tasks   # n decides how many write


def test_appended_parts_go_on_in_order_k7(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "ap")
    src = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    for low in (0, 1000, 2000):
        copying.append_copy(src.where((F.col("k") >= low) & (F.col("k") < low + 1000)), "k", 4, dest)
    copying.append_copy(src.limit(0), "k", 4, dest)   # nothing to append changes nothing
    rows = sorted((r.position, r.k, r.part) for r in copying.read_in_order(spark, dest).collect())
    assert [(p, k) for p, k, _ in rows] == [(i, i) for i in range(3000)]
    assert [p for *_, p in rows] == sorted(p for *_, p in rows) and rows[-1][2] == 11
    # a batch whose job failed before its manifest is not seen, and the next append takes its place
    copying.ranged(src, ["k"], 4, first=12).write.mode("overwrite").partitionBy("part").parquet(f"{dest}/data/batch=3")
    assert copying.read_in_order(spark, dest).count() == 3000
    copying.append_copy(src.where("k < 10"), "k", 2, dest)   # older keys: after all others, as in a file
    rows = sorted((r.position, r.k) for r in copying.read_in_order(spark, dest).collect())
    assert [k for _, k in rows[3000:]] == list(range(10)) and len(rows) == 3010


def test_reading_in_order_needs_no_shuffle(spark, tmp_dir):
    from tests.test_plans_and_entry import _plan
    dest = copying.append_copy(spark.range(0, 100).withColumnRenamed("id", "k"), "k", 2, os.path.join(tmp_dir, "ns"))
    plan = _plan(copying.read_in_order(spark, dest))
    assert "Sort" not in plan and "Exchange hash" not in plan and "BroadcastHashJoin" in plan


def test_hot_key_is_many_ranges_t4(spark):
    """A key that two thirds of the rows share, half of them equal rows."""
    hot = spark.range(0, 8000, 1, 8).select(F.lit(5).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(-1).alias("v"))
    rest = spark.range(0, 4000, 1, 4).select((F.col("id") % 100).cast("int").alias("k"), F.col("id").alias("v"))
    rows = copying.ranged(hot.unionByName(rest), ["k"], 4, parallelism=16).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in rows.groupBy("p").count().collect()]
    assert max(sizes) < 3 * 12000 / 16
    ranges = sorted((r.p, r.a, r.b) for r in rows.groupBy("p").agg(F.min("k").alias("a"), F.max("k").alias("b")).collect())
    assert all(x[2] <= y[1] for x, y in zip(ranges, ranges[1:]))


def test_sets_travel_as_bitmaps_and_merge(spark):
    from tests.test_plans_and_entry import _plan
    rows = [(v,) for v in (1, 2, 2, 4, 5, 6, 70_000, 32_768, 32_769, 65_536) for _ in range(3)]
    values = spark.createDataFrame(rows, "v int")
    plan = _plan(generate.int_sets(values, 100_000, 100_001))
    assert "partial_bitmap_construct_agg" in plan and "collect_set" not in plan
    assert "collect_list(struct(bucket" in plan  # the bitmaps are opened after the last exchange
    assert generate.int_sets(values, 100_000, 100_001).first().data == [1, 2, 4, 5, 6, 32_768, 32_769, 65_536, 70_000]
    a = generate.set_bitmaps(values.where("v < 5"), 4, 5)
    b = generate.set_bitmaps(values.where("v >= 4"), 4, 5)
    got = {r.i: r.data for r in generate.sets_of_bitmaps(generate.merged_bitmaps(a, b)).collect()}
    whole = {r.i: r.data for r in generate.int_sets(values, 4, 5).collect()}
    assert got == whole and got[0] == [1, 2, 4]
    assert generate.int_sets(values.limit(0)).count() == 0
