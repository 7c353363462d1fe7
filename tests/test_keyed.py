"""The keyed table's buckets, versions and lookups."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quire.sinks.keyed import KeyedTable
from tests.test_plans_and_entry import _plan


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(os.path.join(path, "data")) for f in names if f.endswith(".parquet")}


def _prunes(plan):
    return re.search(r"PartitionFilters: \[[^\]]*key_bucket", plan) is not None


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def table(spark, tmp_dir):
    rows = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return KeyedTable.create(rows, os.path.join(tmp_dir, "t"), "k", 8)


def test_create_holds_every_row_once_sorted_by_bucket(spark, table):
    assert table.size() == 4000 and _rows(table.read()) == [(i, 2 * i) for i in range(4000)]
    assert set(table.homes) == set(range(8)) and len({v for v, _ in table.homes.values()}) == 1
    one = spark.read.parquet(table.folder(3))
    assert [r.k for r in one.collect()] == sorted(r.k for r in one.collect())


def test_upsert_of_one_key_leaves_the_other_buckets_files(spark, table):
    before = _files(table.path)
    new = table.upsert(spark.createDataFrame([(77, -1)], "k bigint, v bigint"))
    touched = [b for b, (v, _) in new.homes.items() if v.startswith("2-")]
    assert len(touched) == 1 and new.version == 2
    after = _files(table.path)
    assert {f: t for f, t in after.items() if f in before} == before
    assert all("key_version=2-" in f and f"key_bucket={touched[0]}/" in f for f in set(after) - set(before))
    assert _rows(new.read()) == [(i, -1 if i == 77 else 2 * i) for i in range(4000)]
    # the version that a reader has opened stays what it was
    assert table.read().where("k = 77").first().v == 154
    assert KeyedTable(spark, table.path).version == 2 and KeyedTable(spark, table.path, 1).version == 1


def test_lookup_reads_only_the_buckets_of_its_keys(spark, table):
    found = table.lookup([5, 9_999])
    assert _rows(found) == [(5, 10)]
    plan = _plan(found)
    assert _prunes(plan) and "PushedFilters: [In(k, [5,9999])]" in plan
    of_five = table.bucket_of(F.lit(5).cast("bigint"))
    home = spark.range(1).select(of_five).first()[0]
    read = {r[0] for r in table.lookup([5]).select(F.input_file_name()).collect()}
    assert len(read) == 1 and f"key_bucket={home}" in read.pop()


def test_lookup_of_a_table_of_keys_prunes_buckets(spark, table):
    keys = spark.range(3, 5)
    found = table.lookup(keys)
    assert _rows(found) == [(3, 6), (4, 8)]
    buckets = {r[0] for r in keys.select(table.bucket_of(F.col("id"))).collect()}
    read = {r[0].split("key_bucket=")[1].split("/")[0] for r in table._rows().where(
        F.col("key_bucket").isin(list(buckets))).select(F.input_file_name()).collect()}
    assert _prunes(_plan(found)) and read == {str(b) for b in buckets}


def test_catalog_table_prunes_buckets(spark, table):
    table = table.upsert(spark.createDataFrame([(1, 0)], "k bigint, v bigint"))
    assert table.register("keyed_test").count() == 4000
    home = spark.range(1).select(table.bucket_of(F.lit(1).cast("bigint"))).first()[0]
    found = spark.sql(f"SELECT v FROM keyed_test WHERE key_bucket = {home} AND k = 1")
    assert "InMemoryFileIndex(1 paths)" in _plan(found) and _rows(found) == [(0,)]
    spark.sql("DROP TABLE keyed_test")
    assert table.read().count() == 4000  # the files are the table's, not the catalog's


def test_scan_from_a_key_on_in_order(table):
    keys = [r.k for r in table.scan(3990).collect()]
    assert keys == list(range(3990, 4000))


def test_repeated_null_and_new_keys(spark, table):
    rows = [(5, 1), (5, 3), (5, 2), (None, 9), (9000, 4)]
    new = table.upsert(spark.createDataFrame(rows, "k bigint, v bigint"), order=["v"])
    assert _rows(new.lookup([5, 9000])) == [(5, 3), (9000, 4)] and new.size() == 4001


def test_two_writers_of_one_version(spark, table):
    table.upsert(spark.createDataFrame([(1, 1)], "k bigint, v bigint"))
    with pytest.raises(Exception, match="already exists"):
        table.upsert(spark.createDataFrame([(1, 2)], "k bigint, v bigint"))
    assert KeyedTable(spark, table.path).lookup([1]).first().v == 1


def test_create_drops_what_was_there_and_empty_tables(spark, table):
    again = KeyedTable.create(spark.createDataFrame([], "k string, v int"), table.path, "k", 4)
    assert again.read().count() == 0 and again.size() == 0 and again.version == 1
    assert again.lookup(["a"]).count() == 0 and again.register("keyed_none").count() == 0
    spark.sql("DROP TABLE keyed_none")
    assert _rows(again.upsert(spark.createDataFrame([("a", 1)], "k string, v int")).read()) == [("a", 1)]
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, table.path + "-none")


def test_vacuum_removes_what_no_version_refers_to(spark, table):
    new = table.upsert(spark.createDataFrame([(77, -1)], "k bigint, v bigint"))
    gone = new.vacuum()
    assert len(gone) == 1 and gone[0].startswith("key_version=1-")
    assert _rows(KeyedTable(spark, table.path).read()) == [(i, -1 if i == 77 else 2 * i) for i in range(4000)]
