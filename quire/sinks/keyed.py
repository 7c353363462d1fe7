"""A keyed table (K4, K5, S6): one row a key, in buckets, sorted by key, in versions.

A table is a folder. Rows lie under ``data/key_version=<version>/key_bucket=<bucket>``, the bucket
being a hash of the key, sorted by key. ``manifest/key_version=<version>`` names, for each bucket
that holds rows, the folder whose files are the bucket's now; it is one small file,
written last, so a version is there as a whole or not at all.

* ``create`` (K4) starts the table anew, whatever was there.
* ``upsert`` (K5) reads and rewrites only the buckets that the new rows fall into; the
  next manifest points to the old files for all others.
* ``lookup`` (S6) reads only the buckets of the keys asked for: of a list by literal
  partition filters, of a table of keys by dynamic partition pruning.
* ``register`` shows a version as a table of the session's catalog, every bucket a
  partition at its own place, so plain SQL prunes buckets too.

Readers see the version they opened; two writers of one version cannot both succeed, as
the second finds the manifest taken. ``vacuum`` removes what no kept version refers to.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import file_system, holds_folders, remove

MANIFEST_SCHEMA = "bucket int, home string, rows bigint, buckets int, key string, schema string, key_version bigint"


class KeyedTable:
    """The newest version of the table at ``path`` when the object is made (or the one asked for)."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        found = self._manifest(version)
        if not found:
            raise FileNotFoundError(f"no version {'' if version is None else version} of a keyed table at {path}")
        self.version, self.key, self.buckets = found[0]["key_version"], found[0]["key"], found[0]["buckets"]
        self.schema = T.StructType.fromJson(json.loads(found[0]["schema"]))
        #: bucket -> (version folder that holds it, rows); at most ``buckets`` entries
        self.homes = {r["bucket"]: (r["home"], r["rows"]) for r in found if r["bucket"] is not None}

    def _manifest(self, version: int | None) -> list:
        if not holds_folders(self.spark, f"{self.path}/manifest"):
            return []
        rows = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.path}/manifest")
        if version is None:
            version = rows.agg(F.max("key_version")).first()[0]
        return rows.where(F.col("key_version") == F.lit(version)).collect()

    # --- writing -----------------------------------------------------------------

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str, buckets: int, order: list | None = None) -> KeyedTable:
        """K4: drop whatever is at ``path`` and write ``rows`` as its first version.

        Of rows with one key the last by ``order`` stays (by all columns if none is given).
        """
        spark = rows.sparkSession
        remove(spark, path)
        table = cls.__new__(cls)
        table.spark, table.path, table.version = spark, path.rstrip("/"), 0
        table.key, table.buckets, table.schema, table.homes = key, buckets, rows.schema, {}
        return table._write(last_per_key(rows, key, order or list(rows.columns)), [])

    def upsert(self, rows: DataFrame, order: list | None = None) -> KeyedTable:
        """K5: the next version, ``rows`` replacing those of the same keys; only their buckets are rewritten."""
        new = last_per_key(rows.select(*self.schema.names), self.key, order or self.schema.names)
        # at most ``buckets`` numbers
        touched = sorted(r[0] for r in new.select(self.bucket_of(F.col(self.key))).distinct().collect())
        return self._write(new, touched)

    def _write(self, new: DataFrame, touched: list[int]) -> KeyedTable:
        """``new`` (one row a key) and what the ``touched`` buckets hold, as the next version."""
        version = self.version + 1
        # a folder of this writer's own: one that comes too late leaves nothing changed
        home = f"{version}-{uuid.uuid4().hex[:8]}"
        data = f"{self.path}/data/key_version={home}"
        rows = new.withColumn("_new", F.lit(1))
        if kept := [b for b in touched if b in self.homes]:
            rows = rows.unionByName(self._read(kept).withColumn("_new", F.lit(0)))
        tasks = max(1, len(touched) or self.buckets)
        rows = rows.withColumn("key_bucket", self.bucket_of(F.col(self.key))).repartition(tasks, "key_bucket")
        if kept:  # a key has at most an old and a new row, both in one bucket: no further shuffle
            newest = Window.partitionBy("key_bucket", self.key).orderBy(F.desc("_new"))
            rows = rows.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")
        rows.drop("_new").sortWithinPartitions("key_bucket", self.key) \
            .write.mode("overwrite").partitionBy("key_bucket").parquet(data)
        written = self.spark.read.schema(self._stored_schema()).parquet(data) \
            .groupBy("key_bucket").agg(F.count(F.lit(1)).alias("n")).collect() if holds_folders(self.spark, data) else []
        homes = {b: h for b, h in self.homes.items() if b not in touched}
        homes |= {r["key_bucket"]: (home, r["n"]) for r in written}
        about = (self.buckets, self.key, self.schema.json())
        rows = [(b, h, n, *about) for b, (h, n) in sorted(homes.items())] or [(None, None, None, *about)]
        # refuses to write where another writer has made this version
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA.removesuffix(", key_version bigint")).coalesce(1) \
            .write.mode("error").json(f"{self.path}/manifest/key_version={version}")
        return KeyedTable(self.spark, self.path, version)

    # --- reading -----------------------------------------------------------------

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def folder(self, bucket: int) -> str:
        return f"{self.path}/data/key_version={self.homes[bucket][0]}/key_bucket={bucket}"

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("key_bucket", T.IntegerType())])

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows with their bucket, of all buckets or some."""
        folders = [self.folder(b) for b in (self.homes if buckets is None else buckets)]
        schema = self._stored_schema()
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.path}/data").schema(schema).parquet(*folders)

    def _read(self, buckets: list[int]) -> DataFrame:
        return self._rows(buckets).select(*self.schema.names)

    def read(self) -> DataFrame:
        """All rows."""
        return self._rows().select(*self.schema.names)

    def size(self) -> int:
        """Rows of the table, by its manifest."""
        return sum(n for _, n in self.homes.values())

    def lookup(self, keys: list | DataFrame) -> DataFrame:
        """The rows of ``keys``; only their buckets are read.

        A list becomes literal filters on bucket and key; a DataFrame (its first column) is joined.
        """
        kind = self.schema[self.key].dataType
        if isinstance(keys, DataFrame):
            asked = keys.select(F.col(keys.columns[0]).cast(kind).alias(self.key)).where(F.col(self.key).isNotNull())
        else:
            asked = self.spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(self.key, kind)]))
        buckets = {r[0] for r in asked.select(self.bucket_of(F.col(self.key))).distinct().collect()}
        rows = self._rows().where(F.col("key_bucket").isin(sorted(buckets & set(self.homes))))
        found = rows.join(asked, self.key, "left_semi") if isinstance(keys, DataFrame) else rows.where(F.col(self.key).isin(list(keys)))
        return found.select(*self.schema.names)

    def scan(self, start=None) -> DataFrame:
        """Rows from key ``start`` on, in key order: one range scan in place of a lookup a key."""
        rows = self.read()
        return (rows if start is None else rows.where(F.col(self.key) >= F.lit(start))).orderBy(self.key)

    def register(self, name: str) -> DataFrame:
        """This version as the catalog's table ``name`` (dropped and made again), buckets as partitions."""
        s = self.spark
        s.sql(f"DROP TABLE IF EXISTS {name}")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored_schema().fields)
        # the table's own place holds nothing: every bucket is a partition at its version's folder
        s.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (key_bucket) LOCATION '{self.path}/none'")
        if self.homes:
            s.sql(f"ALTER TABLE {name} ADD " + " ".join(
                f"PARTITION (key_bucket = {b}) LOCATION '{self.folder(b)}'" for b in sorted(self.homes)))
        return s.table(name)

    def vacuum(self) -> list[str]:
        """Remove the folders of versions that this one does not refer to, and older manifests; what was removed."""
        used = {self.folder(b) for b in self.homes}
        gone = []
        fs, data = file_system(self.spark, f"{self.path}/data")
        for version in fs.listStatus(data):
            for bucket in fs.listStatus(version.getPath()):
                path = bucket.getPath()
                if bucket.isDirectory() and not any(path.toString().endswith(u) for u in used):
                    fs.delete(path, True)
                    gone.append(f"{version.getPath().getName()}/{path.getName()}")
        for manifest in fs.listStatus(file_system(self.spark, f"{self.path}/manifest")[1]):
            if manifest.getPath().getName() != f"key_version={self.version}":
                fs.delete(manifest.getPath(), True)
        return sorted(gone)


def last_per_key(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The last row of each key by ``order`` (one partial maximum by task); rows without a key are left out."""
    rest = F.struct(*[F.col(c) for c in rows.columns])
    best = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")) \
        .agg(F.max_by(rest, F.struct(*order)).alias("_row"))
    return best.select("_row.*")
