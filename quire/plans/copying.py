"""Chunk plans and ordered range copies, Q18-Q21.

The reference copies a file (or a keyed table) with n threads, each taking a
``ceil(size / n)`` slice and waiting on a lock for its turn so that slices land
in order. In Spark the order comes from the partitioning itself:
``repartitionByRange(n, key)`` + ``sortWithinPartitions(key)`` writes part
files whose key ranges ascend with the part number -- no lock, and every part
is written in parallel. A lost executor only recomputes its own parts.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.ordinal import with_global_ordinal
from quire.session import checked_broadcast, folders, holds_folders, hosts_ignored, remove, scratch_path
from quire.sinks.keyed import last_per_key
from quire.sources.literal import literal_table

# Fixed value: the part counts the reference sweeps.
SWEEP = (1, 2, 4, 8, 16, 32)


def chunk_bounds(size: int, n: int) -> list[tuple[int, int, int]]:
    """X15 + X16: ``(chunk, begin, end)`` for a size cut into n slices."""
    length = -(-size // n) if n else 0
    return [(i, min(i * length, size), min(i * length + length, size)) for i in range(n)]


def chunk_plan(spark: SparkSession, table: DataFrame, order_by: list, key: str,
               sizes_n: tuple = SWEEP) -> DataFrame:
    """Q18 over an ordered table, for every n of ``sizes_n``.

    ``(n, chunk, begin, end, rows, min_key, max_key)``: begin/end are row
    positions (0-based, end exclusive) of ``ceil(size / n)`` slices; rows, min
    and max key are what each slice holds. Rows are numbered once (global
    ordinal); each row is then exploded into its chunk for every n and one
    aggregation, combined map-side, counts all chunks of all n.
    """
    cols = list(dict.fromkeys([key] + [c for c in order_by if isinstance(c, str)]))
    numbered = with_global_ordinal(table.select(*cols), order_by, name="_pos1")
    size = numbered.count()
    lengths = [(n, max(-(-size // n), 1)) for n in sizes_n]
    # Every row lands in one chunk per n: one aggregation for all n.
    per_n = F.array(*[F.struct(F.lit(n).alias("n"),
                               F.expr(f"cast((_pos1 - 1) div {length} as int)").alias("chunk"))
                      for n, length in lengths])
    stats = (numbered.select(F.col(key).alias("_k"), F.explode(per_n).alias("_c"))
             .groupBy(F.col("_c.n").alias("n"), F.col("_c.chunk").alias("chunk"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min("_k").alias("min_key"),
                  F.max("_k").alias("max_key")))
    bounds = literal_table(
        spark, [(n, c, b, e) for n in sizes_n for c, b, e in chunk_bounds(size, n)],
        "n int, chunk int, begin bigint, end bigint")
    return bounds.join(stats, ["n", "chunk"], "left").select(
        "n", "chunk", "begin", "end", F.coalesce("rows", F.lit(0)).alias("rows"),
        "min_key", "max_key")


def copy_totals(keys: list, columns: list) -> list:
    """Aggregates that tell whether a copy is whole: rows, sum of the first key, sum of a hash of each row."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.col(keys[0])).alias("key_sum"),
            F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum")]


def writers(table: DataFrame) -> int:
    """Ranges that keep the cluster busy and are about a split of the input each."""
    spark = table.sparkSession
    return max(spark.sparkContext.defaultParallelism, table.rdd.getNumPartitions(),
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranged(table: DataFrame, keys: list, n: int, parallelism: int | None = None, first: int = 0) -> DataFrame:
    """``table`` in P key ranges, sorted, with the number ``part`` (from ``first``) of its n-th share.

    Rows of one key are spread over ranges by a hash of the row, and equal rows by where they come
    from, so a key that a third of all rows share is many ranges, one after the other.
    """
    ranges = max(n, -(-(parallelism or writers(table)) // n) * n)
    spread = [F.xxhash64(*table.columns), F.spark_partition_id()]
    part = F.expr(f"cast({first} + spark_partition_id() div {ranges // n} as int)")
    return table.repartitionByRange(ranges, *keys, *spread).withColumn("part", part).sortWithinPartitions("part", *keys)


def stored_ranges(table: DataFrame, keys: list, ranges: int, dest: str) -> list[DataFrame | None]:
    """``table`` dealt into key ranges and sorted once, at ``dest``: each range as a frame, None where it has no rows.

    A range is one sorted file. Without the files' hosts ``coalesce`` takes neighbouring splits together, in order.
    """
    spark = table.sparkSession
    ranged(table, keys, ranges, ranges).write.mode("overwrite").partitionBy("part").parquet(dest)
    there = set(folders(spark, dest))
    with hosts_ignored(spark):
        return [spark.read.schema(table.schema).parquet(f"{dest}/part={r}") if f"part={r}" in there else None
                for r in range(ranges)]


def shares(ordered: list[DataFrame | None], n: int) -> dict[int, list[DataFrame]]:
    """The ranges of each of ``n`` parts, for parts with rows."""
    out: dict[int, list[DataFrame]] = {}
    for r, rows in enumerate(ordered):
        if rows is not None:
            out.setdefault(r * n // len(ordered), []).append(rows)
    return out


def range_copy(table: DataFrame, key, n: int, dest: str, mode: str = "overwrite",
               max_records_per_file: int | None = None, parallelism: int | None = None,
               observation: Observation | dict[int, Observation] | None = None,
               ordered: list[DataFrame | None] | None = None) -> str:
    """Q19 (T4, K6): write ``table`` as n ordered parts ``part=0..n-1``.

    The number of parts is the reference's thread count; the write itself is
    not tied to it: the table is range-partitioned into P ranges (P a
    multiple of n, at least the cluster's parallelism and the input's splits, so
    a range is about a split) and range p belongs to part ``p * n / P``. Parts are
    therefore in key order (a key can go on in the next part) and even
    n = 1 is written by P tasks. Rows are sorted by key inside each range.
    ``mode`` is ``overwrite`` (K6: drop and recreate) or ``append``; see ``append_copy``
    for an append that keeps the order (K7). ``max_records_per_file`` bounds file sizes
    on big tables. ``observation`` gets ``copy_totals`` of the rows as they are written:
    it stands behind the shuffle, in the tasks that write, which Spark counts once each.

    ``ordered``: ``table`` as ``stored_ranges`` gives it. Nothing is dealt or sorted again: as in the
    reference n threads write at once, each the neighbouring ranges of its part in ``parallelism / n``
    tasks that go on from one range to the next; ``observation`` then holds one for each part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ordered is not None:
        if mode == "overwrite":
            remove(table.sparkSession, dest)

        def write(part: int, ranges: list[DataFrame]) -> None:
            rows = reduce(DataFrame.unionAll, ranges).coalesce(max((parallelism or len(ordered)) // n, 1))
            if observation is not None:
                rows = rows.observe(observation[part], *copy_totals(keys, table.columns))
            writer = rows.write.mode(mode)
            if max_records_per_file:
                writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
            writer.parquet(f"{dest}/part={part}")

        with ThreadPoolExecutor(n) as threads:
            for done in [threads.submit(write, *x) for x in shares(ordered, n).items()]:
                done.result()
        return dest
    rows = ranged(table, keys, n, parallelism)
    if observation is not None:
        rows = rows.observe(observation, *copy_totals(keys, table.columns))
    writer = rows.write.mode(mode).partitionBy("part")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(dest)
    return dest


# --- K7: append that keeps the order ------------------------------------------------

FILES_SCHEMA = "file string, part int, rows bigint, begin bigint"


def append_copy(table: DataFrame, key, n: int, dest: str) -> str:
    """K7: add ``table`` to the copy at ``dest`` as n further ordered parts.

    The parts go on after the last one, as slices appended to a file do. A manifest (one small
    Parquet table a batch, written last) holds every file with its part, its rows and the position
    of its first row; a batch without one, from a failed job, is never read, and is overwritten by the
    next append. ``read_in_order`` gives every row its position from it.
    """
    spark, keys = table.sparkSession, [key] if isinstance(key, str) else list(key)
    known = manifest(spark, dest)
    last = known.agg(F.max("batch").alias("batch"), F.max("part").alias("part"), F.sum("rows").alias("rows")).first()
    batch = -1 if last["batch"] is None else last["batch"]
    part = -1 if last["part"] is None else last["part"]
    home = f"{dest}/data/batch={batch + 1}"
    ranged(table, keys, n, first=part + 1).write.mode("overwrite").partitionBy("part").parquet(home)
    if not holds_folders(spark, home):  # no rows: the parts stay as they are
        return dest
    # files follow each other by part and by the number of the task that wrote them
    files = spark.read.parquet(home).groupBy(F.col("_metadata.file_name").alias("file"), "part").agg(F.count(F.lit(1)).alias("rows"))
    # one narrow row a file
    before = Window.partitionBy(F.lit(0)).orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("rows").over(before), F.lit(0)) + (last["rows"] or 0)
    files.select("file", F.col("part").cast("int").alias("part"), "rows", begin.cast("bigint").alias("begin")) \
        .coalesce(1).write.mode("overwrite").parquet(f"{dest}/manifest/batch={batch + 1}")
    return dest


def manifest(spark: SparkSession, dest: str) -> DataFrame:
    """``(file, part, rows, begin, batch)`` of an appended copy, ``begin`` the position of a file's first row."""
    schema = f"{FILES_SCHEMA}, batch int"
    if not holds_folders(spark, f"{dest}/manifest"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{dest}/manifest")


def read_in_order(spark: SparkSession, dest: str, name: str = "position", max_files: int = 1_000_000) -> DataFrame:
    """The rows of an appended copy with their ``part`` and 0-based position; no sort and no shuffle.

    A row's position is its file's first one plus its place in the file. Rows are in key order
    within a batch, and throughout if every batch's keys lie above those before.
    """
    files = manifest(spark, dest)
    rows = spark.read.option("basePath", f"{dest}/data").parquet(*[
        f"{dest}/data/batch={r[0]}" for r in files.select("batch").distinct().collect()])
    rows = rows.withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    begin = checked_broadcast(files.select(F.col("file").alias("_file"), F.col("begin").alias("_begin")), max_files)
    return rows.join(begin, "_file").withColumn(name, F.col("_begin") + F.col("_row")) \
        .drop("_file", "_row", "_begin", "batch")


def slice_copy(table: DataFrame, order_by: list, n: int, dest: str) -> str:
    """Q19 in exact slices: parts of ``ceil(size / n)`` rows in ``order_by`` order.

    The parts are those of ``chunk_plan``. Rows are numbered by the global ordinal
    and stay where its range sort put them, so many tasks write a part and the
    key order runs on from file to file. ``order_by`` must be a total order.
    """
    numbered = with_global_ordinal(table, order_by, name="_pos1")
    length = max(-(-numbered.count() // n), 1)
    (numbered.withColumn("part", F.expr(f"cast((_pos1 - 1) div {length} as int)")).drop("_pos1")
     .write.mode("overwrite").partitionBy("part").parquet(dest))
    return dest


def read_copy(spark: SparkSession, dest: str, columns: list | None = None) -> DataFrame:
    """A copy read back without its ``part`` column."""
    df = spark.read.parquet(dest)
    return df.select(*(columns or [c for c in df.columns if c != "part"]))


def part_ranges(spark: SparkSession, dest: str, key: str) -> DataFrame:
    """Key range of every part of a copy, for the order check."""
    return (spark.read.parquet(dest)
            .groupBy("part")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"),
                 F.max(key).alias("max_key")))


def _total(parts: list[dict]) -> dict:
    """``copy_totals`` of a whole copy from those of its parts."""
    known = {k: [p[k] for p in parts if p[k] is not None] for k in ("rows", "key_sum", "checksum")}
    return {k: sum(v) if v or k == "rows" else None for k, v in known.items()}


def copy_sweep(spark: SparkSession, table: DataFrame, key, dest_base: str,
               sizes_n: tuple = SWEEP, checksum_cols: list | None = None
               ) -> DataFrame:
    """Q20: copy once per n, timed: ``(n, tasks, rows, key_sum, checksum, same, millis)``.

    As in the reference n is how many write at once: the copy for n is written by its share of the
    cluster's tasks, ``n`` of the largest ``n``. The table is dealt into key ranges and sorted once, for
    the largest n; every copy reads these ranges, as the reference's threads read a file that is in order,
    and no copy shuffles or sorts. Rows, key sum and checksum (the sum of a 64-bit hash
    of each row) are observed while a copy is written, so no copy is read again; ``same`` says that
    rows and checksum are the source's. The last copy is read back, all columns, to prove what was
    observed; a difference is an error.
    """
    cols = checksum_cols or table.columns
    keys = [key] if isinstance(key, str) else list(key)
    source = table.agg(*copy_totals(keys, cols)).first()
    share = -(-writers(table) // max(sizes_n))
    chosen = table.select(*cols)
    ordered = stored_ranges(chosen, keys, max(sizes_n) * share, scratch_path(spark, "ranges"))
    out = []
    for n in sizes_n:
        dest, seen = f"{dest_base}/n={n}", {part: Observation(f"copy-{n}-{part}") for part in shares(ordered, n)}
        t0 = time.perf_counter()
        range_copy(chosen, keys, n, dest, parallelism=n * share, observation=seen, ordered=ordered)
        millis, got = int((time.perf_counter() - t0) * 1000), _total([x.get for x in seen.values()])
        same = got["rows"] == source["rows"] and got["checksum"] == source["checksum"]
        out.append((n, n * share, got["rows"], got["key_sum"], got["checksum"], same, millis))
    back = read_copy(spark, dest, cols).agg(*copy_totals(keys, cols)).first()
    if (back["rows"], back["checksum"]) != (got["rows"], got["checksum"]):
        raise RuntimeError(f"the copy at {dest} is not what was observed: {back} against {got}")
    kind = table.agg(*copy_totals(keys, cols)).schema["key_sum"].dataType.simpleString()
    return literal_table(spark, out, f"n int, tasks int, rows bigint, key_sum {kind}, checksum decimal(38,0), "
                         "same boolean, millis bigint")


def keyed_scan(table: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Every row from key ``start`` on, in key order -- one range scan in
    place of one point lookup per key (filter pushed to the scan)."""
    return table.where(F.col(key) >= start).orderBy(key)


def table_size(table: DataFrame) -> DataFrame:
    """Q21 (A4): ``select count(*) as coun``."""
    return table.agg(F.count(F.lit(1)).alias("coun"))


def upsert(existing: DataFrame, rows: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """K5 as a primary key implies: new rows replace old ones with the same key.

    Of new rows with one key the last by ``order`` stays (by all columns if none is given).
    """
    new = last_per_key(rows, key, order or list(rows.columns))
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns) \
        .unionByName(new.select(*existing.columns))


def upsert_table(spark: SparkSession, path: str, rows: DataFrame, key: str, dest: str,
                 order: list | None = None) -> DataFrame:
    """K4 + K5: the keyed table at ``path`` with ``rows`` put in, written to ``dest``.

    A missing ``path`` is an empty table. The old version stays as it is, so a
    reader never sees half a write and a failed job can be run again.
    """
    try:
        existing = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = rows.limit(0)
    upsert(existing, rows, key, order).write.mode("overwrite").parquet(dest)
    return spark.read.parquet(dest)
