"""Session construction and the few cluster-facing helpers every job needs.

* ``build_session`` -- a session for tests and the benchmark (local mode).
  Library code never changes global configuration; it only reads it.
* ``ensure_checkpoint_dir`` -- reliable checkpoints go to the shared folder the
  cluster names in ``spark.checkpoint.dir``; a private temporary folder is
  only used when nothing is configured (tests, local runs).
* ``scratch_path`` -- where jobs write intermediate tables (round trips, copies):
  under the checkpoint folder, so it is shared storage on a cluster;
  ``clear_scratch`` removes them at the end of a run.
* ``checked_broadcast`` -- broadcast a side only after counting that it is
  small; otherwise leave the join to Spark (sort-merge, AQE).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            configured = None
    if not configured:
        # Local runs and tests only: a cluster names a shared folder.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: What an application has derived from its inputs and stored: key -> path under its scratch folder.
derived: dict[tuple, str] = {}


def _scratch_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, under the shared checkpoint folder and the application's own."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def derive(spark: SparkSession, key: tuple, write) -> str:
    """The path of what ``write(path)`` stores, written once per application."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in derived:
        path = scratch_path(spark, "-".join(str(k).strip("/").replace("/", "_") for k in key))
        write(path)
        derived[full] = path
    return derived[full]


def clear_scratch(spark: SparkSession) -> bool:
    """Remove the application's intermediate tables, once its results are written; whether there were any.

    Frames that still read them fail afterwards; what is derived is stored anew when it is asked for.
    """
    for key in [k for k in derived if k[0] == spark.sparkContext.applicationId]:
        del derived[key]
    return remove(spark, _scratch_folder(spark))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def holds_folders(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there and has folders: a table written without rows has none to read."""
    fs, p = file_system(spark, path)
    return fs.exists(p) and any(x.isDirectory() for x in fs.listStatus(p))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders at ``path``."""
    fs, p = file_system(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()]


@contextmanager
def hosts_ignored(spark: SparkSession):
    """Tables read inside know no hosts of their files, so their splits are grouped by their order alone."""
    name = "spark.sql.sources.ignoreDataLocality"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder of any store that Spark writes to; whether there was one."""
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if a count proves it has at most ``max_rows`` rows.

    Beyond the bound the frame is returned unhinted, so Spark plans a shuffle
    join (and AQE may still pick a broadcast from runtime statistics).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the input tables; its schema is inferred once per process.

    Inference reads a Parquet footer in a Spark job of its own; the inputs are
    read-only, so later reads pass the known schema, as a catalog table would.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame, *keys) -> DataFrame:
    """Hash-spread an input that has fewer splits than the cluster has cores.

    A Parquet file with one row group is one split, so everything up to the
    first shuffle would run in one task. Only such inputs are repartitioned,
    by the key the next join or aggregation uses, so that exchange is the one
    Spark reuses; inputs with enough splits (any large table) pass untouched.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)
