"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import quire
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ensure_checkpoint_dir


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's modules, once per application.

    As ``--py-files`` does; a job then needs no PYTHONPATH on the workers.
    """
    sc, home = spark.sparkContext, Path(quire.__file__).parent
    if sc.applicationId in _shipped or not home.is_dir():
        return
    path = os.path.join(tempfile.mkdtemp(prefix="quire-py-"), "quire.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent).as_posix())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


#: Rows of an Arrow batch. Whole texts travel in batches, and Spark's own 10,000
#: rows would hold tens of megabytes a task in the JVM and again in Python.
BATCH_ROWS = 1_000
_ROWS_KEY, _ROWS_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS rows, unless the session has a size of its own."""
    if spark.conf.get(_ROWS_KEY, _ROWS_DEFAULT) == _ROWS_DEFAULT:
        spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table by Spark's own reader, whatever store it lies in."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names.

    What else the caller's frame holds (also under clashing names) never
    reaches an operator's plan.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """``(doc_id, text)`` with null text as the empty one, and further columns by name."""
    return narrow(docs, doc_id=id_col, text=text_col, **more).select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder.

    Lost executors do not lose it, and Spark removes the files once nothing
    refers to them (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    small_batches(df.sparkSession)
    return df.checkpoint(eager=True)


#: A row number holds the file's number above the row's place in its file.
FILES, ROW_BITS = 1 << 23, 40


def _parquet_table(docs: DataFrame) -> bool:
    """Whether ``docs`` is a Parquet table as read, with nothing between."""
    plan = docs._jdf.queryExecution().analyzed()
    kind = lambda x: x.getClass().getSimpleName()
    return kind(plan) == "LogicalRelation" and kind(plan.relation()) == "HadoopFsRelation" \
        and kind(plan.relation().fileFormat()) == "ParquetFileFormat"


def placed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number ``name`` that stays the row's own in all later jobs.

    Splits depend on the cores registered when a job is planned, so the running
    number of a scan does not stay. A Parquet table's rows are numbered by file
    (by the order of the names; one narrow row a file is broadcast) and place in
    the file; any other frame is stored with its numbers.
    """
    if _parquet_table(docs):
        about = docs.metadataColumn("_metadata")
        files = sorted(r[0] for r in docs.select(about["file_path"]).distinct().collect())
        if len(files) <= FILES:
            number = docs.sparkSession.createDataFrame(
                list(enumerate(files)), "_place_number bigint, _place_file string")
            rows = docs.select("*", about["file_path"].alias("_place_file"), about["row_index"].alias("_place_row"))
            place = F.shiftleft("_place_number", ROW_BITS) + F.col("_place_row")
            return rows.join(F.broadcast(number), "_place_file") \
                .select(*[F.col(f"`{c}`") for c in docs.columns], place.alias(name))
    return stored(docs.withColumn(name, F.monotonically_increasing_id()))


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in fields]])
