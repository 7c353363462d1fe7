"""Load-log queries Q13-Q15.

Lines arrive numbered (``line_no`` dense from 1, from ``ordered_lines`` for
files or ``with_global_ordinal`` for rendered fixtures). A log holds times of
day only; the date of its first line is a parameter (by default the file's
modification date, quirk Z5) and a day is added wherever the time goes
backwards (quirk Z4).

Day roll at scale: lines are cut into blocks of ``BLOCK`` consecutive line
numbers -- every block has exactly that many rows, whatever the data, so no
task can be skewed. Inside a block a window finds backward steps and their
running count; per block the first time, last time and count of steps give
one small row; the carry between blocks is a running sum over those rows
(one per block), joined back on the block key the data is already
partitioned by.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.logline import line_bytes, parse_fields, shown_line
from quire.operators.ordinal import file_order

BLOCK = 1 << 20


def parse_load_log(lines: DataFrame) -> DataFrame:
    """Q13 (without dates): ``(line_no, sec_of_day, uptime, users, load1, load5, load15, value)``."""
    f = parse_fields(F.col("value"))
    return lines.select("line_no", *[c.alias(k) for k, c in f.items()], "value")


def with_day_roll(parsed: DataFrame, log_date, block: int = BLOCK) -> DataFrame:
    """Add ``day`` (days after ``log_date``), ``ts`` (timestamp_ntz) and ``ts_sec``.

    ``log_date`` is a ``datetime.date``, an ISO string or a date Column.
    Lines whose time could not be parsed keep the day of the line before.
    """
    blk = F.expr(f"(line_no - 1) div {int(block)}")
    d = parsed.withColumn("_blk", blk)
    w = Window.partitionBy("_blk").orderBy("line_no")
    # Last parsed time strictly before this line, inside the block.
    prev = F.last("sec_of_day", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_back", F.when(F.col("sec_of_day") < prev, 1).otherwise(0))
    d = d.withColumn("_cum", F.sum("_back").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = d.groupBy("_blk").agg(
        F.min_by("sec_of_day", F.when(F.col("sec_of_day").isNotNull(), F.col("line_no")))
         .alias("_first"),
        F.max_by("sec_of_day", F.when(F.col("sec_of_day").isNotNull(), F.col("line_no")))
         .alias("_last"),
        F.sum("_back").alias("_rolls"))
    # One row per block: last known time of all earlier blocks, and the carry.
    order = Window.orderBy("_blk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_prev_last", F.last("_last", ignorenulls=True).over(earlier))
    blocks = blocks.withColumn(
        "_edge", F.when(F.col("_first") < F.col("_prev_last"), 1).otherwise(0))
    blocks = blocks.withColumn(
        "_carry",
        F.coalesce(F.sum("_rolls").over(earlier), F.lit(0))
        + F.sum("_edge").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # ``d`` is already partitioned by block for the window, so joining the block
    # table back shuffles only that small table; AQE turns it into a broadcast
    # from its measured size. No count job.
    out = d.join(blocks.select("_blk", "_carry"), "_blk")
    if isinstance(log_date, (str, dt.date)):
        base = F.lit(str(log_date)).cast("date")
    else:
        base = log_date
    out = out.withColumn("day", (F.col("_carry") + F.col("_cum")).cast("int")) \
             .drop("_blk", "_back", "_cum", "_carry")
    date = F.date_add(base, F.col("day"))
    sec = F.col("sec_of_day")
    ts = F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date),
                              (sec / 3600).cast("int"), ((sec % 3600) / 60).cast("int"),
                              (sec % 60).cast("decimal(8,6)"))
    ts_sec = F.unix_date(date).cast("bigint") * 86400 + sec
    return out.withColumn("ts", F.when(sec.isNotNull(), ts)).withColumn("ts_sec", ts_sec)


def log_report(dated: DataFrame) -> DataFrame:
    """Q14 as rows ``(section, ord, text)``.

    a ``line_count``; b ``span_seconds`` first to last line; c
    ``positive_load15`` (a true ``> 0``, quirk Z1) and ``nonnull_load15`` (what
    the reference's broken test counts); d ``even_line`` rows (lines 2, 4, ...)
    as echoed, then ``even_bytes``. Counts and the span are one aggregation.
    """
    agg = dated.agg(
        F.count(F.lit(1)).alias("line_count"),
        # First to last line whose time was read.
        (F.max_by("ts_sec", F.when(F.col("ts_sec").isNotNull(), F.col("line_no")))
         - F.min_by("ts_sec", F.when(F.col("ts_sec").isNotNull(), F.col("line_no"))))
        .alias("span_seconds"),
        F.count_if(F.col("load15") > 0).alias("positive_load15"),
        F.count("load15").alias("nonnull_load15"),
        F.sum(F.when(F.col("line_no") % 2 == 0, line_bytes(F.col("value")))).alias("even_bytes"),
    )
    stats = agg.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("section"), F.lit(0).cast("bigint").alias("ord"),
                 F.col(k).cast("string").alias("text"))
        for k in ("line_count", "span_seconds", "positive_load15", "nonnull_load15",
                  "even_bytes")])).alias("r")).select("r.*")
    even = dated.where(F.col("line_no") % 2 == 0).select(
        F.lit("even_line").alias("section"), F.col("line_no").cast("bigint").alias("ord"),
        shown_line(F.col("value")).alias("text"))
    return stats.unionByName(even)


def store_log(dated: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """A dated log as the catalog's table ``name``, bucketed and sorted by line number, its files at ``path``.

    The lines are shuffled once, when the log is stored; any two logs stored with one number of
    buckets are then joined by line where they lie.
    """
    spark = dated.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dated.repartition(buckets, "line_no").write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, "line_no").sortBy("line_no").saveAsTable(name)
    return spark.table(name)


def log_skew(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q15: ``(line_no, seconds)`` = time of line i in B minus line i in A.

    Both sides are dated logs; the positional zip is an inner equi join on the
    line number, so it stops at the shorter log. Logs that ``store_log`` has bucketed
    alike are joined without a shuffle.
    """
    return (b.select("line_no", F.col("ts_sec").alias("_b"))
             .join(a.select("line_no", F.col("ts_sec").alias("_a")), "line_no")
             .select("line_no", (F.col("_b") - F.col("_a")).alias("seconds")))


#: Order of the report's parts, as the reference writes them.
SECTIONS = ("line_count", "span_seconds", "positive_load15", "nonnull_load15", "even_line", "even_bytes")


def report_lines(report: DataFrame) -> DataFrame:
    """K8: the report as text lines ``(seq, value)``, parts in the reference's order."""
    seq = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    return report.select(F.struct(seq.alias("part"), "ord").alias("seq"), F.col("text").alias("value"))


def write_report(report: DataFrame, dest: str) -> str:
    """K8: the ordered text report; part files follow each other in order."""
    report_lines(report).orderBy("seq").select("value").write.mode("overwrite").text(dest)
    return dest


def file_facts(spark: SparkSession, path) -> DataFrame:
    """S9, S10 as a source: ``(file, bytes, modified)`` of every file under ``path``.

    The listing only (``binaryFile`` without its contents); Spark lists no empty files.
    """
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def log_facts(spark: SparkSession, path) -> DataFrame:
    """``(bytes, date)`` of a log: its length (S9), and the modification date of its first file."""
    first = F.struct(*file_order())
    return file_facts(spark, path).agg(F.sum("bytes").alias("bytes"),
                                       F.min_by(F.to_date("modified"), first).alias("date"))


def _facts(spark: SparkSession, path):
    try:
        return log_facts(spark, path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def file_length(spark: SparkSession, path) -> int:
    """Total bytes of the files under ``path`` (-1 when nothing is there)."""
    row = _facts(spark, path)
    return -1 if row is None or row["bytes"] is None else int(row["bytes"])


def file_date(spark: SparkSession, path):
    """A log's date by its first file (in ``file_order``); ``None`` where there are only empty files."""
    return log_facts(spark, path).first()["date"]
