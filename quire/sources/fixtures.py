"""Adapters that turn the driver's tables into the reference's inputs.

The reference ships neither its bibliography nor its second log, so the
fixtures are derived from the TPC-H-like tables, always over whole tables:

* ``publications`` -- one publication per order: its lines' supplier names are
  the author list, its lines' part names the title, the order date the year and
  the order priority the venue in the url.
* ``document_titles`` -- ``documents.text`` used as titles for the word counts.
* ``load_log_lines`` -- ``events`` of one type rendered as load-log text lines,
  in ``(ts, event_id)`` order.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import derive, file_system, read_table, spread
from quire.sources.literal import literal_table

# Order priority -> venue path used in the url.
VENUE_BY_PRIORITY = {
    "1-URGENT": "conf/sigmod",
    "2-HIGH": "conf/icde",
    "3-MEDIUM": "journals/pvldb",
}
OTHER_VENUE = "conf/other"

# The stop-word list used with the fixtures.
FIXTURE_STOP_WORDS = ("the", "of", "and", "a", "an", "to", "in")


# The schema of the stored publications: known, so no read infers it.
PUBLICATIONS_SCHEMA = "pub_id bigint, title string, author array<string>, year bigint, url string"


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pub_id, title, author array<string>, year, url)``, one row per order.

    Lines are joined to their order first and grouped by the order's columns,
    so a filter on ``year`` or ``url`` (functions of those columns) is pushed
    below the aggregation onto ``orders``. The per-order list is built with
    ``collect_list``; its size is the line count of one order (at most 7 in
    TPC-H), so no group grows with the table. Supplier and part are joined by
    key and Spark picks broadcast or sort-merge from their sizes.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), "l_orderkey")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority")

    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
               .join(sup, li.l_suppkey == sup.s_suppkey)
               .join(part, li.l_partkey == part.p_partkey))
    per_order = lines.groupBy("o_orderkey", "o_orderdate", "o_orderpriority").agg(
        F.array_sort(F.collect_list(F.struct(
            "l_linenumber", "l_suppkey", "l_partkey", "s_name", "p_name"))).alias("ls"))

    venue = F.lit(OTHER_VENUE)
    for prio, path in reversed(list(VENUE_BY_PRIORITY.items())):
        venue = F.when(F.col("o_orderpriority") == prio, F.lit(path)).otherwise(venue)

    return per_order.select(
        F.col("o_orderkey").alias("pub_id"),
        F.concat(F.array_join(F.transform("ls", lambda x: x["p_name"]), " "),
                 F.lit(".")).alias("title"),
        F.transform("ls", lambda x: x["s_name"]).alias("author"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.concat(F.lit("db/"), venue, F.lit("/"), F.col("o_orderkey").cast("string"),
                 F.lit(".html")).alias("url"),
    )


def publications_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publications as a stored Parquet table, the way the service reads them.

    Written once per application (the reference converts its bibliography to
    Parquet once, then answers every query from it); queries then scan the
    table like any other input, with column pruning and filter pushdown.
    """
    path = derive(spark, ("pubs", sf_dir), lambda p: publications(spark, sf_dir).write.parquet(p))
    return spark.read.schema(PUBLICATIONS_SCHEMA).parquet(path)


def load_log_files(spark: SparkSession, sf_dir: str, event_type: str | None = None) -> str:
    """The rendered log written as text files in ``(ts, event_id)`` order.

    A global sort writes range partitions in order, so part files follow each
    other in time and the log reads back in order by file name; lines are then
    numbered by ``ordered_lines`` without a shuffle. As a log's date is its file's,
    the files get the date of the first event as their modification date.
    """
    def write(p):
        lines = load_log_lines(spark, sf_dir, event_type)
        lines.orderBy("ts", "event_id").select("value").write.text(p)
        noon = F.to_timestamp(F.date_format(F.min("ts"), "yyyy-MM-dd 12:00:00"))
        stamp = lines.agg(F.unix_millis(noon).alias("t")).first()["t"]
        fs, folder = file_system(spark, p)
        for f in fs.listStatus(folder) if stamp is not None else ():  # one file a writing task
            fs.setTimes(f.getPath(), stamp, -1)
    return derive(spark, ("log", sf_dir, event_type or "all"), write)


def stored_log(spark: SparkSession, sf_dir: str, event_type: str, make) -> DataFrame:
    """A log as ``make(table name, path)`` stores it, once per application."""
    name = f"quire_log_{zlib.crc32(f'{sf_dir} {event_type}'.encode()):08x}"
    derive(spark, ("stored-log", sf_dir, event_type), lambda p: make(name, p))
    return spark.table(name)


def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents.text`` as ``title`` (whole texts)."""
    return spread(read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pub_id"), F.col("text").alias("title")), "pub_id")


def stop_words(spark: SparkSession, words=FIXTURE_STOP_WORDS) -> DataFrame:
    return literal_table(spark, [(w,) for w in words], "value string")


def load_log_lines(spark: SparkSession, sf_dir: str, event_type: str | None = None
                   ) -> DataFrame:
    """``events`` rendered as ``uptime`` lines: ``(ts, event_id, value)`` + text.

    Rule (fixed for the fixture): ``HH:MM:SS up <dur>, <u> user(s), load
    average: L1, L5, L15`` with ``<dur>`` from ``event_id`` (``N min`` under an
    hour, ``H:MM`` above, and every third line ``1 day, H:MM`` whose extra comma
    shifts fields), users ``user_id % 5 + 1``, ``L1 = value``, ``L5 = 2 value``,
    ``L15 = 4 value`` or ``0.00`` where ``event_id % 4 = 0``. The order key
    ``(ts, event_id)`` stays with the line so that a global ordinal can number
    the lines.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value")
    if event_type is not None:
        ev = ev.where(F.col("event_type") == event_type)
    mins = F.col("event_id") % 1440
    hm = F.format_string("%d:%02d", (mins / 60).cast("int"), (mins % 60).cast("int"))
    dur = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("1 day, "), hm))
            .when(mins < 60, F.format_string("%d min", mins.cast("int")))
            .otherwise(hm))
    users = (F.col("user_id") % 5 + 1).cast("int")
    l15 = F.when(F.col("event_id") % 4 == 0, F.lit(0.0)).otherwise(F.col("value") * 4)
    text = F.format_string(
        "%s up %s, %d %s, load average: %.2f, %.2f, %.2f",
        F.date_format("ts", "HH:mm:ss"), dur, users,
        F.when(users == 1, F.lit("user")).otherwise(F.lit("users")),
        F.col("value"), F.col("value") * 2, l15)
    return ev.select("ts", "event_id", text.alias("value"))
