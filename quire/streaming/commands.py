"""The command service, Q12.

The reference reads ``op:arg`` lines from a socket every 2 seconds and, for
each line, runs one or more Spark jobs from inside an executor task. Here a
micro-batch is answered as a set: all commands of the batch are parsed with
column expressions and joined at once against a stored author index, then
written as one tidy result:

``(cmd_file, cmd_line, op, arg, status, rank, text)``

Rank 0 is the head line the reference prints first (the count for ``author``
and ``coauthor``, the verdict for ``clique``; null for rejected commands);
ranks 1.. are the items in the reference's order. A command is keyed by its
file and line, so the answer does not depend on how lines fall into batches.

Sink: every micro-batch overwrites its own ``batch_id`` partition of a
Parquet table, so a batch replayed after a failure replaces its earlier
output (exactly once on top of the checkpointed source offsets).
"""

from __future__ import annotations

import hashlib
from collections import deque

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quire.functions.commands import STATUS_INVALID, STATUS_OK, parse_clique, parse_command
from quire.functions.text import render_article
from quire.operators.containment import author_totals, by_distinct_name, holds_all, lower_names, rarest_names
from quire.operators.ordinal import number_lines, with_global_ordinal, with_group_ordinal
from quire.plans import bibliography as bib
from quire.session import checked_broadcast, scratch_path

OUTPUT_COLUMNS = ["cmd_file", "cmd_line", "op", "arg", "status", "rank", "text"]

# Fixed value: the reference's batch interval.
TRIGGER_INTERVAL = "2 seconds"


# Most key names of a batch that are broadcast; beyond it Spark plans the join by size.
MAX_KEY_NAMES = 1_000_000

# Folders of the stored author index. A folder holds as many files as its rows
# need: rows are dealt to tasks by range, not by folder.
INDEX_BUCKETS = 256

# Entries that a task sorts: title and author list make some 400 bytes a row, so
# about 100 MB, which a task holds without spilling.
RANGE_ENTRIES = 250_000


def name_bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(INDEX_BUCKETS)).cast("int")


def author_entries(pubs: DataFrame) -> DataFrame:
    """``(bucket, name_lc, pub_id, title, year, author)``: one row per
    publication and distinct lower-cased name. No shuffle."""
    return by_distinct_name(pubs, "pub_id", "title", "year", "author") \
        .withColumn("bucket", name_bucket(F.col("name_lc")))


def source_version(pubs: DataFrame) -> str:
    """A text that changes with the table: its files' names, or its rows' hash.

    Spark gives every written file a name of its own, so a table written anew
    has other names; a frame without files is hashed in one aggregation.
    """
    files = sorted(pubs.inputFiles())
    if files:
        return hashlib.sha256("\n".join(files).encode()).hexdigest()[:24]
    n, total = pubs.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*pubs.columns).cast("decimal(38,0)"))).first()
    return f"rows-{n}-{total}"


def build_index(spark: SparkSession, pubs: DataFrame, path: str) -> str:
    """Store the author index of ``pubs`` under ``path`` unless it is there; its folder.

    The folder is named by the source's version, so a changed table gets a new
    index, and a marker is written last, so an unfinished one is not trusted.
    Entries are dealt by range of (bucket, name, publication) into tasks of about
    RANGE_ENTRIES each, at least as many as the source has splits and shuffle
    partitions: a hot name spans several files, and no task's sort grows with the
    table. Totals are one row a name; they are stored first, as their sum is the
    number of entries.
    """
    home = f"{path.rstrip('/')}/{source_version(pubs)}"
    if not _finished(spark, home):
        ranges = max(pubs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
        (author_totals(pubs).withColumn("bucket", name_bucket(F.col("name_lc")))
         .repartitionByRange(ranges, "bucket", "name_lc").sortWithinPartitions("bucket", "name_lc")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{home}/totals"))
        entries = spark.read.schema("n bigint").parquet(f"{home}/totals").agg(F.sum("n")).first()[0] or 0
        (author_entries(pubs).repartitionByRange(max(ranges, -(-entries // RANGE_ENTRIES)), "bucket", "name_lc", "pub_id")
         .sortWithinPartitions("bucket", "name_lc")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{home}/entries"))
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{home}/finished")
    return home


def in_buckets(table: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of a stored table in the buckets of ``names`` (at most INDEX_BUCKETS numbers)."""
    wanted = [r["bucket"] for r in names.select(name_bucket(F.col("name_lc")).alias("bucket")).distinct().collect()]
    return table.where(F.col("bucket").isin(wanted))


def parse_commands(numbered: DataFrame) -> DataFrame:
    """``(cmd_file, cmd_line, value)`` -> ``+ cmd_id, op, arg, status, names, min_count``."""
    p = parse_command(F.col("value"))
    cmds = numbered.select(
        "cmd_file", "cmd_line",
        F.xxhash64("cmd_file", "cmd_line").alias("cmd_id"),
        p["op"].alias("op"), p["arg"].alias("arg"), p["status"].alias("status"))
    c = parse_clique(F.col("arg"))
    # A clique argument without a well-formed ``[n]`` is invalid (quirk Z15).
    bad_clique = (F.col("op") == "clique") & (F.col("status") == STATUS_OK) & ~c["ok"]
    return cmds.select(
        "cmd_file", "cmd_line", "cmd_id", "op", "arg",
        F.when(bad_clique, F.lit(STATUS_INVALID)).otherwise(F.col("status")).alias("status"),
        c["names"].alias("names"), c["min_count"].alias("min_count"))


def answer(cmds: DataFrame, pubs: DataFrame, hold=None, totals: DataFrame | None = None,
           index: DataFrame | None = None) -> DataFrame:
    """Answer parsed commands; see the module docstring for the result.

    All three operations are one join of the batch's key names (of a clique the
    name with the fewest publications) with the exploded author lists; whether a
    list holds all names of a command is tested inside the row (``holds_all``).
    Everything after that sees matched rows only, carrying title, year and list
    along. The key names are broadcast if a count proves them few.

    ``hold`` (optional) keeps the matches for the life of the batch. ``totals``
    is the stored per-name publication count and ``index`` the stored entries;
    both are computed from ``pubs`` when absent.
    """
    ok = cmds.where(F.col("status") == STATUS_OK)
    need = ok.select("cmd_id", "op", F.when(F.col("op") == "clique", F.col("names"))
                     .otherwise(F.array("arg")).alias("wanted"))
    need = need.withColumnRenamed("wanted", "names")
    names = need.select(F.explode("names").alias("name_lc")).distinct()
    asked = author_totals(pubs, names) if totals is None else in_buckets(totals, names).drop("bucket")
    need = rarest_names(need.withColumn("key", F.struct("cmd_id", "op")).drop("cmd_id", "op"), asked, "key") \
        .select("key.cmd_id", "key.op", F.col("names").alias("wanted"), "name_lc")
    if hold is not None:  # its buckets, its size and its rows are asked for
        need = hold(need.persist(StorageLevel.MEMORY_AND_DISK))
    entries = author_entries(pubs) if index is None else in_buckets(index, need)
    found = (entries.drop("bucket").join(need if index is None else checked_broadcast(need, MAX_KEY_NAMES), "name_lc")
             .where(holds_all(lower_names(), F.col("wanted")))
             .select("cmd_id", "op", "pub_id", "title", "year", "author"))
    if hold is not None:
        found = hold(found.persist(StorageLevel.MEMORY_AND_DISK))

    # Items of all three kinds share one sort key: k1 descending, then k2, k3.
    titles = found.where(F.col("op") == "author").select(
        "cmd_id", F.col("year").alias("k1"), F.col("title").alias("k2"),
        F.col("pub_id").alias("k3"), F.col("title").alias("text"))
    arts = found.where(F.col("op") == "clique").select(
        "cmd_id", F.col("year").alias("k1"), F.col("title").alias("k2"),
        F.col("pub_id").alias("k3"), render_article("title", "author", "year").alias("text"))
    spellings = (found.where(F.col("op") == "coauthor")
                 .select("cmd_id", F.explode("author").alias("author"))
                 .where(F.col("author").isNotNull()).distinct()
                 .withColumn("name_lc", F.lower("author")))
    totals = author_totals(pubs) if totals is None else in_buckets(totals, spellings).drop("bucket")
    co = spellings.join(totals, "name_lc").select(
        "cmd_id", F.col("n").alias("k1"), F.col("author").alias("k2"),
        F.lit(0).cast("bigint").alias("k3"),
        F.concat(F.col("author"), F.lit(" : "), F.col("n").cast("string")).alias("text"))
    items = titles.unionByName(co).unionByName(arts)
    order = [F.desc("k1"), F.asc("k2"), F.asc("k3")]
    ranked = with_group_ordinal(items, ["cmd_id"], order, name="rank")
    ranked = ranked.select("cmd_id", "rank", "text")

    counts = ranked.groupBy("cmd_id").agg(F.count(F.lit(1)).alias("_n"))
    matches = found.where(F.col("op") == "clique").groupBy("cmd_id") \
        .agg(F.count(F.lit(1)).alias("_found"))
    heads = (cmds.join(counts, "cmd_id", "left").join(matches, "cmd_id", "left")
             .select("cmd_id", F.lit(0).cast("bigint").alias("rank"),
                     F.when(F.col("status") != STATUS_OK, F.lit(None).cast("string"))
                      .when(F.col("op") == "clique",
                            F.when(F.coalesce("_found", F.lit(0)) >= F.col("min_count"),
                                   F.lit("YES")).otherwise(F.lit("NO")))
                      .otherwise(F.coalesce("_n", F.lit(0)).cast("string")).alias("text")))
    keys = cmds.select("cmd_id", "cmd_file", "cmd_line", "op", "arg", "status")
    return heads.unionByName(ranked).join(keys, "cmd_id").select(*OUTPUT_COLUMNS)


class CommandService:
    """Answers batches of command lines from a stored author index."""

    def __init__(self, spark: SparkSession, pubs: DataFrame, index_path: str | None = None):
        """``index_path`` names where author indexes are kept (one folder for each
        version of the table, built if missing); by default a fresh folder
        under the shared scratch space."""
        self.spark = spark
        self.pubs = bib.non_null(pubs)
        home = build_index(spark, self.pubs, index_path or scratch_path(spark, "author-index"))
        self.index = spark.read.parquet(f"{home}/entries")
        self.totals = spark.read.parquet(f"{home}/totals")
        self._held: list[DataFrame] = []

    def answer_lines(self, numbered: DataFrame) -> DataFrame:
        """``(cmd_file, cmd_line, value)`` -> answers.

        The parsed commands feed every branch of the answer; they are kept for
        the life of the batch (``release`` drops them) so the batch is read
        and numbered once.
        """
        cmds = self._hold(parse_commands(numbered).persist(StorageLevel.MEMORY_AND_DISK))
        return answer(cmds, self.pubs, hold=self._hold, totals=self.totals, index=self.index)

    def _hold(self, df: DataFrame) -> DataFrame:
        self._held.append(df)
        return df

    def release(self) -> None:
        """Drop what the last batches kept."""
        while self._held:
            self._held.pop().unpersist()

    def close(self) -> None:
        """End of the service: drop what batches kept. The stored index stays."""
        self.release()

    def answer_files(self, path) -> DataFrame:
        """Batch form: every line of the command files under ``path``.

        The batch's intermediate frames stay persisted until ``release()``.
        """
        raw = self.spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_q_block"))
        return self.answer_lines(_numbered(raw))

    def start(self, source_dir: str, out_dir: str, checkpoint: str,
              available_now: bool = False, max_files_per_trigger: int | None = None,
              echo: int = 0, interval: str = TRIGGER_INTERVAL) -> StreamingQuery:
        """Stream form (file source; ``socket`` in ``socket_lines`` for a person).

        Runs until it is stopped, a batch every ``interval`` (M1, M6), or with ``available_now`` until the
        files that are there are answered. A stopped service goes on from its checkpoint.
        """
        reader = self.spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = reader.load(source_dir).select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_q_block"))
        return self._start(lines, out_dir, checkpoint, available_now, echo=echo, interval=interval)

    def start_titles(self, source_dir: str, out_dir: str, checkpoint: str, available_now: bool = False,
                     max_files_per_trigger: int | None = None, interval: str = TRIGGER_INTERVAL) -> StreamingQuery:
        """The ``author`` commands as one plain streaming plan (J4, M5), without ``foreachBatch``.

        Command lines are joined with the stored entries, a stream-static join without state, and appended
        to ``out_dir`` by the file sink, whose own log of committed files makes every answer appear once:
        ``(cmd_file, cmd_line, arg, pub_id, title, year)``, a row an article (``read_titles``). Lines are
        numbered within the row that a command file is read as.
        """
        reader = self.spark.readStream.format("text").option("wholetext", True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        files = reader.load(source_dir).select("value", F.col("_metadata.file_path").alias("file"))
        writer = title_stream(files, self.index).writeStream.format("parquet").outputMode("append") \
            .option("path", out_dir).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()

    def start_socket(self, host: str, port: int, out_dir: str, checkpoint: str,
                     echo: int = 0) -> StreamingQuery:
        """S5 as in the reference: lines from a socket server every 2 seconds.

        The socket source keeps no offsets that survive a restart, so commands
        are keyed per batch: ``socket-<batch_id>`` and their arrival order.
        Connects to an existing server only (not exercised in tests here).
        """
        lines = socket_lines(self.spark, host, port)
        return self._start(lines, out_dir, checkpoint, available_now=False,
                           numbering=_numbered_socket, echo=echo)

    def _start(self, lines: DataFrame, out_dir: str, checkpoint: str,
               available_now: bool, numbering=None, echo: int = 0, interval: str = TRIGGER_INTERVAL) -> StreamingQuery:
        number = numbering or (lambda batch, _batch_id: _numbered(batch))

        def each_batch(batch: DataFrame, batch_id: int) -> None:
            answers = self.answer_lines(number(batch, batch_id))
            try:
                (answers.withColumn("batch_id", F.lit(batch_id))
                        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                        .partitionBy("batch_id").parquet(out_dir))
                if echo:
                    # K9: what the reference prints, for a person watching;
                    # a display of the first ``echo`` lines only.
                    (self.spark.read.parquet(out_dir).where(F.col("batch_id") == batch_id)
                     .orderBy("cmd_file", "cmd_line", "rank")
                     .select("cmd_line", "op", "arg", "status", "rank", "text")
                     .show(echo, truncate=False))
            finally:
                self.release()

        writer = (lines.writeStream.foreachBatch(each_batch)
                  .option("checkpointLocation", checkpoint))
        writer = writer.trigger(availableNow=True) if available_now \
            else writer.trigger(processingTime=interval)
        return writer.start()


class Progress(StreamingQueryListener):
    """What a running service reports: the last ``keep`` batches that read lines, oldest first.

    Added with ``spark.streams.addListener``. ``batches`` holds ``(batch id, input rows, milliseconds by phase)``;
    ``ended`` the error (or None) of every query that came to its end.
    """

    def __init__(self, keep: int = 1_000):
        self.batches: deque = deque(maxlen=keep)
        self.ended: list = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.numInputRows:
            self.batches.append((p.batchId, p.numInputRows, dict(p.durationMs)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.append(event.exception)


def title_stream(files: DataFrame, entries: DataFrame) -> DataFrame:
    """The answers to the ``author`` commands of whole command files ``(value, file)``, batch or stream."""
    lines = files.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("at", "value"))
    cmds = parse_commands(lines.select(F.col("file").alias("cmd_file"), (F.col("at") + 1).cast("bigint").alias("cmd_line"), "value"))
    asked = cmds.where((F.col("op") == "author") & (F.col("status") == STATUS_OK)).select(
        "cmd_file", "cmd_line", "arg", F.col("arg").alias("name_lc"), name_bucket(F.col("arg")).alias("bucket"))
    return asked.join(entries, ["bucket", "name_lc"]).select("cmd_file", "cmd_line", "arg", "pub_id", "title", "year")


def read_titles(spark: SparkSession, out_dir: str) -> DataFrame:
    """What ``start_titles`` has committed; files of an unfinished batch are not in the sink's log."""
    return spark.read.parquet(out_dir)


def _numbered(raw: DataFrame) -> DataFrame:
    """Line numbers per command file; the file's whole path keys a command."""
    n = number_lines(raw, per_file=True)
    return n.select(F.col("file").alias("cmd_file"), F.col("line_no").alias("cmd_line"), "value")


def _numbered_socket(batch: DataFrame, batch_id: int) -> DataFrame:
    """Socket lines keyed by batch and arrival (timestamp, then position)."""
    ordered = with_global_ordinal(
        batch.withColumn("_q_arrival", F.monotonically_increasing_id()),
        [F.col("timestamp"), F.col("_q_arrival")], name="cmd_line")
    return ordered.select(F.lit(f"socket-{batch_id}").alias("cmd_file"), "cmd_line", "value")


def _finished(spark: SparkSession, home: str) -> bool:
    """Whether the index in ``home`` was written to its end."""
    try:
        return spark.read.parquet(f"{home}/finished").count() == 1
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """The reference's socket source. Opens a client connection to an
    existing server; not used in tests (no port is opened here)."""
    return (spark.readStream.format("socket").option("host", host).option("port", port)
            .option("includeTimestamp", "true").load())


def read_answers(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(out_dir).select(*OUTPUT_COLUMNS)
