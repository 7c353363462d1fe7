"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables through the fixture adapters, over whole
tables, and returns a tidy result: arrays leave as text, counts and years are
bigint, every computed column carries the alias its SQL oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.containment import author_totals, persisted
from quire.operators.ordinal import ordered_lines
from quire.plans import bibliography as bib
from quire.plans import copying, generate, loadlog
from quire.session import derive, read_table, scratch_path
from quire.sinks.keyed import KeyedTable
from quire.sources import fixtures
from quire.sources.literal import literal_table
from quire.sources import xml as xmlsrc

# The name asked about by the single-name entries (any case),
# and the clique arguments of the clique entries.
PROBE_NAME = "supplier#000000066"
CLIQUE_ARGS = (
    "supplier#000000066, supplier#000000060[2]",
    "supplier#000000066,supplier#000000066[1]",
    "supplier#000000027 , supplier#000000042 [3]",
    "supplier#000000001[1000000]",
    "nobody at all[0]",
    "nobody at all[1]",
    "supplier#000000048",
)


def _pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.non_null(fixtures.publications_table(spark, sf_dir))


def q_publications(spark, sf_dir):
    return bib.publications_text(fixtures.publications(spark, sf_dir))


def q_select_venues(spark, sf_dir):
    return bib.publications_text(bib.select_venues(fixtures.publications_table(spark, sf_dir)))


# Fixed value: the string predicate of the F2 entry.
VENUE_PREDICATE = "year between 1994 and 1997 and url like 'db/%' and length(title) > 40"


def q_select_predicate(spark, sf_dir):
    """publications by a predicate given as a SQL string."""
    pubs = fixtures.publications_table(spark, sf_dir)
    return bib.publications_text(bib.select_venues(pubs, predicate=VENUE_PREDICATE))


def q_top_authors(spark, sf_dir):
    return bib.top_authors(bib.select_venues(fixtures.publications_table(spark, sf_dir)), k=100)


def q_top_authors_text(spark, sf_dir):
    """K2 + S4: the top list written as one text file and read back in line order."""
    from quire.sinks.text import ranked_text_file
    top = bib.top_authors(bib.select_venues(fixtures.publications_table(spark, sf_dir)), k=100)
    path = ranked_text_file(top, scratch_path(spark, "top-authors"), name="author")
    return ordered_lines(spark, path).select(F.col("line_no").alias("rank"),
                                             F.col("value").alias("author"))


def q_top_words(spark, sf_dir):
    subset = bib.select_venues(fixtures.publications_table(spark, sf_dir))
    return bib.top_words(subset, fixtures.stop_words(spark), k=100,
                         stop_rows=len(fixtures.FIXTURE_STOP_WORDS))


def q_top_words_documents(spark, sf_dir):
    return bib.top_words(fixtures.document_titles(spark, sf_dir),
                         fixtures.stop_words(spark), k=100,
                         stop_rows=len(fixtures.FIXTURE_STOP_WORDS))


def q_author_titles(spark, sf_dir):
    return bib.author_titles(spark, _pubs(spark, sf_dir), PROBE_NAME)


def q_author_titles_all(spark, sf_dir):
    """Q7 for every author at once.

    Every (distinct name, publication) pair of the exploded lists is already
    an answer row, so no request table is joined; only the ranking shuffles.
    """
    from quire.operators.containment import by_distinct_name
    rows = by_distinct_name(_pubs(spark, sf_dir), "pub_id", "title", "year") \
        .withColumnRenamed("name_lc", "cmd_id")
    ranked = bib.ranked_titles(rows)
    return ranked.select(F.col("cmd_id").alias("name"), "rank", "title", "year", "pub_id")


def q_article_sum(spark, sf_dir):
    return bib.article_sum(spark, _pubs(spark, sf_dir), PROBE_NAME)


def q_author_totals(spark, sf_dir):
    return author_totals(_pubs(spark, sf_dir)).select(F.col("name_lc").alias("name"), "n")


def q_coauthor_totals(spark, sf_dir):
    return bib.coauthor_totals(spark, _pubs(spark, sf_dir), PROBE_NAME)


def _clique_batch(spark, sf_dir):
    pubs = _pubs(spark, sf_dir)
    cmds = literal_table(spark, [(i, a) for i, a in enumerate(CLIQUE_ARGS)],
                         "cmd_id bigint, arg string")
    # the lengths of the names' lists are stored once, as an inverted index has them
    totals = derive(spark, ("author-totals", sf_dir), lambda path: author_totals(pubs).write.parquet(path))
    return bib.clique_requests(cmds), pubs, spark.read.schema("name_lc string, n bigint").parquet(totals)


def q_clique_check(spark, sf_dir):
    req, pubs, totals = _clique_batch(spark, sf_dir)
    verdicts, _ = bib.cliques_for(req, pubs, totals, len(CLIQUE_ARGS))
    invalid = req.where(~F.col("ok")).select(
        "cmd_id", F.lit(None).cast("bigint").alias("matches"),
        F.lit("invalid input").alias("verdict"))
    return verdicts.unionByName(invalid)


def q_clique_articles(spark, sf_dir):
    req, pubs, totals = _clique_batch(spark, sf_dir)
    _, articles = bib.cliques_for(req, pubs, totals, len(CLIQUE_ARGS))
    ranked = bib.ranked_titles(articles)
    from quire.functions.text import render_article
    return ranked.select("cmd_id", "rank", "pub_id",
                         render_article("title", "author", "year").alias("text"))


# The two hosts of the skew query (event types of ``events``).
HOST_A, HOST_B = "click", "view"


def _dated_log(spark, sf_dir, event_type=None):
    """Fixture log file -> numbered in file order (S4) -> parsed -> dated by its file."""
    path = fixtures.load_log_files(spark, sf_dir, event_type)
    lines = ordered_lines(spark, path).select("line_no", "value")
    return loadlog.with_day_roll(loadlog.parse_load_log(lines), loadlog.file_date(spark, path) or "1970-01-01")


def q_log_files(spark, sf_dir):
    """Length and date of each log, from the listing of its files."""
    out = None
    for log, event_type in (("all", None), (HOST_A, HOST_A), (HOST_B, HOST_B)):
        facts = loadlog.log_facts(spark, fixtures.load_log_files(spark, sf_dir, event_type)) \
            .select(F.lit(log).alias("log"), "bytes", F.date_format("date", "yyyy-MM-dd").alias("date"))
        out = facts if out is None else out.unionByName(facts)
    return out


def q_parse_load_log(spark, sf_dir):
    return _dated_log(spark, sf_dir).select(
        "line_no", "ts_sec", "uptime", "users", "load1", "load5", "load15")


def q_log_report(spark, sf_dir):
    return loadlog.log_report(_dated_log(spark, sf_dir))


def q_log_report_text(spark, sf_dir):
    """K8: the ordered text report, written and read back in line order."""
    path = loadlog.write_report(loadlog.log_report(_dated_log(spark, sf_dir)), scratch_path(spark, "report"))
    return ordered_lines(spark, path).select("line_no", "value")


# Fixed value: buckets of the stored logs.
LOG_BUCKETS = 32


def q_log_skew(spark, sf_dir):
    """Q15 over two logs stored by line number (J3): the zip moves no line."""
    a, b = (fixtures.stored_log(spark, sf_dir, host, lambda name, path, host=host: loadlog.store_log(
        _dated_log(spark, sf_dir, host).select("line_no", "ts_sec"), name, path, LOG_BUCKETS))
        for host in (HOST_A, HOST_B))
    return loadlog.log_skew(a, b)


# Set width and stride of the keyed sets; the part count of the
# copy entries.
SET_WIDTH, SET_STRIDE = 1000, 1001
COPY_PARTS = 8
COPY_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_repeated_ints(spark, sf_dir):
    """Q16 over a table: every order key repeated as often as it has lines."""
    runs = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("times"))
    return generate.run_length_expand(runs.select(F.col("l_orderkey").cast("int").alias("v"), "times"), "v", "times")


def q_int_sets(spark, sf_dir):
    """Q17 over a table: keyed sets of the part keys of all lines (which start at 0), counted from 1."""
    values = read_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + 1).alias("v"))
    return generate.set_summary(generate.int_sets(values, SET_WIDTH, SET_STRIDE))


def q_chunk_plan(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return copying.chunk_plan(spark, orders, ["o_orderkey"], "o_orderkey")


def q_range_copy(spark, sf_dir):
    dest = scratch_path(spark, "range-copy")
    lineitem = read_table(spark, sf_dir, "lineitem")
    copying.range_copy(lineitem, COPY_KEYS, COPY_PARTS, dest)
    return copying.read_copy(spark, dest, lineitem.columns)


def q_range_copy_parts(spark, sf_dir):
    """Q19: the exact slices of a copy, read back part by part."""
    dest = copying.slice_copy(read_table(spark, sf_dir, "orders"), ["o_orderkey"], COPY_PARTS,
                              scratch_path(spark, "slice-copy"))
    return copying.part_ranges(spark, dest, "o_orderkey")


# Fixed value: buckets of the keyed tables of the entries.
KEYED_BUCKETS = 16


def _keyed_prices(spark, sf_dir):
    """K4, K5: order prices as a keyed table, then replaced by the last returned line's price."""
    prices = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.lit(0).cast("bigint").alias("line"), F.col("o_totalprice").alias("price"))
    table = KeyedTable.create(prices, scratch_path(spark, "keyed"), "key", KEYED_BUCKETS)
    returned = read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_extendedprice").alias("price"))
    return table.upsert(returned, order=["line", "price"])


def q_keyed_upsert(spark, sf_dir):
    """K4, K5: the keyed table after an upsert, through the session's catalog."""
    return _keyed_prices(spark, sf_dir).register("quire_keyed_prices").drop("key_bucket")


def q_keyed_lookup(spark, sf_dir):
    """The rows of the orders that hold a line of the greatest quantity, looked up by key."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    most = lines.agg(F.max("l_quantity").alias("l_quantity"))
    return _keyed_prices(spark, sf_dir).lookup(lines.join(F.broadcast(most), "l_quantity", "left_semi").select("l_orderkey"))


def q_keyed_copy(spark, sf_dir):
    """Q19 over a keyed table (S6, K4, K5): keyed sets read by key from one table and put into another."""
    values = read_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + 1).alias("v"))
    source = KeyedTable.create(generate.int_sets(values, SET_WIDTH, SET_STRIDE), scratch_path(spark, "sets"), "i", KEYED_BUCKETS)
    dest = KeyedTable.create(source.read().limit(0), scratch_path(spark, "sets-copy"), "i", KEYED_BUCKETS)
    return generate.set_summary(dest.upsert(source.scan(0)).scan())


def _sweep(spark, sf_dir):
    return copying.copy_sweep(spark, read_table(spark, sf_dir, "lineitem"), COPY_KEYS, scratch_path(spark, "sweep"))


def q_copy_sweep(spark, sf_dir):
    """Q20: what was observed of each copy of the sweep."""
    return _sweep(spark, sf_dir).select("n", "rows", "key_sum", "same")


def q_copy_timings(spark, sf_dir):
    """Q20: the time of each copy of the sweep, the result the reference prints."""
    return _sweep(spark, sf_dir).select("n", "tasks", "rows", "millis")


def q_ordered_append(spark, sf_dir):
    """K7: orders copied in three batches of ascending keys, each appended, and read back by position."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    ends = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 1]
    dest = scratch_path(spark, "appended")
    for begin, end in zip(cuts, cuts[1:]):
        batch = orders.where((F.col("o_orderkey") >= begin) & (F.col("o_orderkey") < end))
        copying.append_copy(batch, "o_orderkey", COPY_PARTS, dest)
    return copying.read_in_order(spark, dest).select("position", "o_orderkey", "o_custkey", "o_totalprice")


def q_table_size(spark, sf_dir):
    return copying.table_size(read_table(spark, sf_dir, "lineitem"))


def _fixture_xml(spark, sf_dir) -> str:
    """Render the publications adapter as XML text files under scratch space."""
    dest = scratch_path(spark, "pubs-xml")
    xmlsrc.render_records(fixtures.publications_table(spark, sf_dir)).select("value") \
        .write.mode("overwrite").text(dest)
    return dest


def q_xml_publications(spark, sf_dir):
    pubs = xmlsrc.load_publications(spark, _fixture_xml(spark, sf_dir))
    return pubs.select("pub_key", "title", F.concat_ws(",", "author").alias("authors"),
                       "year", "url")


def q_retag_records(spark, sf_dir):
    src = _fixture_xml(spark, sf_dir)
    dest = xmlsrc.retag_lines(spark, src, scratch_path(spark, "pubs-xml-retagged"))
    recs = xmlsrc.xml_records(spark, dest, kinds=(xmlsrc.UNIFIED,))
    return recs.select(
        F.regexp_extract("xml", r'^<\w+[^>]*?\skey="([^"]*)"', 1).alias("pub_key"), "xml")


def q_parquet_roundtrip(spark, sf_dir):
    """Publications to Parquet and back, kept while two queries read them."""
    dest, text = scratch_path(spark, "pubs-parquet"), scratch_path(spark, "pubs-text")
    fixtures.publications(spark, sf_dir).write.mode("overwrite").parquet(dest)
    with persisted(spark.read.parquet(dest)) as kept:
        n = kept.count()
        bib.publications_text(kept).withColumn("_of", F.lit(n)).write.parquet(text)
    return spark.read.parquet(text).drop("_of")


# The command lines of the service entry (one file, in order).
COMMAND_LINES = (
    "author: Supplier#000000066",
    "foo:bar",
    "author:",
    "coauthor:supplier#000000060  :ignored",
    "clique:supplier#000000066, supplier#000000060[2]",
    "",
    "AUTHOR:  supplier#000000027",
    "clique:supplier#000000066,supplier#000000066[1]",
    "clique:nobody[0]",
    "clique:supplier#000000048",
    "coauthor: nobody",
    "clique : Supplier#000000027 , supplier#000000042 [3]",
)


def _index_path(spark, sf_dir) -> str:
    """One stored author index per application and input, like the table it
    indexes: the service builds it on first use and later runs reuse it."""
    return derive(spark, ("author-index", sf_dir), lambda path: None)


def q_answer_commands(spark, sf_dir):
    """Q12 through Structured Streaming: the command file is the stream's input."""
    from quire.streaming.commands import CommandService, read_answers
    src = scratch_path(spark, "commands")
    spark.createDataFrame([(c,) for c in COMMAND_LINES], "value string") \
        .coalesce(1).write.text(src)
    service = CommandService(spark, fixtures.publications_table(spark, sf_dir),
                             index_path=_index_path(spark, sf_dir))
    out, ckpt = scratch_path(spark, "answers"), scratch_path(spark, "answers-ckpt")
    query = service.start(src, out, ckpt, available_now=True)
    query.awaitTermination()
    service.close()
    return read_answers(spark, out).drop("cmd_file")


def q_stream_titles(spark, sf_dir):
    """The ``author`` commands as a plain stream-static join into a file sink."""
    from quire.streaming.commands import CommandService, read_titles
    src = scratch_path(spark, "commands")
    spark.createDataFrame([(c,) for c in COMMAND_LINES], "value string").coalesce(1).write.text(src)
    service = CommandService(spark, fixtures.publications_table(spark, sf_dir), index_path=_index_path(spark, sf_dir))
    out = scratch_path(spark, "titles")
    service.start_titles(src, out, scratch_path(spark, "titles-ckpt"), available_now=True).awaitTermination()
    return read_titles(spark, out).drop("cmd_file")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "retag_records": q_retag_records,
    "xml_publications": q_xml_publications,
    "parquet_roundtrip": q_parquet_roundtrip,
    "publications": q_publications,
    "select_venues": q_select_venues,
    "select_predicate": q_select_predicate,
    "top_authors": q_top_authors,
    "top_authors_text": q_top_authors_text,
    "top_words": q_top_words,
    "top_words_documents": q_top_words_documents,
    "author_titles": q_author_titles,
    "author_titles_all": q_author_titles_all,
    "article_sum": q_article_sum,
    "author_totals": q_author_totals,
    "coauthor_totals": q_coauthor_totals,
    "clique_check": q_clique_check,
    "clique_articles": q_clique_articles,
    "parse_load_log": q_parse_load_log,
    "log_report": q_log_report,
    "log_report_text": q_log_report_text,
    "log_skew": q_log_skew,
    "log_files": q_log_files,
    "answer_commands": q_answer_commands,
    "stream_titles": q_stream_titles,
    "repeated_ints": q_repeated_ints,
    "int_sets": q_int_sets,
    "chunk_plan": q_chunk_plan,
    "range_copy": q_range_copy,
    "range_copy_parts": q_range_copy_parts,
    "keyed_upsert": q_keyed_upsert,
    "keyed_lookup": q_keyed_lookup,
    "keyed_copy": q_keyed_copy,
    "copy_sweep": q_copy_sweep,
    "copy_timings": q_copy_timings,
    "ordered_append": q_ordered_append,
    "table_size": q_table_size,
}
