"""Bibliography queries Q4-Q11.

Every question is asked of a *request table* -- ``(cmd_id, ...)`` rows -- so
that one call answers one name or a whole batch of commands with the same
joins (no per-name job, no collect). The single-name helpers wrap one request.

Input: ``pubs`` ``(pub_id, title, author array<string>, year, url)`` after F5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.commands import parse_clique
from quire.functions.text import render_article, render_author_list, title_tokens
from quire.operators.containment import author_totals, by_distinct_name, containing
from quire.operators.ordinal import with_group_ordinal
from quire.operators.topk import top_k
from quire.session import checked_broadcast
from quire.sources.literal import literal_table

# The venue keys and first year of the batch part.
DEFAULT_VENUES = ("conf/sigmod", "conf/icde", "journals/pvldb")
DEFAULT_MIN_YEAR = 2000

# Largest stop list that is broadcast (it is a word list, counted first).
MAX_STOP_WORDS = 1_000_000

# Newest first; title and pub_id make the order total.
def title_order() -> list:
    return [F.desc("year"), F.asc("title"), F.asc("pub_id")]


def non_null(pubs: DataFrame) -> DataFrame:
    """title, author and year all present; an empty list counts as absent."""
    return pubs.where(F.col("title").isNotNull() & F.col("year").isNotNull()
                      & F.col("author").isNotNull() & (F.size("author") > 0))


def select_venues(pubs: DataFrame, min_year: int = DEFAULT_MIN_YEAR,
                  venues=DEFAULT_VENUES, predicate: str | None = None) -> DataFrame:
    """Q4 (F2-F4, F5): from ``min_year`` on, url containing any venue key.

    ``predicate`` (F2) replaces the built one with an arbitrary SQL string.
    Written as Columns, so year and url filters reach the Parquet scan.
    """
    if predicate is None:
        venue_any = None
        for v in venues:
            term = F.col("url").contains(v)
            venue_any = term if venue_any is None else (venue_any | term)
        cond = F.col("year") >= min_year
        if venue_any is not None:
            cond = cond & venue_any
        out = pubs.where(cond)
    else:
        out = pubs.where(predicate)
    return non_null(out)


def top_authors(pubs: DataFrame, k: int = 100) -> DataFrame:
    """Q5: ``(rank, author, n)``; counts occurrences, so a name twice in a list counts twice."""
    counts = (pubs.select(F.explode("author").alias("author"))
                  .where(F.col("author").isNotNull())
                  .groupBy("author").agg(F.count(F.lit(1)).alias("n")))
    return top_k(counts, k, [F.desc("n"), F.asc("author")]).select("rank", "author", "n")


def title_words(titles: DataFrame, stop: DataFrame | None = None,
                keep_empty: bool = False, stop_rows: int | None = None) -> DataFrame:
    """Q6 tokens: ``word`` per token of every title, stop words removed.

    Removing stop words is a left anti join, duplicates on the left kept
    (``subtract`` semantics); the stop list is lower-cased, not trimmed, and
    broadcast after a count -- or directly when the caller knows its size
    (``stop_rows``, e.g. a list built from driver-side literals).
    """
    words = titles.select(F.explode(title_tokens("title")).alias("word"))
    if not keep_empty:
        words = words.where(F.col("word") != "")
    if stop is not None:
        stop_lc = stop.select(F.lower(F.col(stop.columns[0])).alias("word")).distinct()
        small = (F.broadcast(stop_lc) if stop_rows is not None and stop_rows <= MAX_STOP_WORDS
                 else checked_broadcast(stop_lc, MAX_STOP_WORDS))
        words = words.join(small, "word", "left_anti")
    return words


def top_words(titles: DataFrame, stop: DataFrame | None = None, k: int = 100,
              keep_empty: bool = False, stop_rows: int | None = None) -> DataFrame:
    """Q6: ``(rank, word, n)``."""
    counts = (title_words(titles, stop, keep_empty, stop_rows)
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    return top_k(counts, k, [F.desc("n"), F.asc("word")]).select("rank", "word", "n")


# --- request-table forms -------------------------------------------------------

def _name_requests(spark: SparkSession, names) -> DataFrame:
    rows = [(i, n.lower()) for i, n in enumerate(names)]
    return literal_table(spark, rows, "cmd_id bigint, name_lc string")


def titles_for(requests: DataFrame, pubs: DataFrame) -> DataFrame:
    """Q7 rows: ``(cmd_id, pub_id, title, year, author)`` for every request name.

    F6: whole-name equality on lower-cased names; a publication listing the
    name twice appears once (its names are made distinct before the join).
    """
    ex = by_distinct_name(pubs, "pub_id", "title", "year", "author")
    return requests.select("cmd_id", "name_lc").join(ex, "name_lc") \
        .select("cmd_id", "pub_id", "title", "year", "author")


def ranked_titles(rows: DataFrame) -> DataFrame:
    """T1 + W2: rank within each request, newest first (skew-safe ordinal)."""
    return with_group_ordinal(rows, ["cmd_id"], title_order(), name="rank")


def coauthors_for(requests: DataFrame, pubs: DataFrame, totals: DataFrame | None = None
                  ) -> DataFrame:
    """Q9 rows: ``(cmd_id, author, n)``.

    Distinct spellings (case-sensitive, A9) of everybody on a publication of the
    requested name -- the name itself included -- each with its own total (A2)
    of the lower-cased spelling (J2: one join in place of one scan per
    co-author). ``totals`` (``name_lc, n``) is the per-name count. By default all
    names are counted, one partial row a name and task: to count the co-authors
    only, their spellings would have to be found twice. A service passes its
    stored table.
    """
    ex = by_distinct_name(pubs, "author")
    spellings = (requests.select("cmd_id", "name_lc").join(ex, "name_lc")
                 .select("cmd_id", F.explode("author").alias("author"))
                 .where(F.col("author").isNotNull())
                 .distinct()
                 .withColumn("name_lc", F.lower("author")))
    if totals is None:
        totals = author_totals(pubs)
    return spellings.join(totals, "name_lc").select("cmd_id", "author", "n")


def clique_requests(commands: DataFrame) -> DataFrame:
    """Parse ``(cmd_id, arg)`` clique arguments into ``(cmd_id, names, min_count, ok)``."""
    p = parse_clique(F.col("arg"))
    return commands.select("cmd_id", p["names"].alias("names"),
                           p["min_count"].alias("min_count"), p["ok"].alias("ok"))


def cliques_for(requests: DataFrame, pubs: DataFrame, totals: DataFrame | None = None,
                request_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Q10 + Q11 for valid requests ``(cmd_id, names, min_count)``.

    Each request is joined on its rarest name, by ``totals`` (``name_lc, n``) or a count of the
    requested names.

    Returns ``verdicts (cmd_id, matches, verdict)`` -- a left join so that a
    request with no match still answers (A11) -- and
    ``articles (cmd_id, pub_id, title, author, year)``.
    """
    valid = requests.where("ok").select("cmd_id", "names", "min_count")
    found = containing(pubs, valid.select("cmd_id", "names"),
                       carry=("title", "author", "year"), totals=totals, request_rows=request_rows)
    counts = found.groupBy("cmd_id").agg(F.count(F.lit(1)).alias("matches"))
    verdicts = (valid.join(counts, "cmd_id", "left")
                .select("cmd_id", F.coalesce("matches", F.lit(0)).alias("matches"),
                        F.when(F.coalesce("matches", F.lit(0)) >= F.col("min_count"),
                               F.lit("YES")).otherwise(F.lit("NO")).alias("verdict")))
    return verdicts, found


# --- single-request helpers (the reference's API) -------------------------------

def author_titles(spark: SparkSession, pubs: DataFrame, name: str) -> DataFrame:
    """Q7: ``(rank, title, year, pub_id)`` of ``name``, newest first; count = rows."""
    rows = titles_for(_name_requests(spark, [name]), pubs)
    return ranked_titles(rows).select("rank", "title", "year", "pub_id")


def article_sum(spark: SparkSession, pubs: DataFrame, name: str) -> DataFrame:
    """Q8: ``(name, n)``: publications listing ``name`` (any case)."""
    req = _name_requests(spark, [name])
    n = req.join(by_distinct_name(pubs), "name_lc").groupBy("cmd_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return req.join(n, "cmd_id", "left").select(
        F.col("name_lc").alias("name"), F.coalesce("n", F.lit(0)).alias("n"))


def coauthor_totals(spark: SparkSession, pubs: DataFrame, name: str) -> DataFrame:
    """Q9: ``(author, n)``, largest n first."""
    rows = coauthors_for(_name_requests(spark, [name]), pubs)
    return rows.select("author", "n").orderBy(F.desc("n"), "author")


def clique(spark: SparkSession, pubs: DataFrame, arg: str) -> tuple[DataFrame, DataFrame]:
    """Q10/Q11 for one argument ``names[n]``: (verdict row, ranked articles)."""
    cmds = literal_table(spark, [(0, arg.lower())], "cmd_id bigint, arg string")
    verdicts, articles = cliques_for(clique_requests(cmds), pubs, request_rows=1)
    ranked = with_group_ordinal(articles, ["cmd_id"], title_order(), name="rank")
    return verdicts, ranked.select(
        "rank", render_article("title", "author", "year").alias("text"))


def publications_text(pubs: DataFrame) -> DataFrame:
    """Publications with the author list as text (for result comparison)."""
    return pubs.select("pub_id", "title", render_author_list("author").alias("authors"),
                       "year", "url")
