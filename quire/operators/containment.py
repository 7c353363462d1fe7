"""Author lists as join keys: membership, totals and multiset containment
(F6, F7, J5, A2, A11).

The reference answers every question with a row lambda over the whole table
(or, for co-authors, one full scan per co-author). Here every question is a
join of the publications -- exploded by author name in the same scan -- with
a small table of requests:

* membership (F6): each publication is exploded over the *distinct*
  lower-cased names of its list and joined on ``name_lc``; a name listed twice
  matches once, with no aggregation.
* multiset containment (F7/J5): a request is joined on one of its names only, the
  one with the fewest publications (as in an intersection of inverted lists, which
  starts with the shortest); whether the list holds all requested names, each as often
  as asked, is then tested inside the row with array functions. Every row counts
  for itself, whatever its ``pub_id``, and nothing is grouped. A request that holds a
  name of no publication is out before the join.

Requests are small (a batch of commands), so Spark broadcasts them and the
publications are streamed through the join without a shuffle; only matches
reach an aggregation. A large request table falls back to a sort-merge join
on the name, where AQE splits a hot name.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Most requests that are broadcast.
MAX_REQUESTS = 1_000_000


def lower_names(col: str = "author"):
    return F.transform(F.filter(col, lambda a: a.isNotNull()), lambda a: F.lower(a))


def by_distinct_name(pubs: DataFrame, *keep: str) -> DataFrame:
    """``(*keep, name_lc)``: one row per publication and distinct lower-cased name."""
    return pubs.select(*keep, F.explode(F.array_distinct(lower_names())).alias("name_lc"))


def times_listed(names, name):
    """How often ``name`` stands in the array ``names``."""
    return F.size(F.filter(names, lambda x: x == name))


def holds_all(names, wanted):
    """Whether ``names`` holds every name of ``wanted`` at least as often as it does."""
    return F.forall(F.array_distinct(wanted), lambda w: times_listed(names, w) >= times_listed(wanted, w))


def author_totals(pubs: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """A2: publications per lower-cased name; a name twice in a list counts once.

    ``names`` (``name_lc``) restricts the count to those names before the
    aggregation. No shuffle precedes the map-side partial count.
    """
    ex = by_distinct_name(pubs)
    if names is not None:
        ex = ex.join(names.select("name_lc").distinct(), "name_lc", "left_semi")
    return ex.groupBy("name_lc").agg(F.count(F.lit(1)).alias("n"))


def rarest_names(requests: DataFrame, totals: DataFrame, key: str = "cmd_id") -> DataFrame:
    """``(key, names, name_lc, n)``: each request with its name of the fewest publications.

    ``totals`` is ``(name_lc, n)``. Ties go to the first name; a request without names, or with one
    that ``totals`` does not have, matches nothing and is left out.
    """
    distinct = F.array_distinct("names")
    asked = requests.select(key, "names", F.size(distinct).alias("_of"), F.explode(distinct).alias("name_lc"))
    # an inner join, so that the requests can be sent to the totals
    known = totals.select("name_lc", "n").join(asked, "name_lc")
    return known.groupBy(key, "names", "_of").agg(F.min(F.struct("n", "name_lc")).alias("least"), F.count(F.lit(1)).alias("_known")) \
        .where("_known = _of").select(key, "names", "least.name_lc", "least.n")


def entries_of(pubs: DataFrame, asked: DataFrame, key: str = "cmd_id", carry: tuple = ()) -> DataFrame:
    """``(_key, _names, _listed, pub_id, *carry)``: the publications of each request's key name ``name_lc``."""
    asked = asked.select(F.col(key).alias("_key"), F.col("names").alias("_names"), "name_lc")
    listed = lower_names()
    rows = pubs.select("pub_id", *carry, listed.alias("_listed"),
                       F.explode(F.array_distinct(listed)).alias("name_lc"))
    return rows.join(asked, "name_lc").drop("name_lc")


def containing(pubs: DataFrame, requests: DataFrame, key: str = "cmd_id",
               carry: tuple = (), totals: DataFrame | None = None, request_rows: int | None = None) -> DataFrame:
    """``(key, pub_id, *carry)`` for every publication whose list holds all
    names of a request.

    ``requests`` has ``(key, names array<string>)`` with names normalised; a
    name listed m times must occur at least m times. A request without names
    matches nothing. ``totals`` (``name_lc, n``) are the publications by name;
    by default those of the requested names are counted first, in a pass that
    sends one row a name and task. ``request_rows``, where the caller knows how
    many requests there are, lets them be broadcast up to MAX_REQUESTS; else Spark
    plans by its estimates, and AQE splits a hot name. ``carry`` columns of the
    publication ride along with the matches, so no join back to the whole table
    is needed.
    """
    if totals is None:
        totals = author_totals(pubs, requests.select(F.explode("names").alias("name_lc")))
    asked = rarest_names(requests, totals, key)
    if request_rows is not None and request_rows <= MAX_REQUESTS:  # at most one row a request
        asked = F.broadcast(asked)
    return entries_of(pubs, asked, key, carry).where(holds_all(F.col("_listed"), F.col("_names"))) \
        .select(F.col("_key").alias(key), "pub_id", *carry)


@contextmanager
def persisted(df: DataFrame):
    """Keep a table while the queries in the block read it; it is let go at the block's end."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
