"""Command line for the everyday workflows: ``python -m quire <command> ...``.

  top         XML -> selected venues -> top authors and top title words, each
              written as one ranked text file (Q2, Q4, Q5, Q6, K2)
  to-parquet  XML -> publications as Parquet (Q3)
  serve       answer command files (or a socket) against a Parquet table (Q12)
  log-report  one load log -> ordered text report (Q13, Q14, K8)
  log-skew    two load logs -> seconds of B minus A per line (Q15)

The session comes from ``SparkSession.builder.getOrCreate()``, so
``spark-submit`` settings apply; nothing here changes them.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from quire.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName("quire").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def cmd_top(a) -> None:
    from quire.plans import bibliography as bib
    from quire.sinks.text import ranked_text_file
    from quire.sources.xml import load_publications
    spark = _session()
    subset = bib.select_venues(load_publications(spark, a.xml), min_year=a.min_year,
                               venues=tuple(a.venue))
    ranked_text_file(bib.top_authors(subset, k=a.k), f"{a.out}/authors", name="author")
    stop = spark.read.text(a.stop) if a.stop else None
    ranked_text_file(bib.top_words(subset, stop, k=a.k), f"{a.out}/words", name="word")


def cmd_to_parquet(a) -> None:
    from quire.sources.xml import load_publications
    spark = _session()
    load_publications(spark, a.xml).write.mode("overwrite").parquet(a.out)


def cmd_serve(a) -> None:
    from quire.streaming.commands import CommandService
    spark = _session()
    service = CommandService(spark, spark.read.parquet(a.publications))
    if a.socket:
        host, port = a.socket.rsplit(":", 1)
        query = service.start_socket(host, int(port), a.out, a.checkpoint, echo=a.echo)
    else:
        query = service.start(a.commands, a.out, a.checkpoint,
                              available_now=a.once, echo=a.echo)
    query.awaitTermination()
    service.close()


def _dated(spark, path, date):
    from quire.operators.ordinal import ordered_lines
    from quire.plans import loadlog
    log_date = date or loadlog.file_date(spark, path) or "1970-01-01"
    lines = ordered_lines(spark, path).select("line_no", "value")
    return loadlog.with_day_roll(loadlog.parse_load_log(lines), log_date)


def cmd_log_report(a) -> None:
    from quire.plans import loadlog
    spark = _session()
    loadlog.write_report(loadlog.log_report(_dated(spark, a.log, a.date)), a.out)


def cmd_log_skew(a) -> None:
    from quire.plans import loadlog
    spark = _session()
    loadlog.log_skew(_dated(spark, a.a, a.date_a), _dated(spark, a.b, a.date_b)) \
        .write.mode("overwrite").parquet(a.out)


def main(argv=None) -> int:
    from quire.plans.bibliography import DEFAULT_MIN_YEAR, DEFAULT_VENUES
    p = argparse.ArgumentParser(prog="python -m quire")
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("top", help="top authors and title words as ranked text files")
    t.add_argument("--xml", required=True)
    t.add_argument("--stop", help="stop-word file, one word per line")
    t.add_argument("--out", required=True)
    t.add_argument("--k", type=int, default=100)
    t.add_argument("--min-year", type=int, default=DEFAULT_MIN_YEAR)
    t.add_argument("--venue", action="append", default=None)
    t.set_defaults(fn=cmd_top)

    q = sub.add_parser("to-parquet", help="XML publications to Parquet")
    q.add_argument("--xml", required=True)
    q.add_argument("--out", required=True)
    q.set_defaults(fn=cmd_to_parquet)

    s = sub.add_parser("serve", help="answer author/coauthor/clique commands")
    s.add_argument("--publications", required=True, help="Parquet from to-parquet")
    s.add_argument("--commands", help="directory of command files")
    s.add_argument("--socket", help="host:port of an existing line server")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="answer what is there, then stop")
    s.add_argument("--echo", type=int, default=0, help="print up to N answer lines per batch")
    s.set_defaults(fn=cmd_serve)

    r = sub.add_parser("log-report", help="line count, span, positive loads, even lines")
    r.add_argument("--log", required=True)
    r.add_argument("--date", help="date of the first line (default: file modification date)")
    r.add_argument("--out", required=True)
    r.set_defaults(fn=cmd_log_report)

    k = sub.add_parser("log-skew", help="per-line time difference of two logs")
    k.add_argument("--a", required=True)
    k.add_argument("--b", required=True)
    k.add_argument("--date-a")
    k.add_argument("--date-b")
    k.add_argument("--out", required=True)
    k.set_defaults(fn=cmd_log_skew)

    a = p.parse_args(argv)
    if getattr(a, "venue", None) is None and a.cmd == "top":
        a.venue = list(DEFAULT_VENUES)
    if a.cmd == "serve" and not (a.commands or a.socket):
        p.error("serve needs --commands or --socket")
    a.fn(a)
    from quire.session import clear_scratch
    clear_scratch(_session())
    return 0


if __name__ == "__main__":
    sys.exit(main())
