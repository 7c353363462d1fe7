"""DuckDB SQL for every registered query that has a SQL form.

Written from the query semantics, independently of the Spark code: the same
fixture rules, list functions in place of the author index, window functions
in place of the skew-safe ordinals.
"""

from __future__ import annotations

from quire.plans.catalog import (CLIQUE_ARGS, COMMAND_LINES, COPY_PARTS, HOST_A, HOST_B, PROBE_NAME,
                                 SET_STRIDE, SET_WIDTH, VENUE_PREDICATE)
from quire.plans.copying import SWEEP
from quire.sources.fixtures import FIXTURE_STOP_WORDS


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PUBS = """
pubs AS (
  SELECT o.o_orderkey AS pub_id,
         string_agg(p.p_name, ' ' ORDER BY l.l_linenumber, l.l_suppkey, l.l_partkey) || '.' AS title,
         list(s.s_name ORDER BY l.l_linenumber, l.l_suppkey, l.l_partkey) AS author,
         CAST(year(o.o_orderdate) AS BIGINT) AS year,
         'db/' || CASE o.o_orderpriority WHEN '1-URGENT' THEN 'conf/sigmod'
                                          WHEN '2-HIGH' THEN 'conf/icde'
                                          WHEN '3-MEDIUM' THEN 'journals/pvldb'
                                          ELSE 'conf/other' END
               || '/' || CAST(o.o_orderkey AS VARCHAR) || '.html' AS url
  FROM orders o
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN part p ON p.p_partkey = l.l_partkey
  GROUP BY o.o_orderkey, o.o_orderdate, o.o_orderpriority
),
nn AS (
  SELECT * FROM pubs
  WHERE title IS NOT NULL AND author IS NOT NULL AND len(author) > 0 AND year IS NOT NULL
),
sel AS (
  SELECT * FROM nn
  WHERE year >= 2000 AND (url LIKE '%conf/sigmod%' OR url LIKE '%conf/icde%'
                          OR url LIKE '%journals/pvldb%')
),
idx AS (
  SELECT pub_id, lower(a) AS name_lc, count(*) AS have
  FROM (SELECT pub_id, unnest(author) AS a FROM nn) WHERE a IS NOT NULL
  GROUP BY pub_id, lower(a)
)"""

STOP = "(" + ", ".join(_quote(w) for w in FIXTURE_STOP_WORDS) + ")"


def _top_words(source: str) -> str:
    return f"""
WITH {PUBS[1:]},
src AS ({source}),
low AS (SELECT lower(title) AS t FROM src),
cut AS (SELECT substring(t, 1, greatest(length(t) - 1, 0)) AS s FROM low),
toks AS (
  SELECT unnest(CASE WHEN regexp_full_match(s, ' +') THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(s, ' +$', ''), ' ') END) AS word
  FROM cut
),
c AS (SELECT word, count(*) AS n FROM toks
      WHERE word <> '' AND word NOT IN {STOP} GROUP BY word)
SELECT CAST(row_number() OVER (ORDER BY n DESC, word) AS BIGINT) AS rank, word, n
FROM c ORDER BY n DESC, word LIMIT 100"""


CLIQUE_REQ = """
cmds(cmd_id, arg) AS ({source}),
parts AS (
  SELECT CAST(cmd_id AS BIGINT) AS cmd_id, string_split(regexp_replace(arg, ',+$', ''), ',') AS p
  FROM cmds
),
lastp AS (
  SELECT cmd_id, p, p[len(p)] AS last FROM parts
),
req AS (
  SELECT cmd_id,
         list_transform(p[1:len(p) - 1] || [regexp_extract(last, '^([^\\[\\]]*)\\[([+-]?[0-9]+)\\]', 1)],
                        lambda x: trim(regexp_replace(lower(trim(x)), ' +', ' ', 'g'))) AS names,
         CASE WHEN regexp_matches(last, '^([^\\[\\]]*)\\[([+-]?[0-9]+)\\]')
              THEN TRY_CAST(regexp_extract(last, '^([^\\[\\]]*)\\[([+-]?[0-9]+)\\]', 2) AS BIGINT)
         END AS min_count
  FROM lastp
),
need AS (
  SELECT cmd_id, nm, count(*) AS need
  FROM (SELECT cmd_id, unnest(names) AS nm FROM req WHERE min_count IS NOT NULL)
  GROUP BY cmd_id, nm
),
k AS (SELECT cmd_id, count(*) AS k FROM need GROUP BY cmd_id),
hits AS (
  SELECT need.cmd_id, idx.pub_id, count(*) AS m
  FROM need JOIN idx ON idx.name_lc = need.nm AND idx.have >= need.need
  GROUP BY need.cmd_id, idx.pub_id
),
found AS (
  SELECT hits.cmd_id, hits.pub_id FROM hits JOIN k ON k.cmd_id = hits.cmd_id WHERE hits.m = k.k
)"""


def _clique_req() -> str:
    values = ", ".join(f"({i}, {_quote(a)})" for i, a in enumerate(CLIQUE_ARGS))
    return CLIQUE_REQ.format(source="VALUES " + values)


def _log(name: str, where: str) -> str:
    """A fixture log as SQL: numbered, rendered, dated with the day roll."""
    return f"""
{name}_ev AS (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS line_no, event_id, ts, user_id, value,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sec,
         printf('%d:%02d', (event_id % 1440) // 60, (event_id % 1440) % 60) AS hm
  FROM events {where}
),
{name}_r AS (
  SELECT *, CASE WHEN sec < lag(sec) OVER (ORDER BY line_no) THEN 1 ELSE 0 END AS back
  FROM {name}_ev
),
{name} AS (
  SELECT line_no, event_id, user_id, value, sec,
         CAST(CAST(epoch((SELECT CAST(min(ts) AS DATE) FROM events {where})) AS BIGINT)
           + 86400 * sum(back) OVER (ORDER BY line_no ROWS UNBOUNDED PRECEDING) + sec AS BIGINT)
           AS ts_sec,
         CASE WHEN event_id % 3 = 0 THEN '1 day, ' || hm
              WHEN event_id % 1440 < 60 THEN CAST(event_id % 1440 AS VARCHAR) || ' min'
              ELSE hm END AS uptime,
         CAST(user_id % 5 + 1 AS INTEGER) AS users,
         value AS load1, value * 2 AS load5,
         CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value * 4 END AS load15,
         strftime(make_timestamp(2000, 1, 1, sec // 3600, (sec % 3600) // 60, sec % 60), '%H:%M:%S')
           AS hms
  FROM {name}_r
)"""


def _answer_commands() -> str:
    lines = ", ".join(f"({i + 1}, {_quote(v)})" for i, v in enumerate(COMMAND_LINES))
    clique = CLIQUE_REQ.format(
        source="SELECT cmd_line, arg FROM c WHERE op = 'clique' AND status0 = 'ok'")
    return f"""
WITH {PUBS[1:]},
raw(cmd_line, value) AS (VALUES {lines}),
p AS (SELECT CAST(cmd_line AS BIGINT) AS cmd_line, string_split(value, ':') AS parts FROM raw),
c AS (
  SELECT cmd_line,
         lower(trim(regexp_replace(trim(parts[1]), ' +', ' ', 'g'))) AS op,
         lower(trim(regexp_replace(trim(parts[2]), ' +', ' ', 'g'))) AS arg,
         CASE WHEN len(parts) < 2 THEN 'invalid input'
              WHEN parts[2] IS NULL OR lower(trim(regexp_replace(trim(parts[2]), ' +', ' ', 'g'))) = ''
                THEN 'invalid input'
              WHEN lower(trim(regexp_replace(trim(parts[1]), ' +', ' ', 'g')))
                   NOT IN ('author', 'coauthor', 'clique') THEN 'unknown command'
              ELSE 'ok' END AS status0
  FROM p
),{clique[1:]},
cmd AS (
  SELECT c.cmd_line, c.op, c.arg,
         CASE WHEN c.op = 'clique' AND c.status0 = 'ok' AND req.min_count IS NULL
              THEN 'invalid input' ELSE c.status0 END AS status
  FROM c LEFT JOIN req ON req.cmd_id = c.cmd_line
),
a_items AS (
  SELECT cmd.cmd_line,
         row_number() OVER (PARTITION BY cmd.cmd_line ORDER BY nn.year DESC, nn.title, nn.pub_id) AS rank,
         nn.title AS text
  FROM cmd JOIN idx ON idx.name_lc = cmd.arg JOIN nn ON nn.pub_id = idx.pub_id
  WHERE cmd.status = 'ok' AND cmd.op = 'author'
),
co_sp AS (
  SELECT DISTINCT cmd.cmd_line, sp.a AS author
  FROM cmd JOIN idx ON idx.name_lc = cmd.arg
  JOIN (SELECT pub_id, unnest(author) AS a FROM nn) sp ON sp.pub_id = idx.pub_id
  WHERE cmd.status = 'ok' AND cmd.op = 'coauthor' AND sp.a IS NOT NULL
),
tot AS (SELECT name_lc, count(*) AS n FROM idx GROUP BY name_lc),
co_items AS (
  SELECT co_sp.cmd_line,
         row_number() OVER (PARTITION BY co_sp.cmd_line ORDER BY tot.n DESC, co_sp.author) AS rank,
         co_sp.author || ' : ' || CAST(tot.n AS VARCHAR) AS text
  FROM co_sp JOIN tot ON tot.name_lc = lower(co_sp.author)
),
cl_items AS (
  SELECT found.cmd_id AS cmd_line,
         row_number() OVER (PARTITION BY found.cmd_id ORDER BY nn.year DESC, nn.title, nn.pub_id) AS rank,
         nn.title || ' , [' || array_to_string(nn.author, ',') || '] , ' || CAST(nn.year AS VARCHAR) AS text
  FROM found JOIN nn ON nn.pub_id = found.pub_id
),
items AS (SELECT * FROM a_items UNION ALL SELECT * FROM co_items UNION ALL SELECT * FROM cl_items),
cnt AS (SELECT cmd_line, count(*) AS n FROM items GROUP BY cmd_line),
heads AS (
  SELECT cmd.cmd_line, 0 AS rank,
         CASE WHEN cmd.status <> 'ok' THEN NULL
              WHEN cmd.op = 'clique' THEN
                CASE WHEN coalesce(cnt.n, 0) >= req.min_count THEN 'YES' ELSE 'NO' END
              ELSE CAST(coalesce(cnt.n, 0) AS VARCHAR) END AS text
  FROM cmd LEFT JOIN cnt ON cnt.cmd_line = cmd.cmd_line
  LEFT JOIN req ON req.cmd_id = cmd.cmd_line
)
SELECT cmd.cmd_line, cmd.op, cmd.arg, cmd.status, CAST(r.rank AS BIGINT) AS rank, r.text
FROM (SELECT * FROM heads UNION ALL SELECT * FROM items) r
JOIN cmd ON cmd.cmd_line = r.cmd_line"""


def oracle_sql() -> dict[str, str]:
    probe = _quote(PROBE_NAME.lower())
    q: dict[str, str] = {}
    q["publications"] = f"""
WITH {PUBS[1:]}
SELECT pub_id, title, array_to_string(author, ',') AS authors, year, url FROM pubs"""
    q["select_venues"] = f"""
WITH {PUBS[1:]}
SELECT pub_id, title, array_to_string(author, ',') AS authors, year, url FROM sel"""
    q["top_authors"] = f"""
WITH {PUBS[1:]},
c AS (SELECT a AS author, count(*) AS n
      FROM (SELECT unnest(author) AS a FROM sel) WHERE a IS NOT NULL GROUP BY a)
SELECT CAST(row_number() OVER (ORDER BY n DESC, author) AS BIGINT) AS rank, author, n
FROM c ORDER BY n DESC, author LIMIT 100"""
    q["top_authors_text"] = f"SELECT rank, author FROM ({q['top_authors']})"
    q["top_words"] = _top_words("SELECT title FROM sel")
    q["top_words_documents"] = _top_words("SELECT text AS title FROM documents")
    q["author_titles"] = f"""
WITH {PUBS[1:]}
SELECT CAST(row_number() OVER (ORDER BY year DESC, title, pub_id) AS BIGINT) AS rank,
       title, year, pub_id
FROM nn WHERE list_contains(list_transform(author, lambda x: lower(x)), {probe})"""
    q["author_titles_all"] = f"""
WITH {PUBS[1:]}
SELECT idx.name_lc AS name,
       CAST(row_number() OVER (PARTITION BY idx.name_lc ORDER BY nn.year DESC, nn.title, nn.pub_id)
            AS BIGINT) AS rank,
       nn.title, nn.year, nn.pub_id
FROM idx JOIN nn ON nn.pub_id = idx.pub_id"""
    q["article_sum"] = f"""
WITH {PUBS[1:]}
SELECT {probe} AS name, count(*) AS n
FROM nn WHERE list_contains(list_transform(author, lambda x: lower(x)), {probe})"""
    q["author_totals"] = f"""
WITH {PUBS[1:]}
SELECT name_lc AS name, count(*) AS n FROM idx GROUP BY name_lc"""
    q["coauthor_totals"] = f"""
WITH {PUBS[1:]},
mine AS (SELECT * FROM nn WHERE list_contains(list_transform(author, lambda x: lower(x)), {probe})),
co AS (SELECT DISTINCT a AS author FROM (SELECT unnest(author) AS a FROM mine) WHERE a IS NOT NULL),
tot AS (SELECT name_lc, count(*) AS n FROM idx GROUP BY name_lc)
SELECT co.author, tot.n FROM co JOIN tot ON tot.name_lc = lower(co.author)"""
    q["clique_check"] = f"""
WITH {PUBS[1:]},{_clique_req()},
cnt AS (SELECT cmd_id, count(*) AS matches FROM found GROUP BY cmd_id)
SELECT req.cmd_id,
       CASE WHEN req.min_count IS NULL THEN NULL ELSE coalesce(cnt.matches, 0) END AS matches,
       CASE WHEN req.min_count IS NULL THEN 'invalid input'
            WHEN coalesce(cnt.matches, 0) >= req.min_count THEN 'YES' ELSE 'NO' END AS verdict
FROM req LEFT JOIN cnt ON cnt.cmd_id = req.cmd_id"""
    q["clique_articles"] = f"""
WITH {PUBS[1:]},{_clique_req()}
SELECT found.cmd_id,
       CAST(row_number() OVER (PARTITION BY found.cmd_id ORDER BY nn.year DESC, nn.title, nn.pub_id)
            AS BIGINT) AS rank,
       nn.pub_id,
       nn.title || ' , [' || array_to_string(nn.author, ',') || '] , ' || CAST(nn.year AS VARCHAR)
         AS text
FROM found JOIN nn ON nn.pub_id = found.pub_id"""
    q["parse_load_log"] = f"""
WITH {_log("lg", "")[1:]}
SELECT line_no, ts_sec, uptime, users, load1, load5, load15 FROM lg"""
    q["log_report"] = f"""
WITH {_log("lg", "")[1:]},
txt AS (
  SELECT line_no,
         printf('%s up %s, %d %s, load average: %.2f, %.2f, %.2f', hms, uptime, users,
                CASE WHEN users = 1 THEN 'user' ELSE 'users' END, load1, load5, load15) AS line,
         ts_sec, load15
  FROM lg
)
SELECT 'line_count' AS section, CAST(0 AS BIGINT) AS ord, CAST(count(*) AS VARCHAR) AS text FROM txt
UNION ALL
SELECT 'span_seconds', 0, CAST(max_by(ts_sec, line_no) - min_by(ts_sec, line_no) AS VARCHAR) FROM txt
UNION ALL
SELECT 'positive_load15', 0, CAST(count(*) FILTER (WHERE load15 > 0) AS VARCHAR) FROM txt
UNION ALL
SELECT 'nonnull_load15', 0, CAST(count(load15) AS VARCHAR) FROM txt
UNION ALL
SELECT 'even_bytes', 0, CAST(sum(strlen(line) + 1) FILTER (WHERE line_no % 2 = 0) AS VARCHAR)
FROM txt
UNION ALL
SELECT 'even_line', line_no, line FROM txt WHERE line_no % 2 = 0"""
    q["log_skew"] = f"""
WITH {_log("la", f"WHERE event_type = {_quote(HOST_A)}")[1:]},
{_log("lb", f"WHERE event_type = {_quote(HOST_B)}")[1:]}
SELECT lb.line_no, lb.ts_sec - la.ts_sec AS seconds
FROM lb JOIN la ON la.line_no = lb.line_no"""
    q["parquet_roundtrip"] = q["publications"]
    q["xml_publications"] = f"""
WITH {PUBS[1:]}
SELECT 'pub/' || CAST(pub_id AS VARCHAR) AS pub_key, title,
       array_to_string(author, ',') AS authors, year, url
FROM nn"""
    esc = "replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    q["retag_records"] = f"""
WITH {PUBS[1:]},
r AS (SELECT *, CASE WHEN pub_id % 2 = 0 THEN chr(10) ELSE '' END AS sep FROM pubs)
SELECT 'pub/' || CAST(pub_id AS VARCHAR) AS pub_key,
       '<article' || CASE WHEN pub_id % 5 = 0 THEN chr(10) ELSE ' ' END || 'key="pub/'
       || CAST(pub_id AS VARCHAR) || '">' || sep
       || CASE WHEN pub_id % 2 = 0
               THEN array_to_string(list_transform(author, lambda a: '<author>' || {esc.format(x="a")} || '</author>'), chr(10))
               ELSE array_to_string(list_transform(author, lambda a: '<author>' || {esc.format(x="a")} || '</author>'), '')
          END
       || sep || '<title>' || {esc.format(x="title")} || '</title>' || sep
       || '<year>' || CAST(year AS VARCHAR) || '</year>' || sep
       || '<url>' || {esc.format(x="url")} || '</url>' || sep || '</article>' AS xml
FROM r"""
    q["answer_commands"] = _answer_commands()
    parsed = q["answer_commands"].split("a_items AS")[0].rstrip().rstrip(",")
    q["stream_titles"] = f"""{parsed}
SELECT cmd.cmd_line, cmd.arg, nn.pub_id, nn.title, nn.year
FROM cmd JOIN idx ON idx.name_lc = cmd.arg JOIN nn ON nn.pub_id = idx.pub_id
WHERE cmd.status = 'ok' AND cmd.op = 'author'"""
    q["repeated_ints"] = "SELECT CAST(l_orderkey AS INTEGER) AS v FROM lineitem"
    q["int_sets"] = f"""
WITH k AS (
  SELECT DISTINCT CAST(l_partkey // {SET_STRIDE} AS INTEGER) AS i, l_partkey + 1 AS v
  FROM lineitem WHERE l_partkey % {SET_STRIDE} < {SET_WIDTH}
)
SELECT i, count(*) AS size, CAST(min(v) AS BIGINT) AS first, CAST(max(v) AS BIGINT) AS last,
       CAST(sum(v) AS BIGINT) AS total
FROM k GROUP BY i"""
    q["select_predicate"] = f"""
WITH {PUBS[1:]}
SELECT pub_id, title, array_to_string(author, ',') AS authors, year, url FROM nn WHERE {VENUE_PREDICATE}"""
    q["log_report_text"] = f"""
SELECT CAST(row_number() OVER (ORDER BY list_position(['line_count', 'span_seconds', 'positive_load15',
         'nonnull_load15', 'even_line', 'even_bytes'], section), ord) AS BIGINT) AS line_no,
       text AS value
FROM ({q["log_report"]})"""
    q["range_copy_parts"] = f"""
SELECT CAST(p // greatest(((SELECT count(*) FROM orders) + {COPY_PARTS} - 1) // {COPY_PARTS}, 1) AS INTEGER) AS part,
       count(*) AS rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders) GROUP BY 1"""
    q["keyed_upsert"] = """
WITH r AS (
  SELECT l_orderkey AS key, CAST(l_linenumber AS BIGINT) AS line, l_extendedprice AS price,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) AS k
  FROM lineitem WHERE l_returnflag = 'R'
)
SELECT key, line, price FROM r WHERE k = 1
UNION ALL
SELECT o_orderkey, CAST(0 AS BIGINT), o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
    q["keyed_lookup"] = f"""
SELECT * FROM ({q["keyed_upsert"]})
WHERE key IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem))"""
    q["keyed_copy"] = q["int_sets"]
    logs = {"all": "", HOST_A: f"WHERE event_type = {_quote(HOST_A)}", HOST_B: f"WHERE event_type = {_quote(HOST_B)}"}
    q["log_files"] = "\nUNION ALL\n".join(f"""
SELECT {_quote(name)} AS log, (
  WITH {_log("lg", where)[1:]}
  SELECT CAST(sum(strlen(printf('%s up %s, %d %s, load average: %.2f, %.2f, %.2f', hms, uptime, users,
         CASE WHEN users = 1 THEN 'user' ELSE 'users' END, load1, load5, load15)) + 1) AS BIGINT) FROM lg) AS bytes,
  (SELECT strftime(min(ts), '%Y-%m-%d') FROM events {where}) AS date""" for name, where in logs.items())
    size = "(SELECT count(*) FROM orders)"
    parts = []
    for n in SWEEP:
        length = f"greatest(({size} + {n} - 1) // {n}, 1)"
        parts.append(f"""
SELECT CAST({n} AS INTEGER) AS n, CAST(c.chunk AS INTEGER) AS chunk,
       CAST(least(c.chunk * {length}, {size}) AS BIGINT) AS "begin",
       CAST(least(c.chunk * {length} + {length}, {size}) AS BIGINT) AS "end",
       coalesce(s.rows, 0) AS rows, s.min_key, s.max_key
FROM (SELECT unnest(range({n})) AS chunk) c
LEFT JOIN (
  SELECT (p // {length}) AS chunk, count(*) AS rows, min(o_orderkey) AS min_key,
         max(o_orderkey) AS max_key
  FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders)
  GROUP BY 1
) s ON s.chunk = c.chunk""")
    q["chunk_plan"] = "\nUNION ALL\n".join(parts)
    q["range_copy"] = "SELECT * FROM lineitem"
    q["copy_sweep"] = "\nUNION ALL\n".join(
        f"SELECT CAST({n} AS INTEGER) AS n, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, true AS same "
        f"FROM lineitem" for n in SWEEP)
    q["ordered_append"] = """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderkey, o_custkey, o_totalprice FROM orders"""
    q["table_size"] = "SELECT count(*) AS coun FROM lineitem"
    return q
