"""Exact top-k search (operator 1): vector-approximation files.

Vectors become integers, ``floor(64 * x)`` a component, and the score is their
inner product.  Rows are dealt into blocks.  A block's vectors are quantised
into cells (``2**BITS`` equal cells a dimension); the scan of the cells gives
every candidate a least and a greatest score.  Exact vectors are then read in
order of the greatest possible score, until the k-th exact score is above what
any unread vector can reach.  Every (query block, candidate block) pair is one
bounded task; only k rows a query and block leave it, and one shuffle by query
merges them.

Scale: both sides are dealt by a running number, so neither a repeated id nor a
repeated vector makes a hot block, and a task holds at most about BLOCK x
dimension numbers.  The work is that of the stated query set against all rows,
in blocks; no side is broadcast and nothing reaches the driver but row counts.

Defined results: vectors null, empty, or holding null or non-finite components,
and rows without an id, take no part; vectors of different dimension are not
compared; a repeated row is a candidate as often as it occurs, and a repeated
query row is answered once; a query is never its own candidate, nor are other
rows of its id; scores are long arithmetic (a score beyond a long wraps); no
rows give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.vectors import EVERY, best, matrix, ranked, usable

BITS = 5
BLOCK = 4_096
QUERIES = 4_096
CHUNK = 256  # queries scored at a time within a task
FOUND = "query_id bigint, vec_id bigint, score bigint"


def cells(vectors: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(lower corner of each vector's cell, width of the cells) by dimension."""
    low = vectors.min(axis=0)
    width = (vectors.max(axis=0) - low) // (1 << bits) + 1
    return low + (vectors - low) // width * width, width


def block_topk(query_ids, queries, ids, vectors, k: int):
    """(query_id, vec_id, score) of the k best of one block, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # doubles hold every partial sum exactly below 2**53; longs are used beyond
    reach = float(np.abs(vectors.astype(np.float64)).max() + 1) * float(np.abs(queries.astype(np.float64)).max())
    kind = np.float64 if reach * vectors.shape[1] * 4 < 2.0 ** 53 else None
    out = []
    if kind is None:  # bounds could overflow: read every vector
        for a in range(0, len(queries), CHUNK):
            s = queries[a:a + CHUNK] @ vectors.T
            row, col = np.nonzero(query_ids[a:a + CHUNK, None] != ids[None, :])
            out.append((query_ids[a + row], ids[col], s[row, col], row))
    else:
        corner, width = cells(vectors)
        corner, exact = corner.astype(kind).T, vectors.astype(kind)
        for a in range(0, len(queries), CHUNK):
            q = queries[a:a + CHUNK].astype(kind)
            # greatest score within a cell: corner plus the width where q is positive
            top = q @ corner + (np.maximum(q, 0) @ (width - 1).astype(kind))[:, None]
            top[query_ids[a:a + CHUNK, None] == ids[None, :]] = -np.inf
            out += [(query_ids[a + r], ids[c], s, r) for r, c, s in _read(q, top, exact, k)]
    for qid, vid, score, row in out:
        keep = best(row, score, vid, k)
        yield qid[keep], vid[keep], score[keep].astype(np.int64)


def _read(q, top, exact, k):
    """Exact scores in order of ``top``, until the k-th is certain for each query."""
    n, todo, take = top.shape[1], np.arange(len(q)), 4 * k
    while len(todo):
        take = min(take, n)
        bound = top[todo]
        if take < n:
            part = np.argpartition(-bound, take, axis=1)
            col, beyond = part[:, :take], np.take_along_axis(bound, part[:, take:take + 1], axis=1)[:, 0]
        else:
            col, beyond = np.broadcast_to(np.arange(n), bound.shape), np.full(len(todo), -np.inf)
        step = max(1, (1 << 22) // (take * q.shape[1]))
        score = np.concatenate([np.einsum("qd,qtd->qt", q[todo[i:i + step]], exact[col[i:i + step]])
                                for i in range(0, len(todo), step)])
        score[np.take_along_axis(bound, col, axis=1) == -np.inf] = -np.inf
        kth = np.partition(score, take - k, axis=1)[:, take - k] if take >= k else np.full(len(todo), -np.inf)
        # strictly above: an unread vector of equal score may have a smaller id
        sure = (kth > beyond) | (take == n)
        r, c = np.nonzero((score >= kth[:, None]) & sure[:, None] & (score > -np.inf))
        yield todo[r], col[r, c], score[r, c]
        todo, take = todo[~sure], take * 4


def topk(df: DataFrame, k: int = 20, every: int = EVERY, id_col: str = "vec_id",
         vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: k best of all rows for every ``every``-th id."""
    v = usable(df, id_col, vector_col)
    v = v.select("vec_id", F.size("embedding").alias("dim"),
                 F.transform("embedding", lambda x: F.floor(x * 64)).alias("v"))
    n = v.count()
    n_blocks = max(1, math.ceil(n / BLOCK))
    q_blocks = max(1, math.ceil(n / every / QUERIES))
    number = F.monotonically_increasing_id()
    rows = v.select("vec_id", "dim", "v", F.pmod(F.xxhash64(number), F.lit(n_blocks)).alias("block"),
                    F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("part"))
    queries = v.where(F.pmod("vec_id", F.lit(every)) == 0).distinct() \
        .select("vec_id", "dim", "v", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int").alias("part"),
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))).alias("block"))

    def search(key, left: pa.Table, right: pa.Table):
        names = ["query_id", "vec_id", "score"]
        found = [np.zeros(0, dtype=np.int64)] * 3
        if left.num_rows and right.num_rows:
            parts = list(block_topk(left["vec_id"].to_numpy(), matrix(left["v"], np.int64),
                                    right["vec_id"].to_numpy(), matrix(right["v"], np.int64), k))
            found = [np.concatenate(x) for x in zip(*parts, strict=True)] or found
        return pa.table(dict(zip(names, [pa.array(x, type=pa.int64()) for x in found], strict=True)))

    key = ["dim", "block", "part"]
    found = queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(search, FOUND)
    return ranked(found, k).withColumn("query_id", F.col("query_id"))


#: DuckDB: all scores, ranked; for ids that are not repeated.
SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
