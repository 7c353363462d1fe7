"""Centroid clustering (operator 12): k-means with geometric drift tightening.

Vectors become integers, ``floor(256 * x)`` a component, and all distances are exact
squared Euclidean ones.  Every round assigns each vector to its nearest centroid and
moves each centroid to the floor of its vectors' mean.

A vector carries its cluster and a lower bound of its distance to every other
centroid.  When centroids move, the bound is loosened by what the vector's cluster can
have lost: a cluster's vectors lie in a sphere about its old centroid, and for a
centroid that moved from a to b the loss ``|x - a| - |x - b|`` over that sphere is
bounded in the plane of the sphere's centre, a and b.  With m the middle of a and b, it
is at most ``|a - b|`` times the cosine of the angle at m between x and the motion, and
the sphere, seen from m, lies within an angle of its centre.  That is mostly far less
than the full drift, and below zero for centroids that moved away.  Only vectors whose
distance to their own centroid is not clearly below the bound are compared with all
centroids, exactly; so the result is that of the plain algorithm.

Scale: a round is one map over the stored vectors, written anew with cluster and bound
(no shuffle of vectors), and one aggregate with a row a cluster and task.  The driver
holds k centroids and reads k rows a round.  Nothing depends on how vectors are spread
over clusters.

Defined results: vectors null, of another dimension, or holding null or non-finite
components are left out; a repeated row counts as often as it occurs; rows without an
id are clustered but no first centroid; with fewer vectors than k every one starts a
centroid; equal centroids leave the greater number empty; a distance or sum beyond a
long becomes the greatest long; no vectors give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import narrow, stored
from quire.llm.kernels import frugal
from quire.llm.vectors import matrix

DIM, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2
MOST = (1 << 63) - 1


def integers(df: DataFrame, dim: int = DIM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id bigint, v array<bigint>)`` of the rows that take part."""
    v = narrow(df, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("bigint").alias("vec_id"),
                                                       F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where((F.size("v") == dim) & finite).select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, (vectors, centroids), as longs."""
    most = max(float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, centroids)) + 1
    room = 4.0 * vectors.shape[1] * most * most
    if room < 2.0 ** 53:  # doubles hold every partial sum
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    kind = np.int64 if room < 2.0 ** 63 else object
    out = np.zeros((len(vectors), len(centroids)), dtype=kind)
    for j, c in enumerate(centroids.astype(kind)):
        gap = vectors.astype(kind) - c
        out[:, j] = (gap * gap).sum(axis=1)
    return out if kind is np.int64 else np.minimum(out, MOST).astype(np.int64)


def own_squares(vectors: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to its own centroid."""
    most = max(float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, centroids)) + 1
    kind = np.int64 if 4.0 * vectors.shape[1] * most * most < 2.0 ** 63 else object
    gap = vectors.astype(kind) - centroids.astype(kind)[cluster]
    out = (gap * gap).sum(axis=1)
    return out if kind is np.int64 else np.minimum(out, MOST).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray):
    """(cluster, squared distance, distance to the next centroid), ties to smaller numbers."""
    d = squares(vectors, centroids)
    cluster = d.argmin(axis=1)
    row = np.arange(len(d))
    own = d[row, cluster]
    d[row, cluster] = MOST
    beyond = np.sqrt(d.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(d), np.inf)
    return cluster.astype(np.int32), own, beyond


def assign(vectors, centroids, cluster, lower, drift):
    """(cluster, squared distance, lower bound, vectors compared with all centroids) after a move."""
    own = own_squares(vectors, centroids, cluster)
    lower = lower - drift[cluster]
    # rounding is far below this margin: distances are roots of exact integers
    open_ = np.flatnonzero(~(np.sqrt(own.astype(np.float64)) * (1 + 1e-9) + 1e-3 < lower))
    cluster = cluster.copy()
    if len(open_):
        cluster[open_], own[open_], lower[open_] = nearest(vectors[open_], centroids)
    return cluster, own, lower, len(open_)


def loss(centre: np.ndarray, radius: float, a: np.ndarray, b: np.ndarray) -> float:
    """Upper bound of ``|x - a| - |x - b|`` over the sphere about ``centre``."""
    motion = b - a
    length = float(np.linalg.norm(motion))
    away = centre - (a + b) / 2
    far = float(np.linalg.norm(away))
    if not length:
        return 0.0
    if far <= radius:
        return length
    angle = np.arccos(np.clip(away @ motion / (far * length), -1, 1)) - np.arcsin(min(1.0, radius / far))
    bound = length * float(np.cos(max(0.0, angle)))
    if bound < 0:  # the centroid moved away from the whole sphere
        least = far - radius
        bound *= 2 * least / (2 * least + length)
    return bound


def drifts(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the most that its vectors' distance to any other centroid can have shrunk."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    out = np.zeros(len(a))
    for i in range(len(a)):
        lost = [loss(a[i], radius[i], a[j], b[j]) for j in range(len(a)) if j != i]
        out[i] = max(lost, default=0.0)
    return out + 1e-6 * (1 + np.abs(out))


STATE = "vec_id bigint, v array<bigint>, cluster int, distance bigint, lower double"


def _assigned(centroids: np.ndarray, drift: np.ndarray | None):
    """Task: every vector with its cluster, squared distance and lower bound."""

    def task(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            if not batch.num_rows:
                continue
            vectors = matrix(column["v"], np.int64)
            if drift is None:
                cluster, own, lower = nearest(vectors, centroids)
            else:
                cluster, own, lower, _ = assign(vectors, centroids, column["cluster"].to_numpy(),
                                                column["lower"].to_numpy(), drift)
            yield pa.RecordBatch.from_arrays(
                [column["vec_id"], column["v"], pa.array(cluster, type=pa.int32()), pa.array(own, type=pa.int64()),
                 pa.array(lower, type=pa.float64())], names=["vec_id", "v", "cluster", "distance", "lower"])

    return frugal(task)


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part."""
    rows = integers(df, dim, id_col, vector_col)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(
        F.abs(F.array_max("v").cast("double")), F.abs(F.array_min("v").cast("double")))).alias("most")).first()
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where(F.col("vec_id").isNotNull()).select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    if not first:  # no vector with an id
        return rows.limit(0).select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    wide = "bigint" if size["n"] * (size["most"] + 1) < 2.0 ** 62 else "decimal(38,0)"
    state, drift = rows, None
    for turn in range(rounds + 1):
        state = stored(state.mapInArrow(_assigned(centroids, drift), STATE))
        if turn == rounds:
            break
        sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"), *[
            F.sum(F.col("v")[i].cast(wide)).alias(f"s{i}") for i in range(dim)]).collect()
        moved, radius = centroids.copy(), np.zeros(len(centroids))
        for r in sums:
            moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
            radius[r["cluster"]] = float(r["far"]) ** 0.5 * (1 + 1e-9)
        drift = drifts(centroids, moved, radius)
        centroids = moved
    total = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in total}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return state.select("vec_id", "cluster", "distance",
                        of([min(MOST, inertia.get(j, 0)) for j in range(len(names))]).cast("bigint").alias("cluster_inertia"),
                        F.lit(min(MOST, sum(inertia.values()))).cast("bigint").alias("inertia"), of(names).alias("centroid_sha256"))


def oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED) -> str:
    """DuckDB SQL of the plain algorithm, one pair of tables a round."""
    parts = [f"""v AS (
  SELECT vec_id, unnest(range({dim})) AS i,
    unnest([CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dim}
), c0 AS (
  SELECT j, i, x FROM v JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS j FROM (SELECT DISTINCT vec_id FROM v)
  ) o USING (vec_id) WHERE j < {k}
)"""]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS (
  SELECT vec_id, min_by(j, [d, j]) AS j, min(d) AS d FROM (
    SELECT vec_id, j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{t} c ON v.i = c.i GROUP BY vec_id, j
  ) GROUP BY vec_id
)""")
        if t < rounds:
            parts.append(f"""m{t} AS (
  SELECT j, i, sum(v.x) AS s, count(*) AS n FROM v JOIN a{t} USING (vec_id) GROUP BY j, i
), c{t + 1} AS (
  SELECT c.j, c.i, coalesce(CAST((s - ((s % n) + n) % n) / n AS BIGINT), c.x) AS x FROM c{t} c LEFT JOIN m{t} m ON c.j = m.j AND c.i = m.i
)""")
    body = ", ".join(parts)
    return f"""WITH {body}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a{rounds} JOIN (
  SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j
) USING (j)
"""
