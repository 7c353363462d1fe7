"""What both vector searches share: usable rows, and exact top-k of score blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import narrow

EVERY = 20  # rows whose id is divisible by this are the queries


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id bigint, embedding array<double>)`` of rows with an id and finite components."""
    v = narrow(df, vec_id=id_col, embedding=vector_col) \
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    inf = F.lit(float("inf"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return v.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)


def matrix(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores of each row, ties to the smaller id, in order."""
    order = np.lexsort((ids, -score, row))
    r = row[order]
    head = np.concatenate(([True], r[1:] != r[:-1])) if len(r) else np.zeros(0, dtype=bool)
    start = np.maximum.accumulate(np.where(head, np.arange(len(r)), 0)) if len(r) else r
    return order[np.arange(len(r)) - start < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of each query's finds.

    ``found`` may hold a pair more than once.  One shuffle by query serves both
    the removal of repeats and the ranking; a query's finds are bounded by k a
    block.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
