"""Text sinks (K2, K3, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ranked_text_file(ranked: DataFrame, path: str, rank: str = "rank", name: str | None = None,
                     mode: str = "overwrite") -> str:
    """K2: a ranked result as one text file, one value per line in rank order.

    Only for results already cut to k rows (top-k): ``coalesce(1)`` keeps the
    sorted order of a single partition, and k rows are all one task writes.
    """
    value = name or [c for c in ranked.columns if c != rank][0]
    ranked.orderBy(rank).select(value).coalesce(1).write.mode(mode).text(path)
    return path


def text_directory(lines: DataFrame, path: str, column: str = "value",
                   mode: str = "overwrite") -> str:
    """K3: lines as a directory of part files, one per partition (no coalesce)."""
    lines.select(column).write.mode(mode).text(path)
    return path
