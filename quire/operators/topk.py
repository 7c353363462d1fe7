"""Top-k by count with a rank column (T3 + W2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order_by: list, rank: str = "rank") -> DataFrame:
    """First ``k`` rows in ``order_by`` order, ranked 1..k.

    ``orderBy().limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
    its own best k and only those reach the final task. The rank window then
    sees at most k rows, so its lack of partition keys costs nothing.
    """
    best = df.orderBy(*order_by).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))
