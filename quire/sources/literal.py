"""Small tables from driver-side literals (names asked about, command lists).

``createDataFrame`` on a Python list plans as an RDD scan whose size Spark
cannot estimate, so joins against it never broadcast. Built as an inline
array on a one-row range instead, the table is a literal in the plan: its
size is known exactly and the optimizer broadcasts it, so the big side of
the join is streamed without a shuffle. Only for data that already sits in
driver memory, whose size is therefore bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    empty = spark.createDataFrame([], schema)     # parses the DDL; runs nothing
    st = empty.schema
    if not rows:
        return empty
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
