"""Every registered query equals its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
                 "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, want)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        spark_type = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        assert spark_type == duck_types[f.name], (name, f.name, spark_type, duck_types[f.name])
