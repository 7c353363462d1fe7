"""Vector searches against brute force."""

import math
import os

import numpy as np
import pytest

from quire.llm import exact_topk, lsh
from quire.session import ensure_checkpoint_dir

SCHEMA = "vec_id bigint, embedding array<float>, dim int, label int"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    ensure_checkpoint_dir(spark)
    rng = np.random.default_rng(8)
    out = [(i, rng.standard_normal(8).tolist(), 1, 1) for i in range(200)]
    out += [(i, [1.0] * 8, None, None) for i in range(200, 260)]  # one common vector
    out += [(300, None, 1, 1), (320, [1.0, None] + [0.0] * 6, 1, 1), (340, [float("nan")] * 8, 1, 1), (360, [], 1, 1),
            (380, [float("inf")] + [0.0] * 7, 1, 1), (None, [1.0] * 8, 1, 1), (400, [0.0] * 8, 1, 1),
            (420, [2.0, 1.0], 1, 1), (421, [1.0, 1.0], 1, 1), (20, out[20][1], 1, 1), (440, [500.0] + [1.0] * 7, 1, 1)]
    return out


def _brute(rows, integers):
    use = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, *_ in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    if integers:
        use = [(i, np.floor(64 * v).astype(int)) for i, v in use]
    else:
        use = [(i, v) for i, v in use if v.any()]
    out = {}
    for q, v in use:
        if q % 20 == 0:
            found = sorted(((-(v * x).sum(), i) for i, x in use if i != q and len(x) == len(v)))
            out[q] = [(i, -s) for s, i in found]
    return out


def test_exact_topk(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 50)
    monkeypatch.setattr(exact_topk, "QUERIES", 7)
    got = {}
    for r in exact_topk.topk(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: v[:20] for q, v in _brute(rows, True).items() if v}


def test_large_components_are_read_exactly():
    q = np.array([[1 << 40, 3]])
    v = np.array([[1, 1], [2, 1], [1 << 20, 0], [1 << 20, 1]])
    found = list(exact_topk.block_topk(np.array([9]), q, np.arange(4), v, 2))
    assert found[0][1].tolist() == [3, 2] and found[0][2].tolist() == [(1 << 60) + 3, 1 << 60]


def test_multiprobe_hashing(spark, rows, monkeypatch):
    monkeypatch.setattr(lsh, "SLOT", 20)  # the common vector's slot is split
    want = _brute(rows, False)
    hits = total = 0
    got = {}
    for r in lsh.nearest(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    for q, found in want.items():
        scores = {}
        for i, s in found:
            scores.setdefault(i, []).append(s)
        mine = got.get(q, [])
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        assert all(any(abs(r.score - s) < 1e-9 * max(1, abs(s)) for s in scores[r.vec_id]) for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        best = [i for i, _ in found][:20]
        hits += len({r.vec_id for r in mine} & set(best))
        total += len(set(best))
    assert hits >= 0.9 * total


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_recall_on_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = _brute([(r.vec_id, r.embedding) for r in df.collect()], False)
    got = {}
    for r in lsh.nearest(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in v[:20]}) for q, v in want.items()) >= 0.9 * 20 * len(want)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_topk.topk(empty).count() == 0 and lsh.nearest(empty).count() == 0


def test_extreme_norms_and_rows_of_one_id_take_part(spark):
    rows = [(20, [1.0, 0.5]), (1, [1e200, 0.0]), (2, [1e-200, 0.0]), (3, [5e-324, 0.0]), (4, [1.7e308, 1.7e308]),
            (5, [0.25, 0.25]), (5, [0.5, 0.25]), (6, [0.25, 0.25]), (6, [0.25, 0.25]), (7, [-1e300, 1.0])]
    df = spark.createDataFrame([(i, v, 2, 1) for i, v in rows], "vec_id bigint, embedding array<double>, dim int, label int")
    got = [(r.vec_id, r.score) for r in lsh.nearest(df).where("query_id = 20").orderBy("rank").collect()]
    want = sorted(((-(v[0] * 1.0 + v[1] * 0.5), i) for i, v in rows if i != 20))
    assert got == [(i, -s) for s, i in want]
