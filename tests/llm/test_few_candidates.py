"""Queries with fewer candidates than asked for get all of them."""

import numpy as np
import pytest

from quire.llm import lsh
from quire.session import ensure_checkpoint_dir


@pytest.mark.parametrize("slot", [lsh.SLOT, 20])
def test_few_vectors_are_all_found(spark, monkeypatch, slot):
    ensure_checkpoint_dir(spark)
    monkeypatch.setattr(lsh, "SLOT", slot)
    rng = np.random.default_rng(2)
    rows = []
    for dim in range(5, 16):
        for _ in range(dim):  # as many vectors as components, on both sides, of many lengths
            rows.append((len(rows), (rng.standard_normal(dim) * 10.0 ** rng.integers(-2, 3)).tolist()))
    got = {}
    for r in lsh.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), every=1) \
            .orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, x in rows:
        scores = sorted((-float(np.dot(x, y)), i) for i, y in rows if i != q and len(y) == len(x))
        assert got[q] == [(n + 1, i) for n, (_, i) in enumerate(scores)]
