"""Embedding near-dedup, centroid clustering and the filter audit, by brute force."""

import hashlib
import itertools
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import audit, centroids, polytope
from quire.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<double>, node int, bucket string, h1 int"


@pytest.fixture(scope="module", autouse=True)
def _checkpoints(spark):
    ensure_checkpoint_dir(spark)


def _near(rng, x, cosine):
    z = rng.standard_normal(len(x))
    z -= (z @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine * cosine) * z / np.linalg.norm(z)


def _vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(300)]
    at = 1000
    for _ in range(3):  # groups of near copies, some pairs below the limit
        x = rng.standard_normal(64)
        for _ in range(60):
            rows.append((at, (_near(rng, x, rng.uniform(0.93, 0.99)) * rng.uniform(0.5, 3)).tolist()))
            at += 1
    x = rng.standard_normal(64)  # a chain
    for _ in range(12):
        rows.append((at, x.tolist()))
        x = _near(rng, x, 0.93)
        at += 1
    rows += [(i, rows[0][1]) for i in range(5000, 5120)]  # one vector very often
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[11][1]), (None, rows[12][1]), (None, rows[12][1])]
    rows += [(6000, None), (6001, []), (6002, [0.0] * 64), (6003, [float("nan")] * 64), (6004, [None] + [1.0] * 63),
             (6005, [float("inf")] + [1.0] * 63), (None, None), (6010, [1e200, 0.0]), (6011, [1e-200, 0.0]), (6012, [1.0, 1.0]),
             (6013, [1.0]), (6014, [2.0]), (6015, [-1.0])]
    return rows


def _linked(rows, least):
    """(links, smallest id reachable) of every row by all pairs."""
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=float) if ok else None
        unit.append(None if x is None else x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    n, up = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = unit[i], unit[j]
        if a is not None and b is not None and len(a) == len(b) and a @ b >= least:
            n[i] += 1
            n[j] += 1
            up[max(top(i), top(j))] = min(top(i), top(j))
    least_id = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least_id[top(i)] = min(vec_id, least_id.get(top(i), vec_id))
    return sorted(((r[0], n[i], least_id.get(top(i)), r[0] == least_id.get(top(i))) for i, r in enumerate(rows)), key=repr)


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS).repartition(3)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Sizes of a group and a bucket that go to one task: all, and few enough that shells and stars are used.
@pytest.mark.parametrize("group, hot", [(4096, 4096), (16, 8)])
def test_near_duplicates(spark, monkeypatch, group, hot):
    monkeypatch.setattr(polytope, "GROUP", group)
    monkeypatch.setattr(polytope, "HOT", hot)
    rows = _vector_rows()
    got = _got(polytope.near_duplicates(_table(spark, rows)))
    want = _linked(rows, 0.9)
    assert [(i, c, k) for i, _, c, k in got] == [(i, c, k) for i, _, c, k in want]
    assert got == want


def test_near_duplicates_of_no_rows_and_of_floats(spark):
    assert polytope.near_duplicates(_table(spark, [])).count() == 0
    floats = spark.createDataFrame([(1, [0.6, 0.8]), (2, [0.61, 0.79]), (3, None)], "vec_id int, embedding array<float>")
    assert _got(polytope.near_duplicates(floats)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


@pytest.mark.parametrize("bits", [4, 12, 15, 21, 28])
def test_recall_of_the_index_at_the_limit(bits):
    """Pairs at a cosine of exactly the limit that share a bucket of some table, as tables grow."""
    rng = np.random.default_rng(bits)
    x = rng.standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.array([_near(rng, v, polytope.LEAST) for v in x])
    probes = polytope.probes_for(bits)
    met = np.zeros(len(x), dtype=bool)
    for t in range(polytope.TABLES):
        a, b = polytope.buckets(x, t, bits, probes), polytope.buckets(y, t, bits, probes)
        met |= ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2))
    near = np.bitwise_count(polytope.sketch(x) ^ polytope.sketch(y)).sum(axis=1) <= polytope.sketch_limit()
    assert (met & near).mean() >= 0.97


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(1).standard_normal((5, 32))
    assert np.allclose(polytope.hadamard(polytope.hadamard(x)), x)
    assert np.allclose(np.linalg.norm(polytope.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))


def _words(x):
    words = polytope.sketch(x).view(np.int64)
    return words[:, 0].copy(), words[:, 1].copy()


def test_vectors_of_moderate_cosines_do_not_hang_together():
    """At millions of rows a bucket holds many pairs of such cosines; they must not make one group of all."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 64))
    centre = rng.standard_normal(64) * math.sqrt(0.4 / 0.6)
    x = polytope.unit_rows(x + centre)
    assert 0.35 < np.median(x @ x.T) < 0.45
    near = np.array([_near(rng, v, 0.92) for v in x[:50]])
    x = np.concatenate([x, near])
    node = np.arange(len(x))
    a, b = polytope.spanning_forest(np.zeros(len(x), dtype=np.int64), node, *_words(x), polytope.sketch_limit())
    label = polytope.join_labels(node.copy(), a, b)
    assert (label[:50] == label[1500:]).all()
    assert np.bincount(label).max() < 60


def test_pairs_within_the_limit_are_those_of_all_pairs():
    rng = np.random.default_rng(9)
    sizes = [1, 2, 2, 3, 63, 64, 65, 130, 300, 1]
    centre = rng.standard_normal((len(sizes), 64))
    x = np.concatenate([c + rng.uniform(0.2, 0.9) * rng.standard_normal((n, 64)) for c, n in zip(centre, sizes, strict=True)])
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    words = polytope.sketch(polytope.unit_rows(x))
    s1, s2 = words[:, 0].copy(), words[:, 1].copy()
    bits = [np.unpackbits(w.view(np.uint8).reshape(-1, 8), axis=1).astype(int) for w in (s1, s2)]
    level = (2 * bits[0] - 1) * (1 + 2 * bits[1])
    steps = ((level[:, None, :] - level[None, :, :]) ** 2).sum(axis=2) // 4
    for limit in (20, polytope.sketch_limit(), 70):
        want = {(i, j) for i, j in zip(*np.nonzero((steps <= limit) & (bucket[:, None] == bucket[None, :])), strict=True) if i < j}
        got = [p for i, j in polytope.near_pairs(bucket, s1, s2, limit) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_rotations_written_out_are_the_rotations(monkeypatch):
    x = np.random.default_rng(10).standard_normal((7, 50))
    whole = polytope.rotated(x, 5), polytope.rotated(x, 5, 9)
    monkeypatch.setattr(polytope, "MATRIX", 0)
    assert np.allclose(whole[0], polytope.rotated(x, 5)) and np.allclose(whole[1], polytope.rotated(x, 5, 9))


def test_dealt_entries_hold_every_bucket_of_every_node():
    """Also across the limits of a base and of dimensions; what a hot bucket holds hangs on its leader."""
    import pyarrow as pa
    rng = np.random.default_rng(12)
    node = np.concatenate([np.arange(65_500, 65_580), (3 << 33) + np.arange(40)])
    vectors = [rng.standard_normal(8 if i % 3 else 5).tolist() for i in range(len(node))]
    batch = pa.RecordBatch.from_arrays([pa.array(node), pa.array(vectors)], names=["node", "embedding"])
    bits, probes, slots = 6, 4, 5
    want = {}
    for rows, _, _, key, there in polytope._keys(batch.column(1), bits, probes):
        for r, c in zip(*np.nonzero(there), strict=True):
            want.setdefault(int(key[r, c]), set()).add(int(node[rows[r]]))
    hot = sorted(want, key=lambda k: len(want[k]))[-3:]

    class Hot:
        value = np.sort(np.array(hot, dtype=np.uint64))

    plain, leaders, pairs = {}, {}, []
    for out in polytope._dealt(bits, probes, slots, Hot)([batch]):
        for r in out.to_pylist():
            e = np.frombuffer(r["entries"], dtype=polytope.ENTRY[r["kind"]])
            if r["kind"] == 2:
                pairs += zip(*((r["base"] + e[c].astype(int)).tolist() for c in "ab"), strict=True)
                continue
            for b, n in zip(e["bucket"].tolist(), (r["base"] + e["node"].astype(int)).tolist(), strict=True):
                (leaders if r["kind"] else plain).setdefault((r["slot"], b), set()).add(n)
    name = {k: ((k & 0xFFFFFFFF) % slots, k >> 32) for k in want}
    assert plain == {name[k]: v for k, v in want.items() if k not in hot}
    for k in hot:
        hung = set(leaders[name[k]])
        while more := {a for a, b in pairs if b in hung and a in want[k]} - hung:
            hung |= more
        assert hung == want[k]


def test_floats_that_are_not_finite_have_no_links(spark):
    bad = [None, float("nan"), float("inf"), float("-inf")]
    rows = [(i, [1.0, b, 2.0] if b is None or not math.isinf(b) else [b, 1.0, 2.0]) for i, b in enumerate(bad)] * 2
    rows += [(10, [0.0, -0.0, 0.0]), (10, [0.0, -0.0, 0.0]), (11, [-1.0, -2.0, 0.0]), (12, [-1.0, -2.0, 0.0]), (13, [])]
    got = _got(polytope.near_duplicates(spark.createDataFrame(rows, "vec_id int, embedding array<float>")))
    assert got == sorted([(i, 0, i, True) for i, _ in rows if i not in (11, 12)] + [(11, 1, 11, True), (12, 1, 11, False)], key=repr)


# -- op12 --------------------------------------------------------------------

def _kmeans(rows, k, rounds, dim, scale=256):
    use = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
           if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not use:
        return []
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in use if i is not None)[:k]
    c = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        where = [nearest(v)[1] for _, v in use]
        for j in range(len(c)):
            mine = [v for (_, v), w in zip(use, where) if w == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(v)[::-1]) for i, v in use]
    total = {}
    for _, j, d in found:
        total[j] = total.get(j, 0) + d
    name = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, j, d, total[j], sum(total.values()), name[j]) for i, j, d in found), key=repr)


def _cluster_rows():
    rng = np.random.default_rng(4)
    middle = rng.standard_normal((6, 4)) * 3
    rows = [(i, (middle[i % 6] + rng.standard_normal(4) * 0.2).tolist()) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(500, 580)]  # one vector very often
    rows += [(900, None), (901, [1.0]), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan")] * 4), (904, [float("inf")] * 4),
             (5, rows[5][1]), (5, rows[8][1]), (None, rows[0][1]), (905, [-0.001] * 4), (906, [3e5, -3e5, 0.5, 1e4])]
    return rows


@pytest.mark.parametrize("k", [1, 9, 400])
def test_clustering_equals_the_plain_algorithm(spark, k):
    rows = _cluster_rows()
    got = centroids.cluster(_table(spark, rows), k=k, dim=4)
    assert _got(got) == _kmeans(rows, k, 5, 4)


def test_clustering_of_no_vectors(spark):
    for rows in ([], [(1, None)], [(None, [1.0] * 64)]):
        got = centroids.cluster(_table(spark, rows))
        assert got.count() == 0 and got.columns[1:] == ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_drift_bounds_hold_and_are_tighter_than_full_drift():
    rng = np.random.default_rng(5)
    tighter = 0
    for _ in range(300):
        centre, a = rng.standard_normal((2, 8)) * 5
        b = a + rng.standard_normal(8) * rng.uniform(0, 3)
        radius = rng.uniform(0, 6)
        x = rng.standard_normal((400, 8))
        x = centre + x / np.linalg.norm(x, axis=1)[:, None] * radius * rng.uniform(0, 1, (400, 1)) ** (1 / 8)
        lost = np.linalg.norm(x - a, axis=1) - np.linalg.norm(x - b, axis=1)
        bound = centroids.loss(centre, radius, a, b)
        assert lost.max() <= bound + 1e-9
        tighter += bound < 0.9 * np.linalg.norm(b - a)
    assert tighter > 100


def test_separated_clusters_are_not_scanned_again():
    rng = np.random.default_rng(6)
    middle = rng.integers(-5000, 5000, (10, 16))
    v = np.concatenate([m + rng.integers(-30, 30, (50, 16)) for m in middle])
    c = v[::50].copy()
    where, own, lower = centroids.nearest(v, c)
    moved = np.array([v[where == j].sum(axis=0) // (where == j).sum() for j in range(10)])
    radius = np.array([math.sqrt(own[where == j].max()) for j in range(10)])
    got = centroids.assign(v, moved, where, lower, centroids.drifts(c, moved, radius))
    plain = centroids.nearest(v, moved)
    assert (got[0] == plain[0]).all() and (got[1] == plain[1]).all() and got[3] == 0
    assert (got[2] <= plain[2] + 1e-6).all()


def test_large_integers_are_exact():
    v = np.array([[1 << 40, 3], [5, -(1 << 30)]])
    c = np.array([[(1 << 40) - 7, 5], [0, 0]])
    want = [[min(centroids.MOST, sum((int(a) - int(b)) ** 2 for a, b in zip(x, y))) for y in c] for x in v]
    assert centroids.squares(v, c).tolist() == want
    assert centroids.own_squares(v, c, np.array([0, 1])).tolist() == [want[0][0], want[1][1]]


# -- op13 --------------------------------------------------------------------

PASSAGE = " ".join(f"word{i}" for i in range(120))
TEXTS = [
    (1, PASSAGE, "en"), (2, PASSAGE, "en"), (3, PASSAGE, "de"), (4, PASSAGE + " more", "de"), (5, PASSAGE[:-1], "de"),
    (6, None, "en"), (7, "", None), (8, " \t\n", ""), (9, "the same " * 80, "fr"), (10, "the same " * 80, "fr"),
    (11, "LOUD WORDS " * 60, "fr"), (12, "few words #", "fr"), (13, "few words #", "en"), (12, "few words #", "fr"),
    (None, PASSAGE, "en"), (None, "few words #", "en"), (14, "é漢字 " * 150 + "A" * 45, "zh"), (15, "x" * 200_000, "zh"),
    (16, PASSAGE + "\x00tail", "zh"), (20, " ".join(f"w{i % 80}" for i in range(100)), "zh"),
    (21, " ".join(f"w{i % 79}" for i in range(100)), "zh"), (22, PASSAGE, "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (9, 1, None), (9, 0, 1), (12, None, 1), (14, 1, 0), (99, 1, 1), (None, 1, 1), (22, 1, 0)]


def _audited(texts, labels):
    least = {}
    for i, t, _ in texts:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = []
    for i, t, lang in texts:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": re.search("[#$%&*|]", t) is not None, "E": i is not None and i > least[t]}
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        rows.append((lang or "", {f for f in fails if fails[f]}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        docs = [r[1:] for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            for s, f in enumerate(order):
                before = set(order[:s])
                here = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                out.append([part, "".join(order), s + 1, sum(not d[0] & (before | {f}) for d in docs), len(here),
                            sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs),
                            sum(d[1] for d in here), sum(d[2] for d in here), f])
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def _audit(spark, texts, labels):
    docs = spark.createDataFrame([(i, t, x, "e", 4) for i, t, x in texts], "doc_id bigint, text string, lang string, mask string, part int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return audit.audit(docs.repartition(3), marks)


@pytest.mark.parametrize("size", [16 << 20, 2_000])
def test_filter_audit(spark, monkeypatch, size):
    monkeypatch.setattr(audit, "RANGE_BYTES", size)
    monkeypatch.setattr(audit, "range_bytes", lambda total: size)
    monkeypatch.setattr(audit, "FLUSH", 1_000 if size < 10_000 else audit.FLUSH)
    got = _audit(spark, TEXTS, LABELS)
    assert sorted(tuple(r) for r in got.collect()) == _audited(TEXTS, LABELS)


def test_filter_audit_of_no_documents(spark):
    assert _audit(spark, [], LABELS).count() == 0
    assert sorted(tuple(r) for r in _audit(spark, TEXTS[:3], []).collect()) == _audited(TEXTS[:3], [])


def test_cuts_tell_texts_with_a_long_common_prefix_apart(spark, monkeypatch):
    monkeypatch.setattr(audit, "range_bytes", lambda total: 20_000)
    head = "the same beginning of very many texts, " * 20
    texts = [(i, head + f"number {i} " + "and so on " * 20, "en") for i in range(400)] + [(i, "other", "en") for i in range(400, 800)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    cuts = audit.cut_points(docs, total)
    assert cuts == sorted(set(cuts)) and sum(c.startswith(head.encode()) for c in cuts) > 5
    from bisect import bisect_right
    sizes = {}
    for _, t, _ in texts[:400]:
        r = bisect_right(cuts, t.encode())
        sizes[r] = sizes.get(r, 0) + len(t)
    assert max(sizes.values()) < 6 * 20_000
    assert sorted(tuple(r) for r in _audit(spark, texts, []).collect()) == _audited(texts, [])


def test_radix_trie_holds_every_text():
    import random
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(12))).encode() for _ in range(2000)] + [b"a" * 100_000]
    trie, least = audit.RadixTrie(), {}
    for i, t in enumerate(texts):
        trie.terminal(t, 0).add(i, [("p", 0, 1, 1, 0)])
        least.setdefault(t, i)
    found = list(trie.terminals())
    assert sorted(x.least for x in found) == sorted(least.values())
    assert sum(x.cells["p", 0][0] for x in found) == len(texts)
    assert all(x.cells["p", 0][1] == 1 for x in found)
    assert len(found) == len(set(texts)) and trie.terminal(b"a" * 100_000, 0).least == len(texts) - 1


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["op11_embedding_dedup", "op12_centroid_clustering", "op13_filter_audit"])
def test_equal_to_duckdb_on_the_given_tables(spark, name):
    import duckdb

    from quire.llm import catalog
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(res.fetchall())
