"""Links that a size bound or a change of the scan plan could lose."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import common, jaccard, passages
from quire.llm.kernels import blocks
from quire.session import ensure_checkpoint_dir
from tests.llm import edge


@pytest.fixture(scope="module", autouse=True)
def _checkpoints(spark):
    ensure_checkpoint_dir(spark)


def _least_shared(na, nb, percent):
    behind = max(math.ceil(na * percent / 100 - 1e-9), math.ceil(nb * percent / 100 - 1e-9)) - 1
    return jaccard.required(na, nb, percent) - behind


@pytest.mark.parametrize("percent", [85, 80])
def test_size_bound_is_that_of_the_best_size(spark, percent):
    """Every node size with many ranges of sizes: exactly the least count of any size in between."""
    rows, want = [], []
    for na in [*range(1, 120), 333, 599, 1499]:
        sizes = range(-(-na * percent // 100), na * 100 // percent + 1)
        for lo in [*sizes][:: max(1, len(sizes) // 6)]:
            for hi in [x for x in sizes if x >= lo][:: max(1, len(sizes) // 6)]:
                need = min(_least_shared(na, nb, percent) for nb in range(lo, hi + 1))
                rows += [(len(rows), need - 1, na, lo, hi), (len(rows) + 1, need, na, lo, hi)]
                want += [False, True]
    df = spark.createDataFrame(rows, "i bigint, shared bigint, na int, lo int, hi int")
    held = jaccard.enough_between(df["shared"], df["na"], df["lo"], df["hi"], percent)
    assert [r[1] for r in sorted(df.select("i", held).collect())] == want


def _ordered_words(seed, n):
    """``n`` words in the global order of rare one-word shingles."""
    import pyarrow as pa
    words = [f"s{seed}x{i}" for i in range(n)]
    keys = [int(jaccard.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64)).keys(s)[0])
            for b in blocks(pa.array(words)) for s in jaccard.row_sets(b, 1)]
    return [w for _, w in sorted(zip(keys, words, strict=True))]


def test_link_to_a_size_inside_the_range_is_kept(spark, tmp_dir):
    """y links with b (17 of 20) only, whose size lies between those of its component."""
    rows = []
    for seed in range(12):  # which node is a group's least depends on the hashes
        w, u1, u2, *m, v = _ordered_words(seed, 21)
        assert len(m) == 17
        b = [u1, u2, *m]
        for i, words in enumerate([b, [w, *b], b[:-1], [*m, v]]):
            rows.append((4 * seed + i, " ".join(words), None, None, None))
    got = jaccard.link(edge.stored_documents(spark, tmp_dir + "/d", rows), n=1).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == sorted(edge.jaccard_components(rows, 1, 85))


def test_component_with_an_inner_size_is_met(spark):
    rows = [(t, n, size, 1) for n, size in ((1, 19), (2, 20), (3, 18)) for t in (10, 11, 12)] + [(12, 9, 18, 9)]
    open_ = spark.createDataFrame(rows, "token bigint, node bigint, n int, component bigint")
    label = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node bigint, component bigint")
    assert [tuple(r) for r in jaccard.meetings(open_, label, 85).collect()] == [(9, 1)]


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_what_reaches_them(percent):
    """Any two linked sets: the common shingles in reach of both are as many as are asked for."""
    rnd = random.Random(percent)
    seen = set()
    for _ in range(20_000):
        na, nb = rnd.randrange(1, 60), rnd.randrange(1, 60)
        if na * 100 < nb * percent or nb * 100 < na * percent:
            continue
        least = jaccard.required(na, nb, percent)
        both = rnd.randrange(least, min(na, nb) + 1) if rnd.random() < 0.5 else least
        # the worst places: what is not common comes first
        order = [*"a" * (na - both), *"b" * (nb - both), *"c" * both]
        if rnd.random() < 0.7:
            rnd.shuffle(order)
        a, b = ([i for i, x in enumerate(order) if x in who] for who in ("ac", "bc"))
        ends = [jaccard.prefix_length(n, percent) for n in (na, nb)]
        common = [(a.index(i), b.index(i)) for i, x in enumerate(order) if x == "c"]
        shared = sum(i < ends[0] and j < ends[1] and jaccard.reach(na, i, percent) >= nb
                     and jaccard.reach(nb, j, percent) >= na for i, j in common)
        need = min(jaccard.COUNTED, _least_shared(na, nb, percent))
        assert shared >= max(need, 1)
        seen.add(shared == need)
    assert seen == {True, False}


def test_ends_of_prefixes_are_not_paired(spark, tmp_dir):
    """Texts whose prefixes end in the same frequent shingles meet neither in rows of the join nor at all."""
    rnd = random.Random(11)
    some = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([f"u{i}x{k}" for k in range(50)] + some), None, None, None) for i in range(60)]
    near = [rows[0][1].split() for _ in range(30)]
    for i, w in enumerate(near):
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(50)] = f"v{i}x{rnd.randrange(1000)}"
        rows.append((100 + i, " ".join(w), None, None, None))
    docs = edge.stored_documents(spark, tmp_dir + "/d", rows)
    got = jaccard.link(docs, n=1).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == sorted(edge.jaccard_components(rows, 1, 85))
    # places 0 to 14 of sets of 90; the last of them are common to 40 nodes
    n, percent = 90, 85
    open_ = spark.createDataFrame(
        [(at if at >= 12 else 1000 + 20 * node + at, node, n, int(jaccard.reach(n, at, percent)), node)
         for node in range(40) for at in range(jaccard.prefix_length(n, percent))],
        "token bigint, node bigint, n int, reach int, component bigint")
    label = spark.createDataFrame([], "node bigint, component bigint")
    assert not jaccard.pairings(open_, label, percent).count()
    assert jaccard.pairings(open_.drop("reach"), label, percent).count() == 2 * 40 * 39 // 2


# -- row numbers ---------------------------------------------------------------

SPLITS = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture()
def changing_splits(spark, monkeypatch):
    """Each job that stores a frame is followed by other scan splits, as when executors come and go."""
    before = [spark.conf.get(c) for c in SPLITS]
    turn = []

    def change(real):
        def store(df):
            out = real(df)
            turn.append(1)
            for c, v in zip(SPLITS, ("128m", "1") if len(turn) % 2 else ("4k", "4k"), strict=True):
                spark.conf.set(c, v)
            return out
        return store

    for module in (jaccard, passages):
        monkeypatch.setattr(module, "stored", change(module.stored))
    yield turn
    for c, v in zip(SPLITS, before, strict=True):
        spark.conf.set(c, v)


def _in_files(spark, path, rows):
    spark.createDataFrame(rows, edge.SCHEMA).repartition(7, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def _near_copies():
    rnd = random.Random(4)
    rows = []
    for i in range(90):
        if i % 3 == 0:
            words = [f"g{i}w{rnd.randrange(10 ** 6)}" for _ in range(40 + i)]
        rows.append((i, " ".join(words + [f"end{i}"] * (i % 3)), None, None, None))
    return rows


def test_links_under_changing_splits(spark, tmp_dir, changing_splits):
    rows = _near_copies()
    docs = _in_files(spark, tmp_dir + "/d", rows)
    want = edge.jaccard_components(rows, 4, 85)
    got = jaccard.link(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs, 4, 85).collect())
    assert kept == sorted({c for _, _, c in want}) and changing_splits


def test_repeats_under_changing_splits(spark, tmp_dir, changing_splits):
    rows = [(i, f"{'x' * i} no {i} " + "a passage that stands in many of these texts " * 2 + f"{i} end", None, None, None)
            for i in range(60)]
    got = passages.digest(passages.without_repeats(_in_files(spark, tmp_dir + "/d", rows), 60, anchor=20)).collect()
    want = sorted((i, sum(covered)) for (i, *_), (_, covered) in
                  zip(rows, edge.repeated_bytes([r[1] for r in rows], 60), strict=True))
    assert sorted((r[0], r[2]) for r in got) == want and changing_splits


def test_row_numbers_stay(spark, tmp_dir, monkeypatch):
    """Numbers by file and place, also under odd names, in split files and for frames that are no table."""
    path = tmp_dir + "/a b%20c"
    rows = spark.range(0, 5000, 1, 3).withColumn("t", F.sha2(F.col("id").cast("string"), 256))
    rows.write.option("parquet.block.size", 16384).parquet(path)
    numbers = []
    for size in ("128m", "8k"):
        monkeypatch.setattr(common, "stored", None)  # a table is not stored
        before = spark.conf.get(SPLITS[0])
        spark.conf.set(SPLITS[0], size)
        numbers.append({r["id"]: r["n"] for r in common.placed(spark.read.parquet(path), "n").collect()})
        spark.conf.set(SPLITS[0], before)
        monkeypatch.undo()
    assert numbers[0] == numbers[1] and len(set(numbers[0].values())) == len(numbers[0]) == 5000
    other = common.placed(spark.read.parquet(path).where("id % 2 = 0").withColumn("r", F.rand()), "n")
    assert other.collect() == other.collect() and other.select("n").distinct().count() == 2500
