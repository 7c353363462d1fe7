"""Embedding near-dedup (operator 11): cross-polytope hashing with multiprobe buckets.

Rows whose cosine is ``LEAST`` or more are linked; ``near_duplicates`` returns how many
links each row has and the component it is in.

* Equal vectors (by 128 bits of hash) become one *node* with a count; only nodes go on.
* A table hashes a unit vector by fast Hadamard rotations (three rounds of random signs
  and a Walsh-Hadamard transform): the nearest vertex of the cross-polytope, that is the
  largest coordinate and its sign, for each of as many rotations as the number of nodes
  asks for, the last one cut to as many coordinates as make a bucket hold about
  ``OCCUPANCY`` nodes.  A node goes to the ``PROBES`` buckets of each table that lose
  least (further vertices, by the squared loss of their coordinates), so two nodes meet
  where their probe lists meet.
* Nodes of one bucket whose sketches of 128 bits (sign and magnitude of 64 rotated
  coordinates) are near are candidates.  Sign bits alone let pairs of a cosine of 0.5 to
  0.6 pass, of which a large table has so many that all nodes would be one group.  Only a
  spanning forest of candidates leaves a task.  What hangs together by candidates is a
  *group*; a pair can be linked only within one.
* Links are verified in double precision on the vectors, every pair of a group once.
  Groups of at most ``GROUP`` nodes are dealt in batches, with a task's links counted
  and its components found where they are.  A larger group is cut into shells: by the
  bucket of its first table, and the angle to that bucket's mean.  Where the angles
  prove that two shells are linked throughout, or not at all, they are counted as a
  whole; the rest is compared block against block.

Scale: the shuffle of the buckets carries bucket, node and 16 bytes of sketch, 22 bytes an
entry, packed by slot, no vectors; vectors move once for the nodes and once more to find
those that have candidates.  Buckets are the first choice of the same number of nodes at any size of the
table.  A bucket of over ``HOT`` nodes is gathered as one group without comparing its
sketches, by its first nodes of each chunk.  No list of pairs is ever written.

Defined results: vectors null, empty, zero, or holding null or non-finite components
have no links and are their own component; vectors of different dimension are not
linked; equal rows, also of one id, count as rows; a row without an id names no
component unless all its rows are without one (then it is null); ``kept`` is true for
every row whose id is its component's; no rows give an empty result.
"""

from __future__ import annotations

import gc
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import narrow, stored
from quire.llm.components import components
from quire.llm.kernels import U64, frugal, mix64, seeded
from quire.session import checked_broadcast

LEAST = 0.9  # cosine of a link
TABLES, PROBES, OCCUPANCY, ALTERNATIVES = 5, 4, 2, 6
SKETCH, SIGMAS = 128, 5.0
LARGE = 0.9  # deviations beyond which a coordinate of a sketch is large
MATRIX = 256  # coordinates up to which a rotation is one product
SLOT = 8_192  # rows of a task
ENTRIES, LEAST_TASKS = 1 << 19, 64  # entries of a task of buckets, and how many tasks there are before they grow to that
CHUNK_NODES = 1 << 14  # nodes whose entries are dealt at once
HOT = 4_096  # nodes of a bucket that are compared with each other
GROUP = 4_096  # nodes of a group that one task compares
STEP = 0.02  # radians between the shells of a large group


def bucket_bits(nodes: int) -> int:
    """Bits of a bucket, so that a bucket is the first choice of about OCCUPANCY nodes."""
    return max(2, math.ceil(math.log2(max(1, nodes) / OCCUPANCY)))


def probes_for(bits: int) -> int:
    """Buckets of a node in each table: twice as many for each further vertex that must be met."""
    return math.ceil(PROBES * 2 ** (max(0, bits - 14) / 7))


@lru_cache(maxsize=256)
def _signs(width: int, rotation: int) -> np.ndarray:
    """Three rows of random signs of one rotation: a fixed rule."""
    return np.where(seeded(3 * width, 1_000 + rotation) & U64(1), 1.0, -1.0).reshape(3, width)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of the rows (width a power of two)."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


@lru_cache(maxsize=256)
def _matrix(width: int, rotation: int, kind: str) -> np.ndarray:
    """A rotation written out, as it is the same for all rows: one product instead of all passes."""
    x = np.eye(width)
    for signs in _signs(width, rotation):
        x = hadamard(x * signs)
    return x.astype(kind)


def rotated(unit: np.ndarray, rotation: int, keep: int | None = None) -> np.ndarray:
    """``unit`` padded to a power of two and rotated; its first ``keep`` coordinates."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    if width <= MATRIX:
        return unit @ _matrix(width, rotation, unit.dtype.str)[:unit.shape[1], :keep]
    x = np.zeros((len(unit), width))
    x[:, :unit.shape[1]] = unit
    for signs in _signs(width, rotation):
        x = hadamard(x * signs)
    return x[:, :keep]


def buckets(unit: np.ndarray, table: int, bits: int, probes: int) -> np.ndarray:
    """(rows, probes) buckets of one table, the vertex nearest first; -1 where there are no more."""
    full = 1 + max(1, (unit.shape[1] - 1).bit_length())
    code, cost = np.zeros((len(unit), 1), dtype=np.int64), np.zeros((len(unit), 1))
    rows = np.arange(len(unit))[:, None]
    for k in range(math.ceil(bits / full)):
        own = min(full, bits - k * full)
        y = rotated(unit, table * 16 + k, 1 << (own - 1))
        half, away = y.shape[1], np.abs(y)
        if half <= ALTERNATIVES:
            y = np.concatenate([y, -y], axis=1)
            take = min(ALTERNATIVES, y.shape[1])
            best = np.argpartition(-y, take - 1, axis=1)[:, :take] if take < y.shape[1] else np.broadcast_to(np.arange(take), (len(y), take))
            loss = (y.max(axis=1)[:, None] - y[rows, best]) ** 2
        else:  # of a vertex and its opposite only one can be among the nearest
            best = np.argpartition(-away, ALTERNATIVES - 1, axis=1)[:, :ALTERNATIVES]
            loss = (away.max(axis=1)[:, None] - away[rows, best]) ** 2
            best = best + half * (y[rows, best] < 0)
        code = ((code << own)[:, :, None] + best[:, None, :]).reshape(len(unit), -1)
        cost = (cost[:, :, None] + loss[:, None, :]).reshape(len(unit), -1)
        if cost.shape[1] > probes:
            order = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
            code, cost = code[rows, order], cost[rows, order]
    code = code[rows, np.argsort(cost, axis=1, kind="stable")]
    if code.shape[1] < probes:
        code = np.pad(code, ((0, 0), (0, probes - code.shape[1])), constant_values=-1)
    return code


def sketch(unit: np.ndarray) -> np.ndarray:
    """(rows, 2) words: the signs of 64 rotated coordinates, and which of them are large."""
    width, half = 1 << max(1, (unit.shape[1] - 1).bit_length()), SKETCH // 2
    y = np.concatenate([rotated(unit, 100_000 + r) for r in range(max(1, half // width))], axis=1)[:, :half]
    return np.packbits(np.concatenate([y > 0, np.abs(y) > LARGE / math.sqrt(width)], axis=1), axis=1).view(np.uint64)


def sketch_steps(x, large, other):
    """Distance of two sketches, from the bits in which their words differ, ``x`` and ``large``, and what both have large.

    A coordinate is -3, -1, 1 or 3; its squared differences are counted in steps of 4: what
    bits differ, 2 more where both words do, 8 more where signs differ and both are large.
    """
    return np.bitwise_count(x).astype(np.int64) + np.bitwise_count(large) \
        + 2 * np.bitwise_count(x & large).astype(np.int64) + 8 * np.bitwise_count(x & other).astype(np.int64)


@lru_cache(maxsize=256)
def sketch_limit(least: float = LEAST, dim: int = SKETCH // 2) -> int:
    """Most steps between the sketches of a candidate: SIGMAS deviations beyond the mean at the least cosine.

    Both are taken from 4,096 fixed pairs of that dimension: rotated coordinates are
    not independent, so sketches of all coordinates vary less than those of a part.
    """
    if dim < 2:
        return 0  # the same direction, or the opposite one
    x, z = (unit_rows(v) for v in np.random.default_rng(dim).standard_normal((2, 4_096, dim)))
    z = unit_rows(z - np.einsum("rd,rd->r", x, z)[:, None] * x)
    a, b = sketch(x), sketch(least * x + math.sqrt(max(0.0, 1 - least * least)) * z)
    steps = sketch_steps(a[:, 0] ^ b[:, 0], a[:, 1] ^ b[:, 1], a[:, 1] & b[:, 1])
    return math.ceil(steps.mean() + SIGMAS * steps.std())


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component is taken out first, so no norm over- or underflows."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _dims(column):
    """(row numbers, float64 matrix) of each dimension of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, flat[start[rows][:, None] + np.arange(d)[None, :]].astype(np.float64)


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the smallest member of each item's class) after joining the classes of a[i] and b[i]."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def same_runs(group: np.ndarray):
    """(i, i + d) of all pairs of equal ``group`` (sorted), by growing d."""
    at, d = np.arange(len(group)), 0
    while len(at):
        d += 1
        at = at[at + d < len(group)]
        at = at[group[at] == group[at + d]]
        if len(at):
            yield at, at + d


def _named(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, embedding, h1, h2)`` of every row; the name is null where no link is possible."""
    kind = df.schema[vector_col].dataType.simpleString()
    v = narrow(df, vec_id=id_col, embedding=vector_col).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")).alias("embedding"))
    # compiled, as functions of each component are not: NaN is above infinity, and a search that finds nothing among nulls is null
    top, bottom, inf = F.array_max("embedding"), F.array_min("embedding"), float("inf")
    finite = (top < inf) & (bottom > -inf) & ~F.array_contains("embedding", F.lit(inf).cast(v.schema["embedding"].dataType.elementType))
    usable = F.coalesce(finite & ((top > 0) | (bottom < 0)), F.lit(False))
    return v.select("vec_id", "embedding", F.when(usable, F.xxhash64("embedding")).alias("h1"),
                    F.when(usable, F.xxhash64(F.lit(LEAST), "embedding")).alias("h2"))


def _keys(column, bits: int, probes: int):
    """(row numbers, dimension, unit vectors, bucket keys, where there is a bucket) of each dimension of a list column."""
    for rows, x in _dims(column):
        unit = unit_rows(x)
        single = unit.astype(np.float32)
        code = np.concatenate([buckets(single, t, bits, probes) for t in range(TABLES)], axis=1)
        table = np.repeat(np.arange(TABLES, dtype=np.uint64), probes)
        # one number for table, dimension and bucket; a collision is only a further candidate
        yield rows, x.shape[1], unit, mix64(code.astype(U64) * U64(TABLES) + table + (U64(x.shape[1]) << U64(48))), code >= 0


#: What is shuffled for the buckets: all entries of up to 65,536 nodes for a task, as bytes.
#: Kinds: bucket, node and sketch; bucket and node of a hot bucket; two nodes that one hot bucket holds.
DEALT = "slot int, kind int, dim int, base bigint, entries binary"
ENTRY = [np.dtype([("bucket", "<u4"), ("node", "<u2"), ("s1", "<u8"), ("s2", "<u8")]),
         np.dtype([("bucket", "<u4"), ("node", "<u2")]), np.dtype([("a", "<u2"), ("b", "<u2")])]
#: Nodes of a base: an entry holds the rest.
BASE_BITS = 16


def _packed(kind: int, dim: int, base: int, slot: np.ndarray, entries: np.ndarray):
    """A row for each slot: its entries as bytes."""
    order = np.argsort(slot.astype(np.uint16) if slot.max(initial=0) < 1 << 16 else slot, kind="stable")
    slot, entries = slot[order], entries[order]
    start = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
    n, at = len(start), np.append(start, len(slot)) * entries.itemsize
    blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(entries)])
    return pa.RecordBatch.from_arrays(
        [pa.array(slot[start].astype(np.int32)), pa.array(np.full(n, kind, dtype=np.int32)),
         pa.array(np.full(n, dim, dtype=np.int32)), pa.array(np.full(n, base, dtype=np.int64)), blob],
        names=["slot", "kind", "dim", "base", "entries"])


def _dealt(bits: int, probes: int, slots: int, hot):
    """Task: the entries of the nodes in their buckets of all tables, by slot; ``hot`` are the (broadcast) hot buckets."""

    def rows_of(node, column):
        for rows, dim, unit, key, there in _keys(column, bits, probes):
            words, mine = sketch(unit), node[rows]
            for base in np.unique(mine >> BASE_BITS):
                at = np.flatnonzero(mine >> BASE_BITS == base)
                local, there_ = (mine[at] & ((1 << BASE_BITS) - 1)).astype(np.uint16), there[at]
                r, c = np.nonzero(there_)
                k = key[at][r, c]
                slot = ((k & U64(0xFFFFFFFF)) % U64(slots)).astype(np.int64)
                entry = np.empty(len(r), dtype=ENTRY[0])
                entry["bucket"], entry["node"] = k >> U64(32), local[r]
                entry["s1"], entry["s2"] = words[at[r], 0], words[at[r], 1]
                if len(hot.value):
                    known = hot.value[np.minimum(np.searchsorted(hot.value, k), len(hot.value) - 1)] == k
                    if known.any():
                        yield from _stars(dim, int(base) << BASE_BITS, k[known], slot[known], entry[known])
                        slot, entry = slot[~known], entry[~known]
                if len(entry):
                    yield _packed(0, dim, int(base) << BASE_BITS, slot, entry)

    def task(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK_NODES:
                t = pa.Table.from_batches(held)
                yield from rows_of(t["node"].to_numpy(), t["embedding"])
                held, n = [], 0
        if n:
            t = pa.Table.from_batches(held)
            yield from rows_of(t["node"].to_numpy(), t["embedding"])

    return frugal(task)


def _stars(dim: int, base: int, key, slot, entry):
    """Of the nodes in a hot bucket, the first goes to the bucket's slot; the others hang on it."""
    order = np.lexsort((entry["node"], key))
    key, slot, entry = key[order], slot[order], entry[order]
    head = np.concatenate(([True], key[1:] != key[:-1]))
    first = np.flatnonzero(head)
    leader = np.empty(len(first), dtype=ENTRY[1])
    leader["bucket"], leader["node"] = entry["bucket"][first], entry["node"][first]
    yield _packed(1, dim, base, slot[first], leader)
    pair = np.empty(int((~head).sum()), dtype=ENTRY[2])
    pair["a"], pair["b"] = entry["node"][~head], entry["node"][first[np.cumsum(head) - 1][~head]]
    if len(pair):
        yield _packed(2, dim, base, np.full(len(pair), slot[0]), pair)


TOGETHER, BLOCK = 64, 1 << 17  # nodes of buckets compared together, and pairs compared at once


def near_pairs(bucket, s1, s2, limit: int):
    """(i, j) of the pairs of equal ``bucket`` (sorted) whose sketches are within ``limit``, in pieces."""

    def within(x, large, i, j):
        """Of the places of differing bits, those that are near; the bits alone are never more than the steps."""
        few = np.flatnonzero(np.bitwise_count(x).ravel() + np.bitwise_count(large).ravel() <= limit)
        if len(few):
            i, j = i(few), j(few)
            few = sketch_steps(x.ravel()[few], large.ravel()[few], s2[i] & s2[j]) <= limit
            i, j = i[few], j[few]
            yield i, j

    start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(start, len(bucket)))
    for n in np.unique(size[(size > 1) & (size <= TOGETHER)]):
        mine = start[size == n]
        for a in range(0, len(mine), max(1, BLOCK // n)):
            first = mine[a:a + max(1, BLOCK // n)]
            at = (np.arange(n)[:, None] + first[None, :])  # a row for each place in the bucket
            x, y = s1[at], s2[at]
            for d in range(1, n):
                i = at[:n - d].ravel()
                yield from within(x[d:] ^ x[:-d], y[d:] ^ y[:-d], lambda p, i=i: i[p], lambda p, i=i, d=d: i[p] + d)
    for a, n in zip(start[size > TOGETHER], size[size > TOGETHER], strict=True):
        step = max(1, min(64, BLOCK // n))  # by rows, so that little is compared twice
        for b in range(a, a + n, step):
            e, left = min(b + step, a + n), a + n - b
            x, y = s1[b:e, None] ^ s1[None, b:a + n], s2[b:e, None] ^ s2[None, b:a + n]
            for i, j in within(x, y, lambda p, b=b, w=left: b + p // w, lambda p, b=b, w=left: b + p % w):
                yield i[i < j], j[i < j]


def spanning_forest(bucket, node, s1, s2, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what hangs together by pairs of one bucket with sketches within ``limit``."""
    order = np.argsort(bucket, kind="stable")
    # bits of signed numbers would be counted without their sign
    bucket, node, s1, s2 = bucket[order], node[order], s1[order].view(np.uint64), s2[order].view(np.uint64)
    names, of = np.unique(node, return_inverse=True)
    label, left, right, held = np.arange(len(names)), [], [], 0
    for i, j in near_pairs(bucket, s1, s2, limit):
        a, b = of[i], of[j]
        new = label[a] != label[b]
        left.append(a[new])
        right.append(b[new])
        held += int(new.sum())
        if held > 1 << 18:
            label, left, right, held = join_labels(label, np.concatenate(left), np.concatenate(right)), [], [], 0
    if held:
        label = join_labels(label, np.concatenate(left), np.concatenate(right))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return names[moved], names[label[moved]]


EDGE = "a bigint, b bigint"


def _edges(a, b) -> pa.Table:
    return pa.table({"a": pa.array(np.asarray(a, dtype=np.int64)), "b": pa.array(np.asarray(b, dtype=np.int64))})


def hot_buckets(nodes: DataFrame, n: int, bits: int, probes: int) -> np.ndarray:
    """Sorted keys of the buckets of over HOT nodes, as every 16th node tells; both ways of treating a bucket are exact."""
    if n <= HOT:
        return np.zeros(0, dtype=np.uint64)

    def task(batches):
        for batch in batches:
            for _, _, _, key, there in _keys(batch.column(0), bits, probes):
                yield pa.RecordBatch.from_arrays([pa.array(key[there].view(np.int64))], names=["bucket"])

    found = nodes.where(F.pmod(F.xxhash64("node"), F.lit(16)) == 0).select("embedding").mapInArrow(frugal(task), "bucket bigint") \
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * 16 > HOT).select("bucket").toArrow()
    return np.sort(found["bucket"].to_numpy().view(np.uint64))


def candidate_edges(nodes: DataFrame, n: int, bits: int, probes: int, least: float) -> DataFrame:
    """``(a, b)``: edges of a forest over all candidates."""
    entries = n * TABLES * probes
    slots = max(1, math.ceil(entries / ENTRIES), min(LEAST_TASKS, math.ceil(entries / SLOT)))
    hot = nodes.sparkSession.sparkContext.broadcast(hot_buckets(nodes, n, bits, probes))

    def task(t: pa.Table) -> pa.Table:
        out = [(np.zeros(0, dtype=np.int64),) * 2]
        kinds, dims, bases = (t[c].to_numpy() for c in ("kind", "dim", "base"))
        blobs = t["entries"]
        for kind, dim in sorted({*zip(kinds.tolist(), dims.tolist(), strict=True)}):
            rows = np.flatnonzero((kinds == kind) & (dims == dim))
            read = [np.frombuffer(blobs[r].as_buffer(), dtype=ENTRY[kind]) for r in rows.tolist()]
            entry, base = np.concatenate(read), np.repeat(bases[rows], [len(x) for x in read])
            if kind == 2:
                out.append((base + entry["a"], base + entry["b"]))
                continue
            node = base + entry["node"]
            if kind == 0:
                out.append(spanning_forest(entry["bucket"], node, entry["s1"], entry["s2"], sketch_limit(least, dim)))
            else:
                order = np.lexsort((node, entry["bucket"]))
                bucket, node = entry["bucket"][order], node[order]
                head = np.concatenate(([True], bucket[1:] != bucket[:-1]))
                out.append((node[~head], node[np.flatnonzero(head)[np.cumsum(head) - 1][~head]]))
        return _edges(*(np.concatenate(x) for x in zip(*out, strict=True)))

    return nodes.select("node", "embedding").mapInArrow(_dealt(bits, probes, slots, hot), DEALT) \
        .groupBy("slot").applyInArrow(task, EDGE)


class Links:
    """Which pairs of rows are linked, in double precision; products near the limit are taken anew, pair by pair."""

    def __init__(self, x: np.ndarray, least: float):
        self.x, self.unit, self.least = x / np.abs(x).max(axis=1)[:, None], unit_rows(x), least

    def pairs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = np.einsum("pd,pd->p", self.unit[i], self.unit[j])
        return self._sure(near, i, j)

    def _sure(self, near, i, j):
        hit = near >= self.least
        for p in np.flatnonzero(np.abs(near - self.least) < 1e-12):
            x, y = self.x[i[p]], self.x[j[p]]
            hit[p] = (x @ y) / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= self.least
        return hit

    def block(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = self.unit[i] @ self.unit[j].T
        r, c = np.nonzero(np.abs(near - self.least) < 1e-12)
        hit = near >= self.least
        if len(r):
            hit[r, c] = self._sure(near[r, c], i[r], j[c])
        return hit


SMALL, CHUNK = 48, 1_024  # sizes of groups taken pair by pair, and of blocks of the others


def group_links(group: np.ndarray, x: np.ndarray, weight: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(linked weight, first row of the component) of each row; ``group`` is sorted."""
    links, count, label = Links(x, least), np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, len(group)))
    few = np.flatnonzero(np.repeat(size <= SMALL, size))
    for i, j in same_runs(group[few]):
        i, j = few[i], few[j]
        hit = links.pairs(i, j)
        i, j = i[hit], j[hit]
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        label = join_labels(label, i, j)
    for s, n in zip(start[size > SMALL], size[size > SMALL], strict=True):
        for a in range(s, s + n, CHUNK):
            i = np.arange(a, min(a + CHUNK, s + n))
            for b in range(s, s + n, CHUNK):
                j = np.arange(b, min(b + CHUNK, s + n))
                hit = links.block(i, j)
                if a == b:
                    np.fill_diagonal(hit, False)
                count[i] += hit @ weight[j]
                if a <= b:
                    r, c = np.nonzero(hit)
                    label = join_labels(label, i[r], j[c])
    return count, label


FOUND = "node bigint, links bigint, least bigint"


def small_groups(rows: DataFrame, n: int, least: float) -> DataFrame:
    """``(node, links, least)`` of groups that one task compares, dealt in batches of groups."""
    slots = max(1, math.ceil(n / SLOT))

    def task(t: pa.Table) -> pa.Table:
        out = {c: [] for c in ("node", "links", "least")}
        for rows_, x in _dims(t["embedding"]):
            part = t.take(pa.array(rows_))
            # the row that names a component comes first in its group: ids in order, none last
            order = np.lexsort((part["least"].fill_null(0).to_numpy(), part["least"].is_null().to_numpy(), part["component"].to_numpy()))
            part, x = part.take(pa.array(order)), x[order]
            count, label = group_links(part["component"].to_numpy(), x, part["m"].to_numpy(), least)
            out["node"].append(part["node"].combine_chunks())
            out["links"].append(pa.array(count))
            out["least"].append(part["least"].take(pa.array(label)).combine_chunks())
        return pa.table({c: pa.chunked_array(v, type=pa.int64()) for c, v in out.items()})

    return rows.select("node", "component", "m", "least", "embedding", F.pmod(F.xxhash64("component"), F.lit(slots)).alias("slot")) \
        .groupBy("slot").applyInArrow(task, FOUND)


SUMS = "component bigint, home bigint, i int, s double"


def _sums(batches):
    """Task: sums of the unit vectors of each (component, home) by coordinate."""
    for batch in batches:
        component, home = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("component", "home"))
        for rows, x in _dims(batch.column(batch.schema.get_field_index("embedding"))):
            cells, of = np.unique(np.stack([component[rows], home[rows]]), axis=1, return_inverse=True)
            total = np.zeros((cells.shape[1], x.shape[1]))
            np.add.at(total, of.ravel(), unit_rows(x))
            width = x.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cells[0], width)), pa.array(np.repeat(cells[1], width)),
                 pa.array(np.tile(np.arange(width, dtype=np.int32), len(total))), pa.array(total.ravel())],
                names=["component", "home", "i", "s"])


def _angles(batches):
    """Task: each row's angle to its cell's mean; without a direction, the mean is the first axis."""
    for batch in batches:
        angle = np.zeros(batch.num_rows)
        centre = batch.column(batch.schema.get_field_index("centre"))
        for (rows, x), (_, c) in zip(_dims(batch.column(batch.schema.get_field_index("embedding"))), _dims(centre), strict=True):
            angle[rows] = np.arccos(np.clip(np.einsum("rd,rd->r", unit_rows(x), c), -1, 1))
        keep = [i for i, n in enumerate(batch.schema.names) if n != "centre"]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(angle)],
                                         names=[*[batch.schema.names[i] for i in keep], "angle"])


def large_groups(rows: DataFrame, least: float) -> DataFrame:
    """``(node, links, least)`` of groups too large for a task, by shells and blocks.

    ``rows``: (node, component, home, m, least, embedding), home being the first bucket.
    """
    cell, shell = ["component", "home"], ["component", "home", "shell"]
    mean = rows.select(*cell, "embedding").mapInArrow(frugal(_sums), SUMS).groupBy(*cell, "i").agg(F.sum("s").alias("s")) \
        .groupBy(*cell).agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("c"))
    norm = F.sqrt(F.aggregate("c", F.lit(0.0), lambda a, p: a + p["s"] * p["s"]))
    mean = stored(mean.withColumn("norm", norm).select(*cell, F.when(
        F.col("norm") > 1e-9, F.transform("c", lambda p: p["s"] / F.col("norm"))).otherwise(
        F.transform("c", lambda p: F.when(p["i"] == 0, F.lit(1.0)).otherwise(F.lit(0.0)))).alias("centre")))
    kind = rows.schema["embedding"].dataType.simpleString()
    placed = stored(rows.join(mean, cell).mapInArrow(
        frugal(_angles), f"component bigint, home bigint, node bigint, m bigint, least bigint, embedding {kind}, angle double")
        .withColumn("shell", F.floor(F.col("angle") / STEP)))
    shells = placed.groupBy(*shell).agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("weight"),
                                        F.max("angle").alias("far"), F.min("node").alias("first")).join(mean, cell)
    shells = stored(shells.withColumn("blocks", F.ceil(F.col("n") / GROUP).cast("int")))
    p, q = (shells.select("component", *[F.col(c).alias(f"{side}_{c}") for c in shells.columns if c != "component"]) for side in "pq")
    pairs = p.join(q, "component")
    cosine = F.aggregate(F.zip_with("p_centre", "q_centre", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    same = (F.col("p_home") == F.col("q_home"))
    apart = F.when(same, F.lit(0.0)).otherwise(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
    reach, limit = F.col("p_far") + F.col("q_far"), math.acos(least)
    # the angle of two vectors is at most apart + reach and at least apart - reach
    pairs = stored(pairs.withColumn("apart", apart).withColumn("sure", F.col("apart") + reach < limit - 1e-6)
                   .where(F.col("sure") | (F.col("apart") - reach < limit + 1e-6)).drop("p_centre", "q_centre"))
    sure = pairs.where("sure")
    whole = sure.groupBy("component", F.col("p_home").alias("home"), F.col("p_shell").alias("shell")).agg(
        F.sum("q_weight").alias("linked"), F.min("q_first").alias("b"),
        F.max((same & (F.col("p_shell") == F.col("q_shell"))).cast("int")).alias("own"))
    counted = placed.join(whole, shell)
    wholesale = counted.select(F.col("node").alias("a"), F.lit(None).cast("bigint").alias("b"),
                               (F.col("linked") - F.col("own") * F.col("m")).alias("links"))
    joined = counted.select(F.col("node").alias("a"), "b").unionByName(
        sure.select(F.col("p_first").alias("a"), F.col("q_first").alias("b"))).where("a <> b")

    # the rest: each block of one shell against each block of the other, counted for the first
    open_ = pairs.where("not sure").select("component", *[f"{s}_{c}" for s in "pq" for c in ("home", "shell", "blocks")])
    key = ["component", *[f"{s}_{c}" for s in "pq" for c in ("home", "shell", "block")]]

    def side(me: str, other: str) -> DataFrame:
        mine = open_.withColumn(f"{me}_component", F.col("component"))
        # new names, as both sides come from the same tables
        there = placed.select(*[F.col(c).alias(f"{me}_{c}") for c in [*shell, "node", "m", "embedding"]])
        return there.join(mine, [f"{me}_{c}" for c in shell]) \
            .withColumn(f"{me}_block", F.pmod(F.xxhash64(f"{me}_node"), F.col(f"{me}_blocks")).cast("int")) \
            .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))) \
            .select(*[F.col(c).alias(c) for c in key], *[f"{me}_{c}" for c in ("node", "m", "embedding")])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"a": [np.zeros(0, dtype=np.int64)], "b": [], "links": []}
        edges = [(np.zeros(0, dtype=np.int64),) * 2]
        if left.num_rows and right.num_rows:
            x = np.concatenate([next(_dims(t[c]))[1] for t, c in ((left, "p_embedding"), (right, "q_embedding"))])
            names = np.concatenate([left["p_node"].to_numpy(), right["q_node"].to_numpy()])
            weight, n = right["q_m"].to_numpy(), left.num_rows
            links, count = Links(x, least), np.zeros(n, dtype=np.int64)
            uniq, of = np.unique(names, return_inverse=True)
            label = np.arange(len(uniq))
            for a in range(0, n, CHUNK):
                i = np.arange(a, min(a + CHUNK, n))
                for b in range(n, len(x), CHUNK):
                    j = np.arange(b, min(b + CHUNK, len(x)))
                    hit = links.block(i, j) & (names[i][:, None] != names[j][None, :])
                    count[i] += hit @ weight[j - n]
                    r, c = np.nonzero(hit)
                    label = join_labels(label, of[i[r]], of[j[c]])
            moved = np.flatnonzero(label != np.arange(len(uniq)))
            edges.append((uniq[moved], uniq[label[moved]]))
            out["a"].append(names[:n])
            out["links"].append(count)
        a, b = (np.concatenate(e) for e in zip(*edges, strict=True))
        counts, links_ = np.concatenate(out["a"]), np.concatenate([np.zeros(0, dtype=np.int64), *out["links"]])
        return pa.table({"a": pa.array(np.concatenate([counts, a])),
                         "b": pa.array([None] * len(counts) + b.tolist(), type=pa.int64()),
                         "links": pa.array(np.concatenate([links_, np.zeros(len(a), dtype=np.int64)]))})

    met = stored(side("p", "q").groupBy(*key).cogroup(side("q", "p").groupBy(*key))
                 .applyInArrow(compare, "a bigint, b bigint, links bigint"))
    named = components(stored(joined.unionByName(met.where("b is not null").select("a", "b"))))
    links = wholesale.unionByName(met.where("b is null")).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    whose = placed.select("node", "least").join(named.withColumnRenamed("component", "root"), "node")
    first = whose.groupBy("root").agg(F.min("least").alias("least"))
    found = named.select("node", F.col("component").alias("root")).join(first, "root").select("node", "least")
    return placed.select("node", F.col("least").alias("own")).join(links, "node", "left") \
        .join(found.withColumn("met", F.lit(True)), "node", "left") \
        .select("node", F.coalesce("links", F.lit(0)).alias("links"), F.when(F.col("met"), F.col("least")).otherwise(F.col("own")).alias("least"))


def _let_go(df: DataFrame, n: int) -> None:
    """Of large tables, shuffle files that nothing reads again are removed now, not when the driver runs out of memory."""
    if n > 1_000_000:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()


def _distinct(rows: DataFrame) -> DataFrame:
    """``(node, h1, h2, embedding, m, least)``: the different vectors, with how many rows each has and their least id."""
    return stored(rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()))


def _homes(bits: int):
    """Task: nodes with the bucket of the nearest vertices of the first table."""

    def task(batches):
        for batch in batches:
            home = np.zeros(batch.num_rows, dtype=np.int64)
            for rows, x in _dims(batch.column(batch.schema.get_field_index("embedding"))):
                home[rows] = buckets(unit_rows(x).astype(np.float32), 0, bits, 1)[:, 0] + (x.shape[1] << 48)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], names=[*batch.schema.names, "home"])

    return frugal(task)


def near_duplicates(df: DataFrame, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    rows = _named(df, id_col, vector_col)
    nodes = _distinct(rows)
    n = nodes.count()
    bits = bucket_bits(n)
    probes = probes_for(bits)
    kind = rows.schema["embedding"].dataType.simpleString()
    _let_go(nodes, n)
    # stored: the contraction reads its links more than once
    group = stored(components(stored(candidate_edges(nodes, n, bits, probes, least))))
    _let_go(nodes, n)
    size = group.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    large = stored(size.where(F.col("size") > GROUP).select("component"))
    n_large = large.count()
    grouped = nodes.select("node", "m", "least", "embedding").join(checked_broadcast(group, 1_000_000), "node")
    few, n_few = grouped, group.count()
    if n_large:
        big = F.broadcast(large) if n_large < 1_000_000 else large
        few = grouped.join(big, "component", "left_anti")
        n_few = group.join(big, "component", "left_anti").count()
    found = small_groups(few, n_few, least)
    if n_large:
        homed = grouped.join(big, "component", "left_semi").select("node", "m", "least", "embedding", "component") \
            .mapInArrow(_homes(bits), f"node bigint, m bigint, least bigint, embedding {kind}, component bigint, home bigint")
        found = found.unionByName(large_groups(stored(homed), least))
    found = stored(found)
    known = nodes.select("node", "h1", "h2", "m", "least").join(
        checked_broadcast(found.select("node", "links", F.col("least").alias("root"), F.lit(True).alias("met")), 1_000_000), "node", "left") \
        .select("h1", "h2", "m", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                F.when(F.col("met"), F.col("root")).otherwise(F.col("least")).alias("component_id"))
    single = known.where("m = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id")
    # of equal vectors every row is answered; rows that cannot be linked stand alone
    copies = checked_broadcast(known.where("m > 1").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("met")), 1_000_000)
    rest = rows.select("vec_id", "h1", "h2").join(copies, ["h1", "h2"], "left").where("met or h1 is null") \
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.when(F.col("met"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return single.unionByName(rest).select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id",
                                           F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: DuckDB: all pairs, and components by their smallest id; for ids that are not repeated.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}
), r AS (
  SELECT a AS vec_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id
), c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.root, e.vec_id) AS component_id,
  coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.vec_id LEFT JOIN c ON e.vec_id = c.vec_id
"""
