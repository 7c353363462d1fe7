"""Suffix-array dedup (operator 7): a run-length index over repeated passages.

Every byte covered by an ``L``-byte string that also starts anywhere else in the
corpus is removed.  Two steps bring the strings that can be equal together, the
third decides:

1. *Contexts.*  Each L-byte window has a minimiser, the least hash of its
   ``ANCHOR``-byte substrings; consecutive windows of equal minimiser form a
   context.  Equal windows have equal minimisers, so a context whose minimiser
   is taken at one place only holds no repeat.  Only narrow rows (minimiser, text hash,
   place) are shuffled to find the others.
2. *Distinct contexts.*  Contexts with the same bytes are one, with a count.
3. *Index.*  The distinct contexts of a range of minimisers are laid end to end
   and their suffixes sorted to depth L.  The bytes before the sorted suffixes
   are the Burrows-Wheeler transform; it is run-compressed, and the places at
   run ends are sampled.  Matching statistics (the longest match of each place
   with any other, up to L) are streamed right to left: going one byte to the
   left lengthens the match by one as long as the place and its neighbour lie in
   one run; only at sampled run ends is a match measured anew.  Windows with a
   match of L bytes are marked.

Scale: no text leaves its row but for two joins by text hash (to fetch the bytes
of one context each, and to cut the result).  A minimiser that many texts share
sends one row a task (further rows of the task are known repeats already and are
dealt by their own hash); equal contexts are counted, not gathered; a minimiser
with more than ``HOT`` different contexts is split into single windows, keyed by
the hash of the whole window.  The index of a task is built over about
``INDEX_BYTES`` at a time.

Defined results: null text is empty; texts shorter than L bytes, and empty ones,
keep every byte; of texts that occur twice every window is a repeat; matches
never cross documents; an empty table gives an empty result; a null id is carried along.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import placed, stored, texts
from quire.llm.kernels import EXACT, Block, blocks, frugal, mix64, prefix_hash, span_hash
from quire.session import checked_broadcast

L = 200
ANCHOR = 64
HOT = 20_000
INDEX_BYTES = 1 << 20
BROADCAST_ROWS = 1_000_000  # row numbers of 8 bytes

CONTEXT = "h bigint, k bigint, c bigint, start int, run int"


def window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def contexts(block: Block, size: int, anchor: int):
    """(row, start within the row, number of windows, minimiser, hash of the bytes, twice).

    ``twice``: the minimiser's value is taken at more than one place of the row,
    so that windows of one context can be equal.
    """
    n = len(block.data)
    if n < size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    prefix = prefix_hash(block, EXACT)
    at = np.arange(n - anchor + 1)
    value = span_hash(prefix, at, at + anchor)
    width = size - anchor + 1
    least = window_minimum(value, width)
    row = np.repeat(np.arange(block.rows), np.diff(block.offsets))
    whole = row[:n - size + 1] == row[size - 1:]
    # places taken: the greatest minimum of the windows around a place is its own value
    shown = np.zeros(n - anchor + width, dtype=np.uint64)
    shown[width - 1:width - 1 + len(least)] = np.where(whole, least, np.uint64(0))
    taken = np.flatnonzero(~window_minimum(~shown, width) == value)
    order = np.lexsort((value[taken], row[taken]))
    r, v = row[taken][order], value[taken][order]
    same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    several = np.sort(mix64(v[1:][same] ^ r[1:][same].astype(np.uint64)))
    change = (least[1:] != least[:-1]) | (row[1:n - size + 1] != row[:n - size])
    first = np.flatnonzero(whole & np.concatenate(([True], change | ~whole[:-1])))
    last = np.flatnonzero(whole & np.concatenate((change | ~whole[1:], [True])))
    of, h = row[first], least[first]
    twice = np.zeros(len(of), dtype=bool)
    if len(several):
        mine = mix64(h ^ of.astype(np.uint64))
        twice = several[np.minimum(np.searchsorted(several, mine), len(several) - 1)] == mine
    return of, first - block.offsets[of], last - first + 1, h, mix64(span_hash(prefix, first, last + size)), twice


def _context_rows(size: int, anchor: int):
    """Rows of all contexts of a task; see ``find_contexts`` for ``deal`` and ``again``."""
    def rows(batches):
        parts = []
        for batch in batches:
            k = batch.column(0).to_numpy()
            for b in blocks(batch.column(1)):
                row, start, run, h, c, twice = contexts(b, size, anchor)
                parts.append((h.view(np.int64), k[b.first + row], c.view(np.int64),
                              start.astype(np.int32), run.astype(np.int32), twice))
        if not parts:
            return
        h, k, c, start, run, twice = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        s = h[order]
        head = np.concatenate(([True], s[1:] != s[:-1]))
        size_of = np.diff(np.append(np.flatnonzero(head), len(s)))
        first, again = np.empty(len(h), dtype=bool), np.empty(len(h), dtype=bool)
        first[order] = head
        again[order] = np.repeat(size_of > 1, size_of)
        again |= twice
        with np.errstate(over="ignore"):
            other = mix64((k + start).view(np.uint64) ^ h.view(np.uint64)).view(np.int64)
        deal = np.where(first, h, other)
        for a in range(0, len(h), 100_000):
            cut = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[cut]) for x in (np.where(first, 0, h), k, c, start, run, deal, again)],
                names=["h", "k", "c", "start", "run", "deal", "again"])
    return rows


def find_contexts(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """Contexts whose minimiser occurs again, with the number ``n`` of equal rows.

    ``deal`` is the minimiser for its first context in a task and a hash of their
    own for the task's further ones, which are repeats already (``again``).  So a
    minimiser's group holds at most one row a task.
    """
    rows = docs.select("k", "text").mapInArrow(frugal(_context_rows(size, anchor)), CONTEXT + ", deal bigint, again boolean")
    group = Window.partitionBy("deal")
    # a first context's minimiser is its deal; it travels once
    known = rows.withColumn("rows", F.count(F.lit(1)).over(group)).withColumn("any", F.max("again").over(group)) \
        .where(F.col("again") | F.col("any") | (F.col("rows") > 1)) \
        .withColumn("h", F.when(F.col("h") == 0, F.col("deal")).otherwise(F.col("h")))
    # copies of one text give equal rows: counted here, so that no later group holds them
    return known.groupBy("h", "k", "c", "start", "run").agg(F.count(F.lit(1)).alias("n"))


def split_hot(found: DataFrame, docs: DataFrame, size: int, hot: int) -> DataFrame:
    """Contexts of minimisers with over ``hot`` different contexts, window by window."""
    heavy = found.groupBy("h", "c").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count(F.lit(1)).alias("m")) \
        .where(F.col("m") > hot).select("h")
    heavy = stored(heavy)
    if heavy.isEmpty():
        return found
    big = found.join(heavy, "h", "left_semi")

    def windows(batches):
        for batch in batches:
            for i, (k, text, parts) in enumerate(zip(*(batch.column(j) for j in range(3)), strict=True)):
                body = np.frombuffer(text.as_py().encode(), dtype=np.uint8)
                prefix = prefix_hash(Block(i, body, np.array([0, len(body)])), EXACT)
                starts = np.concatenate([np.arange(p["start"], p["start"] + p["run"]) for p in parts.as_py()])
                n = np.concatenate([np.full(p["run"], p["n"]) for p in parts.as_py()])
                h = mix64(mix64(span_hash(prefix, starts, starts + size))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(np.full(len(h), k.as_py())), pa.array(h), pa.array(starts.astype(np.int32)),
                     pa.array(np.ones(len(h), dtype=np.int32)), pa.array(n)],
                    names=["h", "k", "c", "start", "run", "n"])

    single = fetch(big, docs, ["start", "run", "n"]).mapInArrow(frugal(windows), CONTEXT + ", n bigint")
    total = single.groupBy("c").agg(F.sum("n").alias("total")).where("total > 1").select("c")
    return found.join(heavy, "h", "left_anti").unionByName(single.join(total, "c", "left_semi"))


def fetch(rows: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """``(k, text, parts)``: one text for each hash in ``rows``, with its rows' columns.

    A text's rows are its own contexts, so the list is bounded by the text.
    """
    parts = rows.groupBy("k").agg(F.collect_list(F.struct(*columns)).alias("parts"))
    # of a text that occurs often one row is used: that of the smallest row number
    one = docs.groupBy("k").agg(F.min("place").alias("place"))
    wanted = stored(parts.join(one, "k").select("place", "parts"))
    # where their row numbers are few enough to be sent everywhere, only those texts are shuffled
    few = checked_broadcast(wanted.select("place"), BROADCAST_ROWS)
    return docs.join(few, "place", "left_semi").join(wanted, "place").select("k", "text", "parts")


def _cut_out(size: int):
    def rows(batches):
        for batch in batches:
            for k, text, parts in zip(*(batch.column(j) for j in range(3)), strict=True):
                body = text.as_py().encode()
                p = parts.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["h"] for x in p]), pa.array([x["c"] for x in p]), pa.array([x["n"] for x in p]),
                     pa.array([body[x["start"]:x["start"] + x["run"] + size - 1] for x in p], type=pa.binary())],
                    names=["h", "c", "n", "body"])
    return rows


class RunLengthIndex:
    """Run-compressed transform of a string, its suffixes sorted to depth ``depth``.

    Symbols are bytes plus one; 0 parts strings laid end to end.
    """

    def __init__(self, data: np.ndarray, depth: int):
        self.data, self.depth = data, depth
        n = len(data)
        wide = np.concatenate([data, np.zeros(8, dtype=np.uint16)]).astype(np.uint64)
        key = np.zeros(n, dtype=np.uint64)
        for j in range(min(7, depth)):
            key = key << np.uint64(9) | wide[j:j + n]
        self.levels = []  # (length, rank of every place by that many symbols)
        width = min(7, depth)
        while True:
            order = np.argsort(key)
            s = key[order]
            step = np.empty(n, dtype=np.int32)
            step[0] = 0
            np.cumsum(s[1:] != s[:-1], out=step[1:])
            rank = np.empty(n, dtype=np.int32)
            rank[order] = step
            self.levels.append((width, rank))
            if width >= depth or int(step[-1]) == n - 1:
                break
            reach = min(width, depth - width)
            key = rank.astype(np.uint64) << np.uint64(32)
            key[:n - reach] |= rank[reach:].astype(np.uint64) + np.uint64(1)
            width += reach
        # nothing stands before the first place, which no run may join
        before = np.concatenate((np.array([0xFFFF], dtype=np.uint16), data[:-1]))
        self.order = order
        bwt = before[order]
        edge = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.run_start = np.concatenate(([0], edge))  # with the symbol: the compressed transform
        self.run_symbol = bwt[self.run_start]

    @property
    def runs(self) -> int:
        return len(self.run_start)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of places a and b, up to the depth."""
        n, done = len(self.data), np.zeros(len(a), dtype=np.int64)
        for width, rank in reversed(self.levels):
            go = (a + done + width <= n) & (b + done + width <= n)
            x, y = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += np.where(go & (rank[x] == rank[y]), width, 0)
        for _ in range(7):  # what is left is shorter than the least level
            x, y = a + done, b + done
            go = (x < n) & (y < n)
            done += go & (self.data[np.minimum(x, n - 1)] == self.data[np.minimum(y, n - 1)])
        return np.minimum(done, self.depth)

    def matching_statistics(self) -> np.ndarray:
        """Longest match, up to the depth, of every place with any other."""
        n = len(self.data)
        if n < 2:
            return np.zeros(n, dtype=np.int64)
        # run of each row, and which rows end a run on either side
        run = np.zeros(n, dtype=np.int32)
        run[self.run_start[1:]] = 1
        np.cumsum(run, out=run)
        head = np.concatenate(([True], run[1:] != run[:-1]))
        tail = np.concatenate((run[1:] != run[:-1], [True]))
        # a match is carried on to the left while both neighbours lie in the row's run;
        # the place left of a run end is sampled and measured anew
        ends = self.order[head | tail]
        is_sampled = np.zeros(n, dtype=bool)
        is_sampled[ends[ends > 0] - 1] = is_sampled[n - 1] = True
        sampled = np.flatnonzero(is_sampled)
        row = np.empty(n, dtype=np.int32)
        row[self.order] = np.arange(n, dtype=np.int32)
        at = row[sampled]
        up = self.extension(sampled, self.order[np.maximum(at - 1, 0)])
        down = self.extension(sampled, self.order[np.minimum(at + 1, n - 1)])
        measured = np.maximum(np.where(at > 0, up, 0), np.where(at < n - 1, down, 0))
        following = np.cumsum(is_sampled) - is_sampled  # the next sampled place at or after each
        return np.minimum(measured[following] + sampled[following] - np.arange(n), self.depth)


class Contexts(NamedTuple):
    """Distinct contexts in order of the minimiser; ``data`` holds their bytes end to end."""

    h: np.ndarray
    c: np.ndarray
    n: np.ndarray
    length: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Contexts:
        body = batch.column(3)
        _, offsets, data = body.buffers()
        at = np.frombuffer(offsets, dtype=np.int32)[body.offset:body.offset + len(body) + 1].astype(np.int64)
        return cls(*(batch.column(j).to_numpy() for j in range(3)), np.diff(at),
                   np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]])

    @classmethod
    def joined(cls, parts: list[Contexts]) -> Contexts:
        return cls(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    def pick(self, keep: np.ndarray) -> Contexts:
        return Contexts(self.h[keep], self.c[keep], self.n[keep], self.length[keep],
                        self.data[np.repeat(keep, self.length)])

    def cut(self, i: int) -> tuple[Contexts, Contexts]:
        x = int(self.length[:i].sum())
        return (Contexts(self.h[:i], self.c[:i], self.n[:i], self.length[:i], self.data[:x]),
                Contexts(self.h[i:], self.c[i:], self.n[i:], self.length[i:], self.data[x:]))


def indexed_marks(x: Contexts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, from, to): the ranges of window starts of each context that are repeats."""
    length = x.length + 1
    begin = np.cumsum(length) - length
    data = np.zeros(int(length.sum()), dtype=np.uint16)
    body = np.ones(len(data), dtype=bool)
    body[begin + length - 1] = False
    data[body] = x.data.astype(np.uint16) + 1
    marked = RunLengthIndex(data, size).matching_statistics() >= size
    # the bytes of a context counted twice are repeats throughout
    marked |= np.repeat(x.n > 1, length)
    # a window ends within its context
    own = np.repeat(np.arange(len(length)), length)
    marked &= np.arange(len(data)) + size < (begin + length)[own]
    # a window never reaches the separator, so runs of marks end within their context
    first = np.flatnonzero(marked & ~np.concatenate(([False], marked[:-1])))
    last = np.flatnonzero(marked & ~np.concatenate((marked[1:], [False])))
    of = own[first]
    return x.c[of], first - begin[of], last + 1 - begin[of]


def context_marks(x: Contexts, size: int):
    """Marks of whole minimiser groups.

    A context that is the only one of its minimiser but was counted more than
    once is a repeat throughout: nothing else can tell more about it.
    """
    edge = np.concatenate(([True], x.h[1:] != x.h[:-1], [True]))
    plain = edge[:-1] & edge[1:] & (x.n > 1)
    yield x.c[plain], np.zeros(int(plain.sum()), dtype=np.int64), x.length[plain] - size + 1
    if not plain.all():
        yield indexed_marks(x.pick(~plain), size)


def _marks(size: int, index_bytes: int):
    """Marks of the contexts of a task, whose rows come in order of the minimiser."""
    def flush(parts):
        for c, a, b in context_marks(Contexts.joined(parts), size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["c", "from", "to"])

    def rows(batches):
        held, volume = [], 0
        for batch in batches:
            x = Contexts.of(batch)
            while len(x.h):
                # up to the volume wanted, then on to the end of the minimiser's group
                full = int(np.searchsorted(np.cumsum(x.length), index_bytes - volume, side="left"))
                if full >= len(x.h):
                    held.append(x)
                    volume += len(x.data)
                    break
                end = int(np.searchsorted(x.h, x.h[full], side="right"))
                if end == len(x.h):  # the group may go on in the next batch
                    held.append(x)
                    volume += len(x.data)
                    break
                head, x = x.cut(end)
                yield from flush([*held, head])
                held, volume = [], 0
        if held:
            yield from flush(held)
    return rows


def repeats(docs: DataFrame, size: int = L, anchor: int = ANCHOR, hot: int = HOT,
            index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``(k, covered)``: per text hash the byte ranges that repeated strings cover."""
    found = stored(find_contexts(docs, size, anchor))
    found = split_hot(found, docs, size, hot)
    chosen = found.groupBy("h", "c").agg(F.min(F.struct("k", "start", "run")).alias("at"), F.sum("n").alias("n")) \
        .select("h", "c", "n", "at.k", "at.start", "at.run")
    bodies = fetch(chosen, docs, ["h", "c", "n", "start", "run"]) \
        .mapInArrow(frugal(_cut_out(size)), "h bigint, c bigint, n bigint, body binary")
    marks = bodies.repartition("h").sortWithinPartitions("h") \
        .mapInArrow(frugal(_marks(size, index_bytes)), "c bigint, `from` int, `to` int")
    covered = F.struct((F.col("start") + F.col("from")).alias("from"),
                       (F.col("start") + F.col("to") + F.lit(size - 1)).alias("to"))
    return found.select("k", "c", "start").join(marks, "c").select("k", covered.alias("part")) \
        .groupBy("k").agg(F.collect_list("part").alias("covered"))


def without(body: bytes, parts: list[dict]) -> tuple[bytes, list[list[int]]]:
    """(bytes outside the ranges, the ranges merged)."""
    merged: list[list[int]] = []
    for a, b in sorted((x["from"], x["to"]) for x in parts):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    edges = [0, *[e for m in merged for e in m], len(body)]
    return b"".join(body[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)), merged


def cut(text, covered):
    """Column: ``struct(kept binary, spans)`` of a text without the covered bytes."""
    @F.arrow_udf("struct<kept: binary, spans: array<struct<start: bigint, end: bigint>>>")
    def cut_(column: pa.Array, parts: pa.Array) -> pa.Array:
        kept, spans = [], []
        for t, p in zip(column, parts, strict=True):
            rest, merged = without(t.as_py().encode(), p.as_py())
            kept.append(rest)
            spans.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(kept, type=pa.binary()), pa.array(spans, type=kind)],
                                          names=["kept", "spans"])

    return cut_(text, covered)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, place, k)`` of rows with a number ``_cut_place``, with the text's hash ``k``.

    The row number ``place`` only tells rows of equal text apart.
    """
    return texts(docs, id_col, text_col, place="_cut_place").select("*", F.xxhash64("text").alias("k"))


def without_repeats(docs: DataFrame, size: int = L, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """``(doc_id, text, kept binary, spans)`` of every row: its bytes without repeats."""
    slim = keyed(placed(docs, "_cut_place"), id_col, text_col)
    covered = stored(repeats(slim.select("k", "place", "text"), size, **options))
    slim = slim.drop("place")
    touched = checked_broadcast(covered.select("k"), BROADCAST_ROWS)
    # texts without repeats stay where they are if the others' hashes can be sent everywhere
    some = slim.join(touched, "k", "left_semi").join(covered, "k") \
        .select("doc_id", "text", cut(F.col("text"), F.col("covered")).alias("cut")) \
        .select("doc_id", "text", "cut.kept", "cut.spans")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    rest = slim.join(touched, "k", "left_anti") \
        .select("doc_id", "text", F.col("text").cast("binary").alias("kept"), none.alias("spans"))
    return some.unionByName(rest)


def strip(docs: DataFrame, size: int = L, **options) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; other columns stay.

    Bytes of a character that a cut splits go with it, so the text stays valid.
    """
    columns = docs.columns
    docs = placed(docs, "_cut_place")
    slim = keyed(docs)
    covered = stored(repeats(slim.select("k", "place", "text"), size, **options))
    rows = docs.withColumn("_cut_k", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    touched = checked_broadcast(covered.select(F.col("k").alias("_cut_k")), BROADCAST_ROWS)

    @F.arrow_udf("string")
    def readable(column: pa.Array, parts: pa.Array) -> pa.Array:
        return pa.array([without(t.as_py().encode(), x.as_py())[0].decode("utf-8", "ignore")
                         for t, x in zip(column, parts, strict=True)], type=pa.string())

    some = rows.join(touched, "_cut_k", "left_semi") \
        .join(covered.select(F.col("k").alias("_cut_k"), F.col("covered").alias("_cut_covered")), "_cut_k") \
        .select(*[readable(F.col("text"), F.col("_cut_covered")).alias(c) if c == "text" else F.col(f"`{c}`")
                  for c in columns])
    rest = rows.join(touched, "_cut_k", "left_anti").select(*[F.col(f"`{c}`") for c in columns])
    return some.unionByName(rest)


def digest(result: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, and the hash of what is left."""
    n = F.octet_length("text").cast("bigint")
    return result.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"),
                         F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
