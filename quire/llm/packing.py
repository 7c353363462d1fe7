"""Best-fit packing (operator 4): minimum bin slack over token lengths.

Documents are tokenised, closed with an end id, cut into pieces of at most
``capacity`` tokens, and the pieces are packed into as few sequences as the
heuristic finds.  Minimum bin slack builds one sequence at a time: the longest
piece left opens it, then a subset-sum dynamic programme over the lengths still
available (a bitset of reachable sums, one machine integer of ``capacity`` bits)
finds the fullest feasible combination, which is taken out.

Scale: only the *histogram of lengths* (at most ``capacity`` numbers, whatever
the corpus) reaches the driver.  A combination is used as often as the counts
allow before the programme runs again, so each use exhausts a length and there
are at most about ``capacity`` combinations.  Pieces are then dealt to their
places by their number among the pieces of equal length: a running number
inside each task plus an offset by (task, length).  No group is gathered, so a
length that a third of all pieces share is no hot key.

Tokens: the vocabulary file folds case, drops white space and parts letters from
other signs before its merges, so text between ASCII blanks, and a full stop or
comma after an ASCII letter, is tokenised apart, once per distinct word while a
worker keeps it (Unicode composition crosses none of these places).

Defined results: null or empty text is one piece holding the end id; repeated
rows are packed as often as they occur; an empty table gives an empty result;
a null id is carried along.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, texts
from quire.llm.kernels import EXACT, FOLDED, U64, blocks, frugal, mix64, prefix_hash, span_hash, words

CAPACITY = 4096
END_ID = 1

_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord("."), ord(",")]] = True


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids of words, each distinct word encoded once while it is kept."""

    KEEP = 600_000  # words kept before the memory is let go and begun again

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=U64)  # sorted word hashes
        self.place = np.zeros(0, dtype=np.int64)  # their entry in starts/lengths
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, block) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the block in order, ids per row)."""
        if not len(block.data):
            return np.zeros(0, dtype=np.uint32), np.zeros(block.rows, dtype=np.int64)
        w, h = self._words(block)
        if not len(h):
            return np.zeros(0, dtype=np.uint32), np.zeros(block.rows, dtype=np.int64)
        order = np.argsort(h)
        s = h[order]
        head = np.concatenate(([True], s[1:] != s[:-1]))
        distinct, first = s[head], order[head]
        if len(self.known) > self.KEEP:
            self._forget()
        self._learn(block, w, distinct, first)
        entry = self.place[np.searchsorted(self.known, distinct)]
        of_word = np.empty(len(h), dtype=np.int64)
        of_word[order] = entry[np.cumsum(head) - 1]
        count = self.lengths[of_word]
        before = np.cumsum(count) - count
        total = int(count.sum())
        flat = np.repeat(self.starts[of_word] - before, count) + np.arange(total)
        per_row = np.bincount(w.row, weights=count, minlength=block.rows).astype(np.int64)
        return self.ids[flat], per_row

    @staticmethod
    def _words(block):
        """Words and their case-folded hashes; those that hold "<" (special tokens) by exact hash."""
        data = block.data
        w = words(block, cuts=np.flatnonzero(_STOP[data[1:]] & _ALPHA[data[:-1]]) + 1)
        h = span_hash(prefix_hash(block, FOLDED), w.start, w.end)
        if (data == 60).any():
            seen = np.concatenate(([0], np.cumsum(data == 60)))
            special = seen[w.end] > seen[w.start]
            exact = prefix_hash(block, EXACT)
            h[special] = mix64(span_hash(exact, w.start[special], w.end[special]))
        return w, h

    def _learn(self, block, w, distinct, first) -> None:
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if not new.any():
            return
        where = first[new]
        body = block.data.tobytes()
        strings = [body[a:b].decode("utf-8", "replace") for a, b in
                   zip(w.start[where].tolist(), w.end[where].tolist(), strict=True)]
        encoded = [e.ids for a in range(0, len(strings), 2000)
                   for e in self.tokenizer.encode_batch_fast(strings[a:a + 2000], add_special_tokens=False)]
        lengths = np.array([len(e) for e in encoded], dtype=np.int64)
        ids = np.array([i for e in encoded for i in e], dtype=np.uint32)
        entry = len(self.lengths) + np.arange(len(lengths))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, distinct[new]])
        order = np.argsort(known)
        self.known, self.place = known[order], np.concatenate([self.place, entry])[order]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


PIECE_SCHEMA = ("piece int, start bigint, length bigint, ids_crc32 bigint, "
                "task int, nth bigint")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """Every document's pieces: place, length, checksum and (on request) the ids.

    ``task`` and ``nth`` number the pieces of equal length within one task; they
    hold for one computation, so the caller stores the frame before use.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        encoder = word_ids(path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for b in blocks(batch.column(1)):
                ids, count = encoder.encode(b)
                ends = np.cumsum(count + 1)
                closed = np.empty(len(ids) + b.rows, dtype="<u4")
                closed[ends - 1] = end_id
                body = np.ones(len(closed), dtype=bool)
                body[ends - 1] = False
                closed[body] = ids
                n = -(-(count + 1) // capacity)  # pieces per row
                row = np.repeat(np.arange(b.rows), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, (count + 1)[row] - start)
                at = (ends - count - 1)[row] + start
                spans = list(zip(at.tolist(), (at + length).tolist(), strict=True))
                raw = memoryview(closed.view(np.uint8))
                crc = np.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in spans], dtype=np.int64)
                order = np.argsort(length, kind="stable")
                s = length[order]
                head = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                size = np.diff(np.append(head, len(s)))
                nth = np.empty(len(s), dtype=np.int64)
                nth[order] = np.arange(len(s)) - np.repeat(head, size) + seen[s]
                seen[s[head]] += size
                columns = [batch.column(0).take(pa.array(b.first + row)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array(crc),
                           pa.array(np.full(len(row), task, dtype=np.int32)), pa.array(nth)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        np.append(at, len(closed)).astype(np.int32), pa.array(closed.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, {PIECE_SCHEMA}" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(frugal(cut), schema)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to ``room``.

    ``available``: (length, count), longest first.  Bitset subset-sum: bit s of
    ``reach`` says that some combination so far sums to s; a length's count is
    taken in powers of two.  Stops once ``room`` itself is reached.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in available:
        if length > room:
            continue
        left, unit = min(count, room // length), 1
        while left and not reach >> room & 1:
            take = min(unit, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            unit *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces in a sequence}) for all of ``counts``."""
    left = dict(sorted(counts.items(), reverse=True))
    plan = []
    while left:
        longest = next(iter(left))
        rest = [(x, c - (x == longest)) for x, c in left.items()]
        used = fullest([(x, c) for x, c in rest if c], capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // k for x, k in used.items())
        plan.append((times, used))
        for x, k in used.items():
            left[x] -= times * k
            if not left[x]:
                del left[x]
    return plan


def places(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """The plan as rows (length, first rank, per sequence, first sequence, offset),
    ordered by length and rank."""
    rows, taken, sequence = [], {}, 0
    for times, used in plan:
        offset = 0
        for length, k in sorted(used.items(), reverse=True):
            rows.append((length, taken.get(length, 0), k, sequence, offset))
            taken[length] = taken.get(length, 0) + times * k
            offset += length * k
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``."""
    found = stored(pieces(texts(docs, id_col, text_col), path or vocabulary(), capacity, end_id, with_ids))
    counts = found.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in
                 found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(minimum_bin_slack(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    key = table[:, 0] << 44 | table[:, 1]

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(key, n << 44 | r, side="right") - 1
        _, first, k, sequence, offset = table[at].T
        return pa.StructArray.from_arrays(
            [pa.array(sequence + (r - first) // k), pa.array(offset + (r - first) % k * n)],
            names=["sequence_id", "offset"])

    out = found.join(base, ["task", "length"]) \
        .withColumn("place", place("length", F.col("nth") + F.col("base")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset",
                      *(["ids"] if with_ids else []))
