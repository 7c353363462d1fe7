"""Filter interaction audit (operator 13): radix text tries.

Five filters fail a document: A under 100 words; B under 80 distinct words in 100;
C more than 10 capitals A-Z in 100 code points; D any of ``#$%&*|``; E a text that a
smaller id of the table has too.  ``audit`` tells, for each part (language) and each
of the 120 orders in which the filters can be applied, what every step keeps and
removes, and how the filters overlap.

Duplicates (E) are found on full texts.  A survey places cuts in the order of all
texts: a bounded number of keys, chosen by a hash of the text in proportion to its
bytes, start as short prefixes; a prefix that holds more than a range's share of them
is surveyed again with prefixes eight times as long.  Texts go to ranges by those
cuts, so equal texts meet; a range's texts are put, one after the other, into a
compressed trie whose terminals hold the smallest id and what was counted at the
text.  The trie is then walked once: what lies at a terminal under a greater id
fails E, and the counts by (part, filters failed, labels) leave the task.

Scale: a text crosses the network once.  Copies are merged before the shuffle (one
row for all copies of a text within FLUSH bytes of input), so a text that a third of
all rows share is some rows of one range, and the trie keeps one state for it.  A
range has about ``range_bytes`` of text.  The survey sees at most KEYS keys a range,
and only places cuts.  What reaches the final step is 32 masks x 4 labels a part.
Labels are broadcast only if a count proves them few, else joined by id.

Defined results: null text is the empty one, null language the part ``''``; a row
without an id is never a duplicate and makes no other row one; rows of one id with
one text are duplicates of smaller ids only, not of each other; a document with
several label rows is good or toxic if any says so; no documents give no rows.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import texts
from quire.llm.kernels import U64, Block, blocks, frugal, word_hashes
from quire.session import checked_broadcast

# The five filters and their limits.
FILTERS = "ABCDE"
WORDS, DISTINCT, CAPITALS, MARKS = 100, 80, 10, b"#$%&*|"

RANGE_BYTES = 16 << 20  # least size of a range's texts
KEYS = 8  # surveyed keys a range
FIRST, LONGER = 24, 8  # characters of a first key, and how much longer the next ones are
FLUSH = 8 << 20
LABELS = 1_000_000  # label rows that may be broadcast

_MARK = np.zeros(256, dtype=bool)
_MARK[list(MARKS)] = True


def _row_counts(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """Distinct word hashes of each row."""
    if not len(h):
        return np.zeros(rows, dtype=np.int64)
    room = max(1, int(rows).bit_length())
    key = np.sort((row.astype(U64) << U64(64 - room)) | (h >> U64(room)))
    first = np.concatenate(([True], key[1:] != key[:-1]))
    return np.bincount((key[first] >> U64(64 - room)).astype(np.int64), minlength=rows)


def failed(block: Block) -> np.ndarray:
    """Which of A, B, C, D (bits 0 to 3) each row of a block fails."""
    w, h = word_hashes(block)
    n = np.bincount(w.row, minlength=block.rows)
    distinct = _distinct(w.row, h, block.rows)
    few = 100 * distinct < DISTINCT * n
    # equal hashes of unequal words could only lower a count: near the limit words are compared
    for r in np.flatnonzero(few & (100 * (distinct + 4) >= DISTINCT * n)):
        few[r] = 100 * len(set(block.text(r).split())) < DISTINCT * n[r]
    capitals = _row_counts((block.data >= 65) & (block.data <= 90), block.offsets)
    points = _row_counts((block.data & 0xC0) != 0x80, block.offsets)
    marks = _row_counts(_MARK[block.data], block.offsets)
    return (n < WORDS) | few * 2 | (100 * capitals > CAPITALS * points) * 4 | (marks > 0) * 8


class Terminal:
    """What is known of one text: its smallest id, and the rows counted at it.

    ``cells[(part, labels)] = [rows with an id, rows of the smallest id, rows without an id]``
    """

    __slots__ = ("cells", "least", "mask")

    def __init__(self, mask: int):
        self.mask, self.least, self.cells = mask, None, {}

    def add(self, least, cells) -> None:
        """Counts of the same text: ``cells`` are (part, labels, rows, rows of ``least``, rows without an id)."""
        if least is not None and (self.least is None or least < self.least):
            self.least = least
            for c in self.cells.values():
                c[1] = 0
        smallest = least is not None and least == self.least
        for part, labels, n, at, free in cells:
            c = self.cells.setdefault((part, labels), [0, 0, 0])
            c[0] += n
            c[1] += at if smallest else 0
            c[2] += free


def common(text: bytes, at: int, label: bytes) -> int:
    """Length of the longest common prefix of ``text[at:]`` and ``label``."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if text[at + low:at + mid] == label[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Texts in a compressed trie: a node is [label, children by first byte, terminal or None]."""

    def __init__(self):
        self.root = [b"", {}, None]

    def terminal(self, text: bytes, mask: int) -> Terminal:
        """The terminal of ``text``, made on its first insertion."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
            elif not text.startswith(child[0], at):
                same = common(text, at, child[0])
                upper = [child[0][:same], {child[0][same]: child}, None]
                child[0] = child[0][same:]
                node[1][text[at]] = child = upper
            node, at = child, at + len(child[0])
        if node[2] is None:
            node[2] = Terminal(mask)
        return node[2]

    def terminals(self):
        todo = [self.root]
        while todo:
            _, children, terminal = todo.pop()
            if terminal is not None:
                yield terminal
            todo += children.values()


CELL = pa.struct([("part", pa.string()), ("labels", pa.int32()), ("n", pa.int64()), ("at", pa.int64()),
                  ("free", pa.int64())])
MERGED = pa.schema([("range", pa.int32()), ("text", pa.binary()), ("mask", pa.int32()), ("least", pa.int64()),
                    ("cells", pa.list_(CELL))])
MERGED_SQL = "range int, text binary, mask int, least bigint, " \
    "cells array<struct<part: string, labels: int, n: bigint, at: bigint, free: bigint>>"
STEPS_SQL = "array<struct<filter_order: string, step: int, kept: array<int>, removed: array<int>, " \
    "redundant: array<int>, unique_fails: array<int>, fails: array<int>>>"
COUNTS_SQL = "part string, mask int, labels int, n bigint"


def _merged(cuts: list[bytes]):
    """Task: texts with their filters and counts, copies merged, under their ranges."""

    def flush(seen: dict):
        items = list(seen.items())
        yield pa.RecordBatch.from_arrays([
            pa.array([bisect_right(cuts, t) for t, _ in items], type=pa.int32()),
            pa.array([t for t, _ in items], type=pa.binary()),
            pa.array([s.mask for _, s in items], type=pa.int32()),
            pa.array([s.least for _, s in items], type=pa.int64()),
            pa.array([[{"part": p, "labels": f, "n": c[0], "at": c[1], "free": c[2]}
                       for (p, f), c in s.cells.items()] for _, s in items], type=pa.list_(CELL)),
        ], schema=MERGED)

    def task(batches):
        seen, size = {}, 0
        for batch in batches:
            ids, parts, labels = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                                  for c in ("doc_id", "part", "labels"))
            for block in blocks(batch.column(batch.schema.get_field_index("text"))):
                for r, mask in enumerate(failed(block).tolist()):
                    text, i = block.text(r), block.first + r
                    state = seen.get(text)
                    if state is None:
                        state = seen[text] = Terminal(mask)
                        size += len(text) + 200
                    known = ids[i] is not None
                    state.add(ids[i], [(parts[i], labels[i], int(known), int(known), int(not known))])
                if size > FLUSH:
                    yield from flush(seen)
                    seen, size = {}, 0
        if seen:
            yield from flush(seen)

    return frugal(task)


def _walked(batches):
    """Task: the tries of its ranges, and the counts of what lies at their terminals."""
    trie = RadixTrie()
    for batch in batches:
        column = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "mask", "least", "cells")]
        for text, mask, least, cells in zip(*column, strict=True):
            trie.terminal(text, mask).add(least, [(c["part"], c["labels"], c["n"], c["at"], c["free"]) for c in cells])
    counts = defaultdict(int)
    for t in trie.terminals():
        for (part, labels), (n, at, free) in t.cells.items():
            counts[part, t.mask, labels] += at + free
            counts[part, t.mask | 16, labels] += n - at
    rows = [(*k, n) for k, n in counts.items() if n]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(
            zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
            names=["part", "mask", "labels", "n"])


def range_bytes(total: int) -> int:
    """Size of a range: it grows with the root of the input, as do the number of ranges and cuts."""
    return max(RANGE_BYTES, math.isqrt(total * 512))


def cut_points(docs: DataFrame, total: int, keys: int = KEYS, first: int = FIRST) -> list[bytes]:
    """Prefixes, in order, that cut the distinct texts into ranges of about equal bytes."""
    parts = math.ceil(total / range_bytes(total))
    if parts < 2:
        return []
    share = F.octet_length("text").cast("double") * (keys * parts / total)
    drawn = (F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)) < share
    found, length, within = [], first, None
    while True:
        rows = docs.where(drawn) if within is None else docs.where(drawn & F.substring("text", 1, length // LONGER).isin(within))
        # copies of one text are drawn together and count once
        new = rows.select(F.substring("text", 1, length).alias("key"), F.xxhash64("text").alias("name")).distinct()
        found += [r["key"] for r in new.select("key").collect()]
        often = defaultdict(int)
        for k in found:
            often[k] += 1
        within = [k for k, n in often.items() if n > keys and len(k) == length]
        if not within:
            break
        hot = set(within)
        found, length = [k for k in found if k not in hot], length * LONGER
    found = sorted(k.encode() for k in found)
    out = []
    for i in range(keys, len(found), keys):
        before, key = found[i - 1], found[i]
        if key > before:  # the shortest prefix that lies above the key before
            out.append(key[:common(key, 0, before) + 1])
    return sorted(set(out))


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """``(part, mask, labels, n)``: documents by filters failed (bits A to E) and labels (good 1, toxic 2)."""
    whole = texts(docs, id_col, text_col, part=part_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    total = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = cut_points(whole, total)
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
                           F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic")) \
        .groupBy("doc_id").agg((F.max("good") + 2 * F.max("toxic")).alias("labels")).where("labels > 0")
    rows = whole.join(checked_broadcast(marked, LABELS), "doc_id", "left") \
        .select("doc_id", "text", "part", F.coalesce("labels", F.lit(0)).alias("labels"))
    merged = rows.mapInArrow(_merged(cuts), MERGED_SQL)
    return merged.repartitionById(len(cuts) + 1, "range").mapInArrow(frugal(_walked), COUNTS_SQL) \
        .groupBy("part", "mask", "labels").agg(F.sum("n").alias("n"))


def steps() -> list[dict]:
    """For each order and step the masks (sets of failed filters) that each count adds up."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            here = [m for m in range(32) if m & bit[f]]
            out.append({"filter_order": "".join(order), "step": i + 1,
                        "kept": [m for m in range(32) if not m & (before | bit[f])],
                        "removed": [m for m in here if not m & before],
                        "redundant": [m for m in here if m & before],
                        "unique_fails": [bit[f]], "fails": here})
            before |= bit[f]
    return out


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row a part, order and step; see the module's text."""
    counts = failures(docs, labels, **columns)
    # 32 counts a part, by mask: all documents, the good ones, the toxic ones
    where = {"n": F.lit(True), "good": F.col("labels").bitwiseAND(1) > 0, "toxic": F.col("labels") >= 2}
    masks = counts.groupBy("part").agg(*[
        F.array(*[F.sum(F.when((F.col("mask") == m) & test, F.col("n")).otherwise(0)) for m in range(32)]).alias(name)
        for name, test in where.items()])
    every = F.from_json(F.lit(json.dumps(steps())), STEPS_SQL)
    rows = masks.select("part", "n", "good", "toxic", F.explode(every).alias("s"))

    def total(of: str, over: str):
        return F.aggregate(f"s.{over}", F.lit(0).cast("bigint"), lambda a, m: a + F.element_at(of, m + 1))

    # of the 120 orders, 120 / (filters a document fails) have a given one of these first
    shapley = F.aggregate("s.fails", F.lit(0).cast("bigint"), lambda a, m: a + (
        F.element_at("n", m + 1) * (F.lit(120) / F.bit_count(m)).cast("bigint")))
    return rows.select("part", "s.filter_order", "s.step", total("n", "kept").alias("kept"),
                       total("n", "removed").alias("removed"), total("n", "redundant").alias("redundant"),
                       total("n", "unique_fails").alias("unique_fails"), total("good", "removed").alias("good_lost"),
                       total("toxic", "removed").alias("toxic_lost"), shapley.alias("shapley"))


_WORD = r"'[^\x20\x09-\x0D]+'"
#: DuckDB: the same audit by grouping whole texts.
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents
), w AS (
  SELECT d.*, regexp_extract_all(text, {_WORD}) AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT w.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN w.doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), m AS (
  SELECT c.*, s.*, contains(fails, f) AS here, regexp_matches(fails, '[' || earlier || '-]') AS gone FROM c, s
), t AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
    CAST(sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM t
"""
