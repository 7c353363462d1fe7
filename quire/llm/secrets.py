"""Secret scans (operator 5): base patterns, and Markov models of characters.

Base spans come from three fixed patterns (assignments, access keys, long hex).
Two first-order Markov models over characters are trained from labelled samples:
*random* from the values of the base matches of the whole corpus and from
generated strings over the usual alphabets, *ordinary* from all other text of
the corpus.  A run of at least ``MIN_RUN`` identifier characters outside the base
spans is a secret of kind ``markov`` if its log-likelihood ratio is at least
``MIN_RATIO`` nats.

Scale: two scans, no text shuffled.  The models are 128 x 128 counts, summed from
one partial table per task.  Rows are searched with byte kernels first, and the
patterns run only over whole texts that can hold a match.  All patterns are
matched on bytes; offsets are reported in code points.

Defined results: null or empty text has no spans (digest of the empty string);
repeated rows get equal results; an empty corpus gives an empty result (the
ordinary model is then uniform); a null id is carried along.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import texts
from quire.llm.kernels import U64, blocks, seeded

MIN_RUN = 16
MIN_RATIO = 12.0
KINDS = ("assign", "access", "hex", "markov")

#: Fixed patterns and least sizes of the base kinds.
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # equal to [0-9a-f]+ of 24 or more: runs are maximal
MIN_VALUE, MIN_ACCESS = 6, 20
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_DIGITS, _LOWER = b"0123456789", bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_HEX = _class(_DIGITS + b"abcdef")
_RUN = _class(_DIGITS + _LOWER + _UPPER + b"+/_=-")
_ALPHABETS = (_DIGITS + b"abcdef", _UPPER + b"234567", _DIGITS + _UPPER, _DIGITS + _LOWER,
              _DIGITS + _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER + b"+/", _DIGITS + _LOWER + _UPPER + b"-_")


def long_runs(mask: np.ndarray, n: int) -> np.ndarray:
    """Positions at which ``n`` set values in a row begin."""
    have, width = mask, 1
    while width < n:
        step = min(width, n - width)
        if len(have) <= step:
            return np.zeros(0, dtype=np.int64)
        have = have[:-step] & have[step:]
        width += step
    return np.flatnonzero(have)


def occurrences(body: bytes, what: bytes) -> list[int]:
    out, at = [], body.find(what)
    while at >= 0:
        out.append(at)
        at = body.find(what, at + 1)
    return out


def rows_at(block, positions) -> set[int]:
    if not len(positions):
        return set()
    return set(np.unique(np.searchsorted(block.offsets, np.asarray(positions), side="right") - 1).tolist())


def base_rows(block) -> dict[str, set[int]]:
    """Rows that can hold each base kind; never misses one."""
    body = block.data.tobytes()
    low = body.lower()
    assign = set()
    for hint in HINTS:
        assign |= rows_at(block, occurrences(low, hint))
    return {"assign": assign, "access": rows_at(block, occurrences(body, b"AKIA")),
            "hex": rows_at(block, long_runs(_HEX[block.data], 24))}


def base_spans(text: bytes, kinds) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) in bytes, in order."""
    out = []
    if "assign" in kinds:
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= MIN_VALUE]
    if "access" in kinds:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    if "hex" in kinds:
        out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def block_base(block) -> dict[int, list]:
    """Base spans of the rows that have any."""
    rows = base_rows(block)
    out = {}
    for r in sorted(set().union(*rows.values())):
        if spans := base_spans(block.text(r), {k for k in rows if r in rows[k]}):
            out[r] = spans
    return out


def transitions(data: np.ndarray) -> np.ndarray:
    """Counts of neighbouring ASCII characters, as 128 * first + second."""
    if len(data) < 2:
        return np.zeros(128 * 128, dtype=np.int64)
    a, b = data[:-1].astype(np.int32), data[1:]
    both = _RUN[data]
    pair = (a << 7 | b)[both[:-1] & both[1:]]
    return np.bincount(pair, minlength=128 * 128)


def _counts(batches):
    ordinary = np.zeros(128 * 128, dtype=np.int64)
    random = np.zeros(128 * 128, dtype=np.int64)
    for batch in batches:
        for b in blocks(batch.column(0)):
            ordinary += transitions(b.data)
            for r, spans in block_base(b).items():
                text = b.data[b.offsets[r]:b.offsets[r + 1]]
                for start, _, end, v0, v1 in spans:
                    ordinary -= transitions(text[start:end])
                    random += transitions(text[v0:v1])
    used = np.flatnonzero(ordinary | random)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(ordinary[used]),
                                      pa.array(random[used])], names=["pair", "ordinary", "random"])


def generated() -> np.ndarray:
    """Counts of the generated random strings: 64 of 64 characters an alphabet."""
    out = np.zeros(128 * 128, dtype=np.int64)
    for i, alphabet in enumerate(_ALPHABETS):
        letters = np.frombuffer(alphabet, dtype=np.uint8)
        text = letters[(seeded(64 * 64, 101 + i) % U64(len(letters))).astype(np.int64)]
        out += transitions(text)
    return out


def conditional(counts: np.ndarray) -> np.ndarray:
    """log P(second | first), add-one over identifier characters."""
    c = counts.reshape(128, 128).astype(np.float64) + np.where(_RUN[:128], 1.0, 0.0)[None, :]
    return np.log(np.maximum(c, 1e-300) / c.sum(axis=1, keepdims=True))


def fit(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition (fixed size) from the whole corpus."""
    ordinary = np.zeros(128 * 128, dtype=np.int64)
    random = generated()
    for r in docs.select("text").mapInArrow(_counts, "pair int, ordinary bigint, random bigint") \
            .groupBy("pair").agg(F.sum("ordinary").alias("o"), F.sum("random").alias("r")).collect():
        ordinary[r["pair"]] += max(r["o"], 0)
        random[r["pair"]] += r["r"]
    return (conditional(random) - conditional(ordinary)).ravel()


def block_spans(block, ratio: np.ndarray) -> dict[int, list]:
    """All spans of the rows that have any: (start, kind, end) in bytes, in order."""
    base = block_base(block)
    out = {r: [s[:3] for s in spans] for r, spans in base.items()}
    for r in rows_at(block, long_runs(_RUN[block.data], MIN_RUN)):
        text = block.text(r)
        data = np.frombuffer(text, dtype=np.uint8).astype(np.int32)
        taken = [(s[0], s[2]) for s in base.get(r, ())]
        for m in RUN.finditer(text):
            a, b = m.span()
            if any(a < e and s < b for s, e in taken):
                continue
            if ratio[data[a:b - 1] << 7 | data[a + 1:b]].sum() >= MIN_RATIO:
                out.setdefault(r, []).append((a, 3, b))
    return {r: sorted(spans) for r, spans in out.items()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans array<struct<kind, start, end, value>>)`` of every row.

    Offsets are code points, the end exclusive; spans are ordered by start and
    kind (as listed in ``KINDS``).
    """
    slim = texts(docs, id_col, text_col)
    ratio = fit(slim)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint, value: string>>")
    def found(column: pa.Array) -> pa.Array:
        out = [[]] * len(column)
        for b in blocks(column):
            for r, spans in block_spans(b, ratio).items():
                text = b.text(r)
                lead = np.frombuffer(text, dtype=np.uint8) & 0xC0 != 0x80
                place = np.concatenate(([0], np.cumsum(lead))).tolist()
                out[b.first + r] = [{"kind": KINDS[k], "start": place[s], "end": place[e],
                                     "value": text[s:e].decode("utf-8", "replace")} for s, k, e in spans]
        return pa.array(out, type=pa.list_(span))

    return slim.select("doc_id", found("text").alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans, and all spans as text."""
    def joined(spans_col):
        return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != "markov")
    return spans.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
