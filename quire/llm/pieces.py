"""SentencePiece encoding and decoding (operator 8): N-best segmentations.

A text is written with the meta space for blanks and a leading one; its lattice
has an edge for every vocabulary piece at every place, and a segmentation scores
the sum of its pieces' scores in the model file.  A character without a piece of
its own is spelled in byte pieces at ``PENALTY`` below the least score.

No piece holds a blank behind another sign, so the lattice falls apart before
every run of blanks (and, where the vocabulary has no piece across it, between a
letter and a following stop or comma) into *chunks*.  Per distinct chunk a
forward Viterbi pass gives the best score up to every place; a backward pass the
best score from it; the best segmentation that leaves the best one somewhere is
the greatest forward + edge + backward over edges off the best path.  The N-best
list of a chunk is found by A-star search from its end to its start with the
forward scores as exact heuristic, so only nodes of the N best paths are opened.
A text's N best segmentations change at most N - 1 chunks, those whose second
best is nearest to their best; their N-best lists are merged by a search over sums,
and every segmentation found is written out with its own ids.

Scale: one scan, no shuffle; what a task keeps of distinct chunks is bounded by
``KEEP``, and chunks are solved ``SOLVE_BYTES`` at a time.  Scores are whole numbers in the model, so sums are exact.

Defined results: null or empty text has no pieces, one (empty) segmentation of
score 0; a text has fewer than N scores if it has fewer segmentations; ties in
score are resolved to the longest last piece in the best segmentation; repeated
rows get equal results; an empty table gives an empty result.  Decoding the ids of
any segmentation gives the text back, a literal meta space (U+2581) as a blank.
"""

from __future__ import annotations

import heapq
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import texts
from quire.llm.kernels import _BASE_INV, EXACT, U64, blocks, mix64, powers, prefix_hash
from quire.llm.kernels import _BASE as BASE

N_BEST = 4
PENALTY = 10.0
_META = "▁"
_META_BYTES = _META.encode()
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord("."), ord(",")]] = True


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _strings(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes end to end, offsets)."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), offsets


def _raw(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(_BASE_INV, len(prefix))[start]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + count), one after another."""
    total = int(counts.sum())
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)


class Lattice:
    """The vocabulary, and what is known of distinct chunks."""

    KEEP = 500_000
    SOLVE_BYTES = 1 << 16  # of chunks solved at once; an edge table has ``widest`` cells a byte

    def __init__(self, path: str, n_best: int):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best = n_best
        self.of: dict[bytes, tuple[int, float]] = {}
        self.byte_id: dict[int, int] = {}
        spelled: list[bytes] = []
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                spelled.append(b"")
            else:
                b = piece.replace(_META, " ").encode()
                self.of[b] = (i, float(m.get_score(i)))
                spelled.append(b)
        plain = [s for _, s in self.of.values() if s > -1e8]
        self.unknown = min(plain) - PENALTY
        self.piece_bytes, self.piece_offsets = _strings(spelled)
        self.widest = max(map(len, self.of))
        data, offsets = _strings(list(self.of))
        prefix = prefix_hash(_Bytes(data), EXACT)
        h = mix64(_raw(prefix, offsets[:-1], offsets[1:]))
        order = np.argsort(h)
        self.hash = h[order]
        self.id = np.array([i for i, _ in self.of.values()], dtype=np.int32)[order]
        self.score = np.array([s for _, s in self.of.values()])[order]
        # a blank only begins pieces or fills them; stops part from letters if no piece joins them
        assert not any(b" " in p.lstrip(b" ") for p in self.of)
        self.stops_part = not any(_LETTER[p[j]] and _STOP[p[j + 1]] for p in self.of for j in range(len(p) - 1))
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=U64)
        self.place = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.best = np.zeros(0)
        self.gap = np.zeros(0)
        self.ids = np.zeros(0, dtype=np.int32)
        self.lists: dict[int, list[tuple[float, np.ndarray]]] = {}

    # -- chunks of a block ------------------------------------------------

    def chunks(self, block):
        """(start, end, row, hash, is first) of the block's chunks."""
        data, offsets = block.data, block.offsets
        n = len(data)
        blank = data == 32
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        if self.stops_part and n > 1:
            begin[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
        rows = np.flatnonzero(np.diff(offsets) > 0)
        begin[offsets[rows]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], n)
        row = np.searchsorted(offsets, start, side="right") - 1
        first = np.zeros(len(start), dtype=bool)
        first[np.searchsorted(start, offsets[rows])] = True
        prefix = prefix_hash(block, EXACT)
        raw = _raw(prefix, start, end)
        raw[first] = EXACT[32] + U64(BASE) * raw[first]  # with the leading blank
        return start, end, row, mix64(raw), first

    def look_up(self, block):
        """(entry of each chunk, row of each chunk)."""
        start, end, row, h, first = self.chunks(block)
        order = np.argsort(h)
        s = h[order]
        head = np.concatenate(([True], s[1:] != s[:-1]))
        distinct, at = s[head], order[head]
        if len(self.known) > self.KEEP:
            self._forget()
        where = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = where < len(self.known)
        new[inside] = self.known[where[inside]] != distinct[inside]
        if new.any():
            body = block.data.tobytes()
            a, b, f = start[at[new]].tolist(), end[at[new]].tolist(), first[at[new]].tolist()
            self._learn(distinct[new], [b" " + body[x:y] if z else body[x:y] for x, y, z in zip(a, b, f, strict=True)])
        entry = np.empty(len(h), dtype=np.int64)
        entry[order] = self.place[np.searchsorted(self.known, distinct)][np.cumsum(head) - 1]
        return entry, row

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        order = sorted(range(len(chunks)), key=lambda i: -len(chunks[i]))
        chunks, hashes = [chunks[i] for i in order], hashes[order]
        run = np.cumsum([len(c) for c in chunks]) // self.SOLVE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(chunks)]
        solved = [self.solve(chunks[a:b]) for a, b in zip(cuts, cuts[1:])]
        best, gap, ids, lengths = (np.concatenate(x) for x in zip(*solved, strict=True))
        entry = len(self.lengths) + np.arange(len(chunks))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.best, self.gap = np.concatenate([self.best, best]), np.concatenate([self.gap, gap])
        self.ids = np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, hashes])
        by = np.argsort(known)
        self.known, self.place = known[by], np.concatenate([self.place, entry])[by]

    # -- Viterbi over many chunks at once -----------------------------------

    def edges(self, data: np.ndarray, offsets: np.ndarray):
        """(score, id) arrays by width and start; -inf where there is no piece."""
        n = len(data)
        prefix = prefix_hash(_Bytes(data), EXACT)
        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
        score = np.full((self.widest + 1, n), -np.inf)
        ids = np.full((self.widest + 1, n), -1, dtype=np.int32)
        lead = data & 0xC0 != 0x80
        single = np.zeros(n, dtype=bool)  # characters with a piece of their own
        width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        width = np.minimum(width, left)
        for w in range(1, self.widest + 1):
            p = np.flatnonzero(lead & (left >= w))
            h = mix64(_raw(prefix, p, p + w))
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = self.hash[at] == h
            score[w, p[hit]] = self.score[at[hit]]
            ids[w, p[hit]] = self.id[at[hit]]
            single[p[hit & (width[p] == w)]] = True
        bare = np.flatnonzero(lead & ~single)
        score[width[bare], bare] = self.unknown
        ids[width[bare], bare] = -2  # spelled in bytes
        return score, ids

    def solve(self, chunks: list[bytes]):
        """Best score, distance of the second best, ids and number of ids of each chunk.

        Chunks come longest first, so those still running at a place are a prefix.
        """
        data, offsets = _strings(chunks)
        length = np.diff(offsets)
        m, longest = len(chunks), int(length[0]) if len(chunks) else 0
        score, ids = self.edges(data, offsets)
        node = offsets[:-1] + np.arange(m)  # of place 0 in arrays with one more place a chunk
        forward = np.full(len(data) + m, -np.inf)
        back = np.zeros(len(data) + m, dtype=np.int16)
        forward[node] = 0.0
        running = [int(np.searchsorted(-length, -t, side="right")) for t in range(longest + 1)]
        for t in range(1, longest + 1):
            k = running[t]
            at, byte = node[:k] + t, offsets[:k] + t
            for w in range(min(self.widest, t), 0, -1):  # the longest last piece wins a tie
                value = forward[at - w] + score[w, byte - w]
                better = value > forward[at]
                forward[at[better]] = value[better]
                back[at[better]] = w
        backward = np.full(len(data) + m, -np.inf)
        backward[node + length] = 0.0
        for t in range(longest - 1, -1, -1):
            k = running[t + 1]
            at, byte = node[:k] + t, offsets[:k] + t
            for w in range(1, min(self.widest, longest - t) + 1):
                j = running[t + w]
                value = score[w, byte[:j]] + backward[at[:j] + w]
                np.maximum(backward[at[:j]], value, out=value)
                backward[at[:j]] = value
        # edges on the best paths, last to first
        taken = np.zeros_like(score, dtype=bool)
        place, steps = length.copy(), []
        live = np.flatnonzero(place > 0)
        while len(live):
            w = back[node[live] + place[live]].astype(np.int64)
            place[live] -= w
            byte = offsets[live] + place[live]
            taken[w, byte] = True
            steps.append((live, w, byte))
            live = live[place[live] > 0]
        owner = np.repeat(np.arange(m), length)
        second = np.full(m, -np.inf)
        spot = np.arange(len(data)) + owner
        for w in range(1, self.widest + 1):
            p = np.flatnonzero((score[w] > -np.inf) & ~taken[w])
            np.maximum.at(second, owner[p], forward[spot[p]] + score[w, p] + backward[spot[p] + w])
        best = forward[node + length]
        # ids in order; a character spelled in bytes gives one id a byte
        who = np.concatenate([s[0] for s in steps]) if steps else np.zeros(0, dtype=np.int64)
        width = np.concatenate([s[1] for s in steps]) if steps else who
        byte = np.concatenate([s[2] for s in steps]) if steps else who
        order = np.lexsort((byte, who))
        who, width, byte = who[order], width[order], byte[order]
        of = ids[width, byte]
        count = np.where(of == -2, width, 1)
        flat = np.repeat(of, count)
        spelled = np.flatnonzero(flat == -2)
        if len(spelled):
            source = ragged(byte, count)
            table = np.array([self.byte_id[b] for b in range(256)], dtype=np.int32)
            flat[spelled] = table[data[source[spelled]]]
        return best, best - second, flat, np.bincount(who, weights=count, minlength=m).astype(np.int64)

    # -- N best ---------------------------------------------------------------

    def path_ids(self, path: tuple[bytes, ...]) -> np.ndarray:
        """The ids of a segmentation; a character without a piece gives one id a byte."""
        ids = []
        for piece in path:
            ids += [self.of[piece][0]] if piece in self.of else [self.byte_id[b] for b in piece]
        return np.array(ids, dtype=np.int32)

    def n_best_of_entry(self, entry: int, n: int) -> list[tuple[float, np.ndarray]]:
        """N best (score, ids) of a known chunk (its bytes are those of its pieces), its best ids first."""
        if entry not in self.lists:
            # a copy: a view would hold all ids known so far for as long as the list stays
            ids = self.ids[self.starts[entry]:self.starts[entry] + self.lengths[entry]].copy()
            found = [(s, self.path_ids(p)) for s, p in self.segmentations(self.decode_bytes(ids).tobytes(), n)]
            # of segmentations as good as the best, that of ``ids`` goes first
            others = [x for x in found if not np.array_equal(x[1], ids)]
            self.lists[entry] = [(found[0][0], ids), *others][:n]
        return self.lists[entry]

    def segmentations(self, chunk: bytes, n: int) -> list[tuple[float, tuple[bytes, ...]]]:
        """The n best segmentations: A-star backward, guided by exact forward scores."""
        size = len(chunk)
        into: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        forward = [0.0] + [-float("inf")] * size
        for p in range(size):
            if chunk[p] & 0xC0 == 0x80:
                continue
            w = 1 if chunk[p] < 0x80 else 2 if chunk[p] < 0xE0 else 3 if chunk[p] < 0xF0 else 4
            w = min(w, size - p)
            found = [(e, self.of[piece][1]) for e in range(p + 1, min(size, p + self.widest) + 1)
                     if (piece := chunk[p:e]) in self.of]
            if not any(e == p + w for e, _ in found):
                found.append((p + w, self.unknown))
            for e, s in found:
                into[e].append((p, s))
                forward[e] = max(forward[e], forward[p] + s)
        # of equal estimates the one nearest to the start goes first, else ties would all be opened
        heap = [(-forward[size], size, 0, 0.0, None)]
        count, out = 1, []
        while heap and len(out) < n:
            _, at, _, done, later = heapq.heappop(heap)
            if at == 0:
                cuts = []
                while later is not None:
                    cut, later = later
                    cuts.append(cut)
                out.append((done, tuple(chunk[a:b] for a, b in zip(cuts, [*cuts[1:], size], strict=True))))
                continue
            for p, s in into[at]:
                heapq.heappush(heap, (-(forward[p] + s + done), p, count, s + done, (p, later)))
                count += 1
        return out

    def text_segmentations(self, entries: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, np.ndarray]]]]:
        """N best segmentations of a text from its chunks: (score, [(chunk, its ids)] where they are not the best's)."""
        total = float(self.best[entries].sum())
        gaps = self.gap[entries]
        if n == 1 or not len(entries):
            return [(total, [])]
        some = np.sort(np.argpartition(gaps, n - 2)[:n - 1]) if len(entries) > n - 1 else np.arange(len(entries))
        some = [int(i) for i in some if np.isfinite(gaps[i])]
        lists = [self.n_best_of_entry(int(entries[i]), n) for i in some]
        sums = [(0.0, ())]
        for found in lists:  # losses against the best; at most n are kept after each chunk
            sums = heapq.nsmallest(n, ((a + found[0][0] - s, (*taken, k)) for a, taken in sums for k, (s, _) in enumerate(found)))
        return [(total - x, [(i, found[k][1]) for i, found, k in zip(some, lists, taken, strict=True) if k])
                for x, taken in sums]

    # -- decoding -----------------------------------------------------------------

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of the pieces, blanks for meta spaces, the leading one included."""
        start = self.piece_offsets[ids]
        return self.piece_bytes[ragged(start, self.piece_offsets[ids + 1] - start)]


class _Bytes:
    """Just enough of a block for the hash kernel."""

    def __init__(self, data: np.ndarray):
        self.data = data


@lru_cache(maxsize=2)
def lattice(path: str, n_best: int) -> Lattice:
    return Lattice(path, n_best)


def encode(docs: DataFrame, path: str | None = None, n_best: int = N_BEST, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_pieces, scores, ids_crc32, decodes, nbest_pieces, nbest_crc32[, ids, nbest_ids])`` of every row.

    ``scores``, ``nbest_pieces``, ``nbest_crc32``, ``nbest_ids``: the N best
    segmentations' scores, numbers of ids, digests of their ids and ids, best
    first; ``n_pieces``, ``ids_crc32``, ``ids``: the best one's; ``decodes``: the
    ids of every segmentation give the text back.
    """
    path = path or vocabulary()
    fields = "n_pieces: bigint, scores: array<double>, ids_crc32: bigint, decodes: boolean, " \
             "nbest_pieces: array<bigint>, nbest_crc32: array<bigint>"
    fields += ", ids: array<int>, nbest_ids: array<array<int>>" if with_ids else ""

    @F.arrow_udf(f"struct<{fields}>")
    def encoded(column: pa.Array) -> pa.Array:
        model = lattice(path, n_best)
        scores, lengths, crc, good, all_ids = [], [], [], [], []
        for b in blocks(column):
            if len(b.data):
                entry, row = model.look_up(b)
            else:
                entry, row = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            n = model.lengths[entry] if len(entry) else entry
            ids = model.ids[ragged(model.starts[entry], n)] if len(entry) else np.zeros(0, dtype=np.int32)
            piece = np.concatenate(([0], np.cumsum(n)))  # place of every chunk's ids
            chunk_ends = np.cumsum(np.bincount(row, minlength=b.rows))
            plain = _plain(b)
            for r in range(b.rows):
                first, last = int(chunk_ends[r - 1]) if r else 0, int(chunk_ends[r])
                text, whole = plain(r), True
                found = model.text_segmentations(entry[first:last], n_best)
                scores.append([s for s, _ in found])
                lengths.append([])
                crc.append([])
                for _, changes in found:
                    one = _changed(ids, piece, first, last, changes)
                    lengths[-1].append(len(one))
                    crc[-1].append(zlib.crc32(one.astype("<u4", copy=False).tobytes()))
                    whole &= np.array_equal(model.decode_bytes(one)[1:], text)  # without the leading blank
                    if with_ids:
                        all_ids.append(one)
                good.append(bool(whole))
        columns = [pa.array([x[0] for x in lengths], type=pa.int64()), pa.array(scores, type=pa.list_(pa.float64())),
                   pa.array([x[0] for x in crc], type=pa.int64()), pa.array(good, type=pa.bool_()),
                   pa.array(lengths, type=pa.list_(pa.int64())), pa.array(crc, type=pa.list_(pa.int64()))]
        names = ["n_pieces", "scores", "ids_crc32", "decodes", "nbest_pieces", "nbest_crc32"]
        if with_ids:
            of_row = np.concatenate(([0], np.cumsum([len(x) for x in lengths]))).astype(np.int64)
            columns += [_id_lists([all_ids[i] for i in of_row[:-1]]),
                        pa.ListArray.from_arrays(pa.array(of_row, type=pa.int32()), _id_lists(all_ids))]
            names += ["ids", "nbest_ids"]
        return pa.StructArray.from_arrays(columns, names=names)

    slim = texts(docs, id_col, text_col)
    slim = slim.withColumn("text", F.replace("text", F.lit(_META), F.lit(" ")))
    return slim.select("doc_id", encoded("text").alias("e")).select("doc_id", "e.*")


def _changed(ids: np.ndarray, piece: np.ndarray, first: int, last: int, changes) -> np.ndarray:
    """The ids of the chunks from ``first`` to ``last``, those of some chunks replaced."""
    if not changes:
        return ids[piece[first]:piece[last]]
    parts, at = [], piece[first]
    for i, put in changes:
        parts += [ids[at:piece[first + i]], put]
        at = piece[first + i + 1]
    return np.concatenate([*parts, ids[at:piece[last]]])


def _id_lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([len(x) for x in lists]) if lists else np.zeros(0, dtype=np.int64)
    flat = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), type=pa.int32()), pa.array(flat, type=pa.int32()))


def _plain(block):
    return lambda r: block.data[block.offsets[r]:block.offsets[r + 1]]
