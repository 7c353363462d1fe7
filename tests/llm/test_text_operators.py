"""Text operators against brute force, on awkward rows and empty tables."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import jaccard, packing, passages, pieces, pii, quality, secrets, toxicity
from quire.session import ensure_checkpoint_dir
from tests.llm import edge

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def _checkpoints(spark):
    ensure_checkpoint_dir(spark)


def _key(rows):
    return sorted(rows, key=repr)


# -- op2 ---------------------------------------------------------------------

def test_jaccard_components(spark, tmp_dir):
    got = jaccard.link(edge.stored_documents(spark, tmp_dir + "/d")).select("doc_id", "n_shingles", "component_id")
    assert _key(tuple(r) for r in got.collect()) == _key(edge.jaccard_components(edge.ROWS, 4, 85))


def test_jaccard_chains_and_merging_turns(spark, tmp_dir, monkeypatch):
    """Near copies around the threshold: no link is lost, also when turns of merging come first."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(60)] = f"z{rnd.randrange(1000)}"
        rows.append((i, " ".join(w), None, None, None))
    want = _key(edge.jaccard_components(rows, 4, 85))
    docs = edge.stored_documents(spark, tmp_dir + "/d", rows)
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(jaccard, "HEAVY_LEAST", 8)
    got = jaccard.link(docs).select("doc_id", "n_shingles", "component_id")
    assert _key(tuple(r) for r in got.collect()) == want


def test_jaccard_keep_one(spark, tmp_dir):
    docs = edge.stored_documents(spark, tmp_dir + "/d")
    got = jaccard.keep_one(docs, 4, 85)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    kept = {}
    for i, n, c in edge.jaccard_components(edge.ROWS, 4, 85):
        kept.setdefault(("row", len(kept)) if not n else c, i)
    assert len(ids) == len(kept) and {1, 4, 5, 6, 7, 10, 13} <= set(ids) and not {2, 3, 9} & set(ids)


def test_tree_links_equal_plain_overlap():
    rnd = random.Random(3)
    for _ in range(30):
        probe = np.array(sorted(rnd.sample(range(300), 60)), dtype=np.uint64)
        sets = []
        for _ in range(20):
            s = set(probe.tolist())
            for _ in range(rnd.randrange(8)):
                s.discard(rnd.choice(sorted(s)))
                s.add(rnd.randrange(300))
            sets.append(sorted(s))
        bodies = [np.array(s, dtype=">u8").tobytes() for s in sets]
        want = [i for i, s in enumerate(sets) if 100 * len(set(s) & set(probe.tolist())) >= 85 * len(set(s) | set(probe.tolist()))]
        assert sorted(jaccard.tree_links(probe, bodies, 85)) == want


# -- op7 ---------------------------------------------------------------------

def _dedup_check(spark, path, rows, **options):
    size = options.pop("size", 200)
    docs = edge.stored_documents(spark, path, rows)
    got = passages.digest(passages.without_repeats(docs, size, **options)).collect()
    want = []
    for (i, *_), (b, covered) in zip(rows, edge.repeated_bytes([r[1] for r in rows], size), strict=True):
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        want.append((i, len(b), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest()))
    assert _key(tuple(r) for r in got) == _key(want)


def test_repeated_passages(spark, tmp_dir):
    _dedup_check(spark, tmp_dir + "/d", [r for r in edge.ROWS if r[0] != 10])


def test_repeated_passages_with_many_contexts_of_one_minimiser(spark, tmp_dir):
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        a, b = ("".join(rnd.choice("abcd") for _ in range(rnd.randrange(40))) for _ in range(2))
        rows.append((i, a + "a common middle part" + b + ("ab" * rnd.randrange(30)), None, None, None))
    _dedup_check(spark, tmp_dir + "/d", rows, size=24, anchor=10, hot=3, index_bytes=500)


def test_matching_statistics():
    rnd = random.Random(1)
    for _ in range(25):
        s = bytes(rnd.randrange(rnd.choice((1, 2, 4))) + 97 for _ in range(rnd.randint(2, 150)))
        s += s[:rnd.randint(0, 80)]
        depth = rnd.choice((3, 8, 20, 50))
        got = passages.RunLengthIndex(np.frombuffer(s, dtype=np.uint8).astype(np.uint16) + 1, depth).matching_statistics()
        for i in range(len(s)):
            best = 0
            for j in range(len(s)):
                n = 0
                while i != j and n < depth and max(i, j) + n < len(s) and s[i + n] == s[j + n]:
                    n += 1
                best = max(best, n)
            assert got[i] == best


# -- op4 ---------------------------------------------------------------------

def test_packing_round_trip(spark, tmp_dir):
    from tokenizers import Tokenizer
    got = packing.pack(edge.documents(spark), with_ids=True).collect()
    tok = Tokenizer.from_file(packing.vocabulary())
    want = []
    for i, text, *_ in edge.ROWS:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            p = ids[s:s + 4096]
            want.append((i, k, s, len(p), zlib.crc32(np.array(p, dtype="<u4").tobytes()), p))
    assert _key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == _key(want)
    _gapless(got, 4096)


def _gapless(rows, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert at[r.sequence_id] <= capacity
    return at


def test_words_are_encoded_as_whole_texts():
    from tokenizers import Tokenizer
    import pyarrow as pa
    from quire.llm.kernels import blocks
    texts = ["Don't, stop.Go <|endoftext|>x <|ENDOFTEXT|> été. ÉTÉ, it's we'LL ... a.b,c .5 1,000.00",
             "İI ΣΣ σς ẞ ﬁ   x y z　w ́start", "tab\tnl\nvt\x0bff\x0ccr\rend", "", "A,B.C,.d"]
    enc = packing.WordIds(packing.vocabulary())
    tok = Tokenizer.from_file(packing.vocabulary())
    for b in blocks(pa.array(texts)):
        ids, count = enc.encode(b)
        at = 0
        for t, n in zip(texts, count, strict=True):
            assert ids[at:at + n].tolist() == tok.encode(t, add_special_tokens=False).ids, t
            at += n


def test_fullest_is_optimal():
    rnd = random.Random(2)
    for _ in range(200):
        items = sorted({rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(4)}.items(), reverse=True)
        room = rnd.randint(1, 60)
        best = {0}
        for x, c in items:
            best |= {s + x * k for s in best for k in range(c + 1) if s + x * k <= room}
        used = packing.fullest(items, room)
        assert sum(x * k for x, k in used.items()) == max(best) and all(k <= dict(items)[x] for x, k in used.items())


# -- op5 ---------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base_secrets(t):
    t = t or ""
    s = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(s))


def test_secret_spans(spark):
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = "".join(rnd.choice(letters) for _ in range(40))
    prose = "this is an ordinary sentence with understandable and straightforwardly written identifiers "
    rows = [*edge.ROWS, (20, "é API_KEY=" + "a" * 30 + " apikey : 'abc' Secret\":\"deadbeef\" tokenization=abcdef", None, None, None),
            (21, "漢 " + prose * 40 + key + " " + prose, None, None, None),
            (22, "AKIAKIA AKIA" + "A" * 20 + " " + "0123456789abcdef" * 3 + "g", None, None, None)]
    got = {(r.doc_id, r.base_sha256): r for r in secrets.digest(secrets.scan(edge.documents(spark, rows))).collect()}
    for i, t, *_ in rows:
        assert (i, hashlib.sha256(_base_secrets(t).encode()).hexdigest()) in got
    at = rows[-2][1].index(key)
    assert [r.spans for r in got.values() if r.doc_id == 21] == [f"markov:{at}:{at + 40}"]


# -- op9 ---------------------------------------------------------------------

def _luhn(s):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(s))) % 10 == 0


def _base_pii(t):
    t = t or ""

    def digits(s):
        return re.sub("[^0-9]", "", s)

    r = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    r += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
          if all(int(x) <= 255 for x in m[0].split("."))]
    r += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
          if 16 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0]))]
    r += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
    return sorted(r)


PII_TEXTS = [
    "é漢 a@b.c_x@d.e f@g.h, x.y%z+1@mail-1.co.uk. @no a@b a@.b a@b..c q@r.s.t@u.v", "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.1000 0001.2.3.04 9.9.9",
    "4111-1111 1111 1111 4111 1111 1111 1112 4111--1111111111111 1 41111111111111111 5500 0000 0000 0004-7",
    "+1 (988) 555-2485 +12 +1234567 +12345678 +1+12345678 ++49 30 901820 (x) +33 1 23 45 67 89.", "9" * 4000 + " " + "1 " * 3000, "a.b-" * 3000 + "@x.y",
    "a@" + "b." * 4000 + "c", "call 555 123 4567 now", "write to jo (at) mail.example.com",
]


def test_personal_data_spans(spark):
    rows = [*edge.ROWS, *[(100 + i, t, None, None, None) for i, t in enumerate(PII_TEXTS)]]
    got = pii.digest(pii.detect(edge.documents(spark, rows))).collect()
    assert len(got) == len(rows)
    have = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got}
    for i, t, *_ in rows:
        b = _base_pii(t)
        text = ",".join(f"{pii.KINDS[k]}:{x}:{y}" for k, x, y in b)
        assert (i, *[sum(s[0] == k for s in b) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()) in have, (t or "")[:80]


def test_personal_data_is_replaced(spark):
    docs = edge.documents(spark, [*edge.ROWS, (50, PII_TEXTS[3], None, None, None)])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[None] == "a row without an id mail me at [EMAIL] or [PHONE]" and text[4] is None and text[1] == edge.ROWS[0][1]
    assert "[CARD]" in text[14] and "host [IP] not 10.0.0.256" in text[14]
    assert text[50].startswith("[PHONE] +12 +1234567 [PHONE] ")


def test_unreliable_labeler_is_found():
    votes = {(1, 1, 1, 0): 80, (-1, -1, -1, 1): 40, (-1, -1, -1, -1): 40, (1, 1, 1, 1): 10, (1, 1, -1, -1): 5}
    p = pii.posteriors(votes)
    assert p[(1, 1, 1, 0)] > 0.9 and p[(-1, -1, -1, 1)] < 0.1


# -- op8 ---------------------------------------------------------------------

def test_n_best_segmentations_of_words():
    m = pieces.Lattice(pieces.vocabulary(), 4)

    def brute(c):
        out = []

        def go(p, s):
            if p == len(c):
                out.append(s)
                return
            w = 1 if c[p] < 0x80 else 2 if c[p] < 0xE0 else 3 if c[p] < 0xF0 else 4
            own = False
            for e in range(p + 1, min(len(c), p + m.widest) + 1):
                if c[p:e] in m.of:
                    own |= e == p + w
                    go(e, s + m.of[c[p:e]][1])
            if not own:
                go(p + w, s + m.unknown)

        go(0, 0.0)
        return sorted(out, reverse=True)

    chunks = sorted((x.encode() for x in (" hello", " the", "  two", " 漢字é", " onblewh,", "a", " ", "....", "☃x", "\n\t", "😀b")), key=lambda x: -len(x))
    best, gap, ids, count = m.solve(chunks)
    at = 0
    for c, b, g, k in zip(chunks, best, gap, count, strict=True):
        want = brute(c)
        assert b == want[0] and [s for s, _ in m.segmentations(c, 4)] == want[:4]
        assert len(want) == 1 or b - g == want[1]
        assert all(b"".join(path) == c for _, path in m.segmentations(c, 4))
        assert m.decode_bytes(ids[at:at + k]).tobytes() == c
        at += k


def test_n_best_of_texts(spark):
    import sentencepiece
    texts = [(1, "the cat.", None, None, None), (2, "to be", None, None, None), (3, "▁x y", None, None, None)]
    got = {r.doc_id: r for r in pieces.encode(edge.documents(spark, texts), with_ids=True).collect()}
    m = pieces.Lattice(pieces.vocabulary(), 4)
    for i, t, *_ in texts[:2]:
        # the chunk lattice cut nowhere: one search over the whole text
        whole = [s for s, _ in m.segmentations((" " + t).encode(), 4)]
        assert got[i].scores == whole
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary())
    assert sp.decode(list(got[1].ids)) == "the cat." and all(r.decodes for r in got.values())


def test_lists_of_chunks_hold_their_own_ids_only_and_runs_do_not_change_results():
    """N-best lists that are views would hold the ids of all chunks known when they were made."""
    chunks = sorted({b" " + w.encode() for w in "to be or not that is the question whether 'tis nobler \u6f22\u5b57".split()})
    hashes = np.arange(len(chunks), dtype=np.uint64)
    whole, parted = pieces.Lattice(pieces.vocabulary(), 4), pieces.Lattice(pieces.vocabulary(), 4)
    parted.SOLVE_BYTES = 8
    for m in (whole, parted):
        m._learn(hashes, chunks)
    for i in range(len(chunks)):
        a, b = (m.n_best_of_entry(int(m.place[i]), 4) for m in (whole, parted))
        assert [(s, x.tolist()) for s, x in a] == [(s, x.tolist()) for s, x in b]
        assert whole.best[whole.place[i]] == parted.best[parted.place[i]] and whole.gap[whole.place[i]] == parted.gap[parted.place[i]]
        assert all(x.base is None or x.base.nbytes <= x.nbytes for _, x in a)


def test_pieces_of_awkward_rows(spark):
    got = pieces.encode(edge.documents(spark)).collect()
    assert len(got) == len(edge.ROWS) and all(r.decodes for r in got)
    empty = [r for r in got if r.doc_id in (4, 5)]
    assert all(r.n_pieces == 0 and r.scores == [0.0] for r in empty)


def test_every_n_best_segmentation_is_written_out(spark):
    """F1: not the scores alone: N different id sequences, each of its score, each giving the text back."""
    import sentencepiece
    texts = [(1, "the cat sat, on the onblewh mat", None, None, None), (2, "aaaa aaaa", None, None, None),
             (3, "漢字☃ é😀", None, None, None), (4, None, None, None, None)]
    got = {r.doc_id: r for r in pieces.encode(edge.documents(spark, texts), with_ids=True).collect()}
    m = pieces.Lattice(pieces.vocabulary(), 4)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary())
    score = {i: s for i, s in m.of.values()}
    for i, t, *_ in texts[:2]:
        found = [tuple(x) for x in got[i].nbest_ids]
        assert len(found) == 4 == len(set(found)) and list(found[0]) == got[i].ids
        assert [sum(score[k] for k in ids) for ids in found] == got[i].scores
        assert [s for s, _ in m.segmentations((" " + t).encode(), 4)] == got[i].scores
        assert all(sp.decode(list(ids)) == t for ids in found)
    for r in got.values():
        assert r.decodes and len(r.nbest_ids) == len(r.scores)
        assert r.nbest_pieces == [len(x) for x in r.nbest_ids] and r.nbest_pieces[0] == r.n_pieces
        assert r.nbest_crc32 == [zlib.crc32(b"".join(k.to_bytes(4, "little") for k in x)) for x in r.nbest_ids]
        assert r.nbest_crc32[0] == r.ids_crc32
    assert got[4].nbest_ids == [[]] and len(got[3].nbest_ids) > 1


# -- op3, op6 ------------------------------------------------------------------

@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels)
    assert got.count() == docs.count()
    # junk rows of this table are labelled toxic at random, without a toxic word in them
    rows = got.join(labels, "doc_id").where("held_out and quality = 1").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    for r in got.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_quality_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.resample(docs, labels).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_models_without_labels(spark):
    docs = edge.documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")
    for labels in (none, one):
        assert all(r.score == 0.0 and r.predicted == 0 for r in toxicity.toxicity(docs, labels).collect())
        kept = quality.resample(docs, labels).collect()
        assert len(kept) == len(edge.ROWS) and all(r.kept for r in kept)
        assert quality.keep_good(docs, labels).count() == len(edge.ROWS)


def test_kth_largest(spark):
    keys = spark.range(0, 5000).select((F.hash("id") % 1000).cast("double").alias("key")).cache()
    want = sorted((r.key for r in keys.collect()), reverse=True)
    for k in (1, 17, 2500, 5000):
        assert quality.kth_largest(keys, k, rest=64) == want[k - 1]


def test_empty_tables(spark, tmp_dir):
    docs = edge.stored_documents(spark, tmp_dir + "/d", [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for out in (jaccard.link(docs), jaccard.keep_one(docs, 5, 80), passages.without_repeats(docs), passages.strip(docs),
                packing.pack(docs), secrets.scan(docs), pii.detect(docs), pii.redact(docs), pieces.encode(docs),
                toxicity.toxicity(docs, labels), quality.resample(docs, labels)):
        assert out.count() == 0
