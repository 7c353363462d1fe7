"""Toxicity scores (operator 3): boosted trees over dense features, calibrated.

A lexicon is learned from labelled rows: whole words and word beginnings that
occur in toxic texts far more often than in others.  Each text becomes a short
vector of densities (lexicon words and beginnings, their closeness to words of
the second person, capitals, punctuation, obfuscated words).  Gradient-boosted
trees (MLlib) score the vector, and isotonic regression on rows that the trees
did not see turns the score into a probability.

Labels are learned only from rows whose ``crc32(doc_id as text) mod 5`` is not
0: remainders 1 and 2 give the lexicon, 3 and 1 the trees, 4 the calibration.
The fit uses at most ``FIT_ROWS`` labelled rows of each class, those of the
smallest id hash: the stated bound of the training sample.  Features and scores
cover all rows and whole texts; labels, language, source and id are no inputs.

Scale: one scan of the text for the scores and one, filtered by a broadcast of
the bounded sample, for the fit.  No text is shuffled; lexicon counts are summed
by hash with one partial sum per task.

Defined results: null or empty text has zero features and is scored like any
other; repeated rows get equal scores; without labels of both classes in a fold
the step that needs them is left out, and with no usable labels every score is
the share of toxic labels seen (0 if none); an empty table gives an empty result;
a null id counts as not held out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import narrow, stored, texts
from quire.llm.kernels import FOLDED, U64, blocks, mix64, prefix_hash, row_sums, span_hash, words

FIT_ROWS = 6_000
LEXICON_SIZE = 4_096
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning
NEAR = 6  # words between a lexicon word and the second person
TREES, DEPTH, STEP = 20, 3, 0.25

#: Words of the second person (English, German, French, Spanish).
SECOND_PERSON = ("you your yours yourself du dich dir dein deine ihr euch tu toi te ton ta tes "
                 "vous votre vos usted ustedes ti tus vosotros").split()

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DISGUISE = np.zeros(256, dtype=bool)
_DISGUISE[[ord(c) for c in "0123456789@$*#_-+|"]] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _tokens(block):
    """Letter runs: (spans, hashes by family); family 0 is the whole word."""
    w = words(block, ~_LETTER)
    prefix = prefix_hash(block, FOLDED)
    size = w.end - w.start
    families = [span_hash(prefix, w.start, w.end)]
    for k in BEGINNINGS:
        h = span_hash(prefix, w.start, np.minimum(w.start + k, w.end))
        families.append(np.where(size > k, mix64(h + U64(k)), U64(0)))
    return w, families


def _presence(batches):
    """Of each token family hash: in how many toxic and other texts it occurs."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False) == 1
        for b in blocks(batch.column(0)):
            w, families = _tokens(b)
            h = np.concatenate(families)
            row = np.tile(w.row, len(families))
            keep = h != 0
            h, row = h[keep], row[keep]
            if not len(h):
                continue
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            once = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
            h, bad = h[once], toxic[b.first + row[once]]
            head = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            n1 = np.add.reduceat(bad.astype(np.int64), head)
            n = np.diff(np.append(head, len(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[head].view(np.int64)), pa.array(n1), pa.array(n - n1)], names=["h", "bad", "fine"])


def learn_lexicon(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, log-odds weights) from ``(text, label)``; at most LEXICON_SIZE."""
    totals = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, dtype=U64), np.zeros(0)
    odds = F.log((F.col("bad") + 0.5) / (n1 + 1.0)) - F.log((F.col("fine") + 0.5) / (n0 + 1.0))
    least = max(2, math.ceil(0.004 * n1))
    best = train.mapInArrow(_presence, "h bigint, bad bigint, fine bigint") \
        .groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")) \
        .where(F.col("bad") >= least).select("h", "bad", odds.alias("odds")).where("odds >= 2.3") \
        .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "h").limit(LEXICON_SIZE).collect()
    h = np.array([r["h"] for r in best], dtype=np.int64).view(U64)
    weight = np.array([r["odds"] for r in best], dtype=np.float64)
    order = np.argsort(h)
    return h[order], weight[order]


def _word_hash(text: str) -> int:
    column = pa.array([text])
    return int(next(_tokens(b)[1][0][0] for b in blocks(column)))


def _found(table: np.ndarray, weight: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Weight of each hash, 0 where it is not in the table."""
    if not len(table):
        return np.zeros(len(h))
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, weight[at], 0.0)


def features(lexicon: tuple[np.ndarray, np.ndarray]):
    """Column function: the dense feature vector of a text, as an array."""
    table, weight = lexicon
    person = np.sort(np.array([_word_hash(x) for x in SECOND_PERSON], dtype=U64))

    @F.arrow_udf("array<double>")
    def vector(column: pa.Array) -> pa.Array:
        rows = [_block_vector(b, table, weight, person) for b in blocks(column)]
        x = np.concatenate(rows) if rows else np.zeros((0, 1))
        return pa.ListArray.from_arrays(
            np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))

    return vector


def _block_vector(b, table, weight, person) -> np.ndarray:
    w, families = _tokens(b)
    n = np.bincount(w.row, minlength=b.rows).astype(np.float64)
    per_word = 1.0 / np.maximum(n, 1)
    whole = _found(table, weight, families[0])
    begin = np.max([_found(table, weight, f) for f in families[1:]], axis=0) if len(w.row) else whole
    hit = (whole > 0) | (begin > 0)
    you = _found(person, np.ones(len(person)), families[0]) > 0
    near = _near(hit, you, w.row)
    row_of_byte = np.repeat(np.arange(b.rows), np.diff(b.offsets))
    size = np.maximum(np.diff(b.offsets), 1)

    def rate(mask):
        return np.bincount(row_of_byte[mask], minlength=b.rows) / size

    inner = np.zeros(len(b.data), dtype=bool)
    if len(b.data) > 2:
        letter = _LETTER[b.data]
        inner[1:-1] = _DISGUISE[b.data[1:-1]] & letter[:-2] & letter[2:]
    upper = _UPPER[b.data]
    caps = np.concatenate(([0], np.cumsum(upper)))
    shout = (caps[w.end] - caps[w.start] == w.end - w.start) & (w.end - w.start > 1)
    strongest = np.zeros(b.rows)
    if len(w.row):
        np.maximum.at(strongest, w.row[hit], np.maximum(whole, begin)[hit])
    hits = row_sums(hit.astype(np.float64), w.row, b.rows)
    return np.stack([
        row_sums((whole > 0).astype(np.float64), w.row, b.rows) * per_word,
        row_sums((begin > 0).astype(np.float64), w.row, b.rows) * per_word,
        row_sums(np.maximum(whole, begin), w.row, b.rows) * per_word,
        np.log1p(hits),
        np.log1p(row_sums((whole > 0).astype(np.float64), w.row, b.rows)),
        strongest,
        row_sums(near.astype(np.float64), w.row, b.rows) * per_word,
        row_sums(you.astype(np.float64), w.row, b.rows) * per_word,
        rate(upper), row_sums(shout.astype(np.float64), w.row, b.rows) * per_word,
        rate(b.data == ord("!")), rate(b.data == ord("?")), rate(_PUNCT[b.data]),
        row_sums(np.ones(int(inner.sum())), row_of_byte[inner], b.rows) * per_word,
        np.log1p(n),
    ], axis=1)


def _near(hit: np.ndarray, you: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hits with a word of the second person at most NEAR words away, in the same row."""
    out = np.zeros(len(hit), dtype=bool)
    at, who = np.flatnonzero(hit), np.flatnonzero(you)
    if len(at) and len(who):
        right = np.minimum(np.searchsorted(who, at), len(who) - 1)
        for i in (right, np.maximum(right - 1, 0)):
            near = (np.abs(who[i] - at) <= NEAR) & (row[who[i]] == row[at])
            out[at[near]] = True
    return out


def fold(doc_id):
    """Column: crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_sample(labels: DataFrame, label: str, id_col: str = "doc_id", rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, label)`` outside the held-out fold: at most ``rows`` of each class."""
    lab = narrow(labels, doc_id=id_col, label=label).where("doc_id is not null and label in (0, 1)")
    lab = lab.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).where(fold(F.col("doc_id")) != 0)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return lab.where("label = 1").orderBy(*order).limit(rows) \
        .unionByName(lab.where("label = 0").orderBy(*order).limit(rows))


class Model:
    """Lexicon, trees and calibration; any part is None where the labels allow none."""

    def __init__(self, lexicon, trees, isotonic, share):
        self.lexicon, self.trees, self.isotonic, self.share = lexicon, trees, isotonic, share

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with a column ``score``; every other column stays."""
        if self.trees is None:
            return docs.withColumn("score", F.lit(float(self.share)))
        text = F.coalesce(F.col("text"), F.lit(""))
        x = docs.withColumn("_tox_x", array_to_vector(features(self.lexicon)(text)))
        x = self.trees.transform(x).withColumn("_tox_raw", vector_to_array("_tox_raw2")[1])
        if self.isotonic is None:
            x = x.withColumn("score", vector_to_array("_tox_p")[1])
        else:
            x = self.isotonic.transform(x).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_tox_iso")))
        return x.select(*[F.col(f"`{c}`") for c in docs.columns], "score")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` (doc_id, text) and their labels ``toxic``."""
    sample = training_sample(labels, "toxic")
    train = stored(docs.join(F.broadcast(sample), "doc_id")
                   .select("text", "label", fold(F.col("doc_id")).alias("fold")))
    # a doc_id may repeat in docs; equal rows weigh more, the bound is on ids
    lexicon = learn_lexicon(train.where("fold in (1, 2)").select("text", "label"))
    rows = stored(train.select("label", "fold", array_to_vector(features(lexicon)("text")).alias("_tox_x"))
                  .repartition(max(2, min(8, docs.sparkSession.sparkContext.defaultParallelism))))
    classes = {(r["fold"], r["label"]): r["n"] for r in
               rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def both(*folds):
        return all(sum(classes.get((f, y), 0) for f in folds) for y in (0, 1))

    seen = sum(classes.values())
    share = sum(n for (_, y), n in classes.items() if y == 1) / seen if seen else 0.0
    if not both(3, 1):
        return Model(lexicon, None, None, share)
    gbt = GBTClassifier(featuresCol="_tox_x", labelCol="label", maxIter=TREES, maxDepth=DEPTH,
                        stepSize=STEP, seed=7, maxBins=64, minInstancesPerNode=2)
    trees = gbt.fit(rows.where("fold in (3, 1)").withColumn("label", F.col("label").cast("double")))
    trees = trees.setRawPredictionCol("_tox_raw2").setProbabilityCol("_tox_p").setPredictionCol("_tox_y")
    isotonic = None
    if both(4):
        scored = trees.transform(rows.where("fold = 4")).select(
            vector_to_array("_tox_raw2")[1].alias("_tox_raw"), F.col("label").cast("double").alias("label"))
        isotonic = IsotonicRegression(featuresCol="_tox_raw", labelCol="label", predictionCol="_tox_iso").fit(scored)
    return Model(lexicon, trees, isotonic, share)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``."""
    slim = texts(docs, id_col, text_col)
    return fit(slim, labels).score(slim).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
