"""Quality classifier by importance resampling (operator 6).

Two hashed n-gram generative models are estimated: ``raw`` from every text of
the corpus and ``target`` from the texts labelled good.  A document's log
importance weight is the sum over its n-grams of ``log p_target - log p_raw``.
Documents are drawn without replacement in proportion to that weight by Gumbel
top-k: the k largest values of ``log weight + Gumbel noise`` stay, the others
are rejected.  k is the number of documents whose weight reaches the cut that
separates the labelled rows best (a good row lost counts ``GOOD_COST`` times).

n-grams: words and pairs of words, hashed into ``BUCKETS`` buckets.  A pair of
the same word twice is one n-gram of its own ("the word again"), whichever word.

Scale: the counts are one partial histogram per task, summed by bucket, so the
shuffle has at most BUCKETS rows a task and the model is of fixed size.  Both
text passes are plain scans; no text is shuffled.  Labels: at most
``LABEL_ROWS`` labelled rows (those of the smallest id hash) are used, the
stated bound of the fit; the raw model and the draw cover all rows.

Defined results: null or empty text has no n-grams and weight 0; repeated rows
get equal keys and stay or go together (so k can be exceeded by ties); with no
labels, or none of one class, every document stays; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import narrow, stored, texts
from quire.llm.kernels import EXACT, U64, blocks, frugal, gram_hashes, row_sums, word_hashes

BUCKETS = 1 << 14
LABEL_ROWS = 20_000
GOOD_COST = 4
SEED = 20_260
_AGAIN = 7  # the bucket of "the same word again"


def block_features(block) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of a block."""
    w, h = word_hashes(block, EXACT)
    pairs, pair_row = gram_hashes(h, w.row, 2)
    if len(h) > 1:
        whole = w.row[:-1] == w.row[1:]
        same = (h[:-1] == h[1:])[whole]
        pairs[same] = _AGAIN
    mask = U64(BUCKETS - 1)
    return (np.concatenate([h & mask, pairs & mask]).astype(np.int64),
            np.concatenate([w.row, pair_row]))


def _histograms(batches):
    raw = np.zeros(BUCKETS, dtype=np.int64)
    target = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        good = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1
        for b in blocks(batch.column(0)):
            bucket, row = block_features(b)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[b.first + row]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
        names=["bucket", "raw", "target"])


def labelled_sample(labels: DataFrame, label: str, id_col: str = "doc_id",
                    rows: int = LABEL_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids ``(doc_id, label)``: those of the smallest hash.

    Rows with a null id or label are no labels; an id labelled twice counts once,
    with its smallest label.
    """
    lab = narrow(labels, doc_id=id_col, label=label).where("doc_id is not null and label is not null")
    lab = lab.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    return lab.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(rows)


class Model:
    """The n-gram table (fixed size), the cut, and the threshold of the draw."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.cut = -np.inf
        self.threshold: tuple[float, int] | None = None

    def log_ratio(self, text):
        """Column: log importance weight of a text."""
        weights = self.weights

        @F.arrow_udf("double")
        def log_ratio(column: pa.Array) -> pa.Array:
            out = np.zeros(len(column))
            for b in blocks(column):
                bucket, row = block_features(b)
                out[b.first:b.first + b.rows] = row_sums(weights[bucket], row, b.rows)
            return pa.array(out)

        return log_ratio(text)


def gumbel(doc_id):
    """Column: standard Gumbel noise, a function of the id alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1), doc_id), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def kth_largest(keys: DataFrame, k: int, rest: int = 4096) -> float:
    """The k-th largest of column ``key``, by narrowing histograms.

    Each round counts the rows of 1,024 equal ranges; only counts, and at last
    at most ``rest`` keys, reach the driver.
    """
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    while True:
        inside = keys.where((F.col("key") >= lo) & (F.col("key") <= hi))
        step = (hi - lo) / 1024
        if step <= 0 or lo + step == lo:
            return lo
        part = F.least(F.floor((F.col("key") - lo) / step), F.lit(1023)).cast("int").alias("part")
        ranges = inside.select(part, "key").groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for r in sorted(ranges.collect(), key=lambda r: -r["part"]):
            if r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                if r["n"] <= rest:
                    top = keys.where((F.col("key") >= lo) & (F.col("key") <= hi)) \
                        .orderBy(F.desc("key")).limit(k).collect()
                    return top[-1]["key"]
                break
            k -= r["n"]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Both generative models, the cut and the Gumbel threshold over all of ``docs``."""
    sample = stored(labelled_sample(labels, "quality"))
    counts = docs.join(F.broadcast(sample), "doc_id", "left") \
        .select("text", "label") \
        .mapInArrow(frugal(_histograms), "bucket int, raw bigint, target bigint") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return Model(np.zeros(BUCKETS))
    model = Model(np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS)))
    scored = stored(docs.select("doc_id", model.log_ratio("text").alias("log_ratio"))
                    .join(F.broadcast(sample), "doc_id", "left")
                    .select("log_ratio", "label", (F.col("log_ratio") + gumbel("doc_id")).alias("key")))
    # a doc_id may repeat in docs: still no more rows than the bounded sample's
    seen = scored.where("label is not null").orderBy("log_ratio").limit(LABEL_ROWS).collect()
    model.cut = best_cut([r["log_ratio"] for r in seen], [r["label"] for r in seen])
    k = scored.where(F.col("log_ratio") >= model.cut).count()
    model.threshold = kth_largest(scored.select("key"), k) if k else np.inf
    return model


def best_cut(ratios: list[float], label: list[int]) -> float:
    """The cut with least cost on labelled rows; none without both classes."""
    x, y = np.array(ratios), np.array(label)
    if not (y == 0).any() or not (y == 1).any():
        return -np.inf
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    # cost of a cut just below x[i]: good rows before i, bad rows from i on
    cost = GOOD_COST * np.concatenate(([0], np.cumsum(y == 1)[:-1])) + (y == 0)[::-1].cumsum()[::-1]
    first = np.concatenate(([True], x[1:] != x[:-1]))
    cost = np.where(first, cost, np.iinfo(np.int64).max)
    i = int(np.argmin(cost))
    return float(x[i]) if i == 0 else float((x[i] + x[i - 1]) / 2)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(doc_id, log_ratio, sample_key, kept)`` of every row of ``docs``."""
    slim = texts(docs, id_col, text_col)
    model = fit(slim, labels)
    out = slim.select("doc_id", model.log_ratio("text").alias("log_ratio"))
    key = F.col("log_ratio") + gumbel("doc_id")
    threshold = -float("inf") if model.threshold is None else float(model.threshold)
    return out.select("doc_id", "log_ratio", key.alias("sample_key"), (key >= F.lit(threshold)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the draw keeps, with all their columns."""
    model = fit(texts(docs), labels)
    if model.threshold is None:
        return docs
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.where(model.log_ratio(text) + gumbel(F.col("doc_id")) >= F.lit(float(model.threshold)))
