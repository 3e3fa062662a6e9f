"""Quality selection by importance resampling over hashed n-grams (Xie et al., 2023).

Two generative models of hashed word and punctuation n-grams (one and two
tokens) are compared: one of the target text (labelled good and not toxic) and
one of all raw text; the raw model counts every document.  Labels come from at
most ``max_labels`` labelled documents with different texts, those with the
smallest hash of their text.  A document's weight sums the log ratios of target to raw over all its n-grams, of both
signs, with ``PRIOR`` added to both counts; a labelled document's own n-grams are taken out of the target for its own
weight, so that it counts like one without a label.  N-grams that labelled bad rows have significantly
more often (a chi-square test of the documents that have them) weigh ``EMPHASIS`` times more: a
few toxic words would be lost among hundreds of plain ones.  The sum is divided by the square root of
the document's n-grams, so that long texts don't drift.  Then k documents are
drawn without replacement by Gumbel top-k at ``temperature`` 1; k is the number whose
weight reaches the threshold that separates the labelled rows best.

The Gumbel noise is a hash of the id, so a run can be repeated.  The k-th
largest key is found by counting keys in ever narrower ranges; nothing is sorted in
one place.  Defined cases: a document without tokens has weight 0; without
labels of both kinds all documents are kept; rows that share an id share
its noise; a row without an id draws the noise of a null; ties at the k-th key
are all kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm import textnum
from tallybayes.llm.storage import save, without_rows

BUCKETS = 1 << 18
PREFIX = 6
#: Added to both counts of a ratio, and of one that labelled rows mark.
PRIOR, MARKED_PRIOR = 4.0, 1.0
CHI_SQUARE = 25.0
EMPHASIS = 20.0


def _ngrams(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: ``(lo, hi, n-gram buckets, row of each)``.

    The n-grams are tokens, pairs of tokens, the first ``PREFIX`` bytes of tokens,
    and one n-gram that stands for a token's third time in a row or in every
    other place.
    """
    offsets, data = textnum.text_buffers(batch.column(at))
    for lo, hi in textnum.blocks(offsets):
        h, ends = textnum.word_hashes(offsets, data, lo, hi, textnum.WORD_PUNCT)
        first = textnum.mix(textnum.word_hashes(offsets, data, lo, hi, textnum.WORD_PUNCT, PREFIX)[0])
        row = np.repeat(np.arange(hi - lo), np.diff(ends))
        grams, rows = [h, first], [row, row]
        if len(h):
            pair = row[1:] == row[:-1]
            grams.append(textnum.mix(h[:-1] * textnum._P + h[1:])[pair])
            rows.append(row[1:][pair])
        for gap in (1, 2):
            if len(h) > 2 * gap:
                same = (h[:-2 * gap] == h[gap:-gap]) & (h[gap:-gap] == h[2 * gap:]) & (row[:-2 * gap] == row[2 * gap:])
                grams.append(np.zeros(int(same.sum()), np.uint64))
                rows.append(row[2 * gap:][same])
        yield lo, hi, (np.concatenate(grams) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(rows)


def _counts(docs: DataFrame) -> DataFrame:
    """``(bucket, raw, target, good, bad)`` of rows ``(text, good)``: n-grams of all and of good rows, and
    the good and bad rows that have them; summed within each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, BUCKETS), np.int64)
        for batch in batches:
            good = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            for lo, hi, bucket, row in _ngrams(batch, 0):
                sums[0] += np.bincount(bucket, minlength=BUCKETS)
                for i in np.flatnonzero(good[lo:hi] >= 0):
                    mine = bucket[row == i]
                    once = np.unique(mine)
                    if good[lo + i]:
                        np.add.at(sums[1], mine, 1)
                        sums[2, once] += 1
                    else:
                        sums[3, once] += 1
        some = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(x[some]) for x in sums)],
                                         ["bucket", "raw", "target", "good", "bad"])

    parts = docs.mapInArrow(run, "bucket bigint, raw bigint, target bigint, good bigint, bad bigint")
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "target", "good", "bad")])


class Ratios:
    """Log ratios of target to raw by bucket, from the rows of ``_counts``."""

    def __init__(self, table: np.ndarray, n_good: int, n_bad: int):
        raw, target, good, bad = np.zeros((4, BUCKETS))
        at = table[:, 0].astype(np.int64)
        raw[at], target[at], good[at], bad[at] = table[:, 1:].T
        self.share, self.target, self.total = raw / max(raw.sum(), 1), target, target.sum()
        n, have = n_good + n_bad, good + bad
        square = n * (bad * (n_good - good) - good * (n_bad - bad)) ** 2
        chi = square / np.maximum(have * (n - have) * float(max(n_good * n_bad, 1)), 1)
        self.marked = (chi >= CHI_SQUARE) & (bad * n_good > good * n_bad) & (target < self.share * self.total)
        self.ratio = self._ratio(target, self.share * self.total, self.marked)

    @staticmethod
    def _ratio(target: np.ndarray, expected: np.ndarray, marked: np.ndarray) -> np.ndarray:
        return np.log((target + PRIOR) / (expected + PRIOR)) + EMPHASIS * np.where(
            marked, np.log((target + MARKED_PRIOR) / (expected + MARKED_PRIOR)), 0)

    def without_own(self, bucket: np.ndarray) -> float:
        """The sum over a target document's n-grams, the target being the other documents."""
        own, n = np.unique(bucket, return_counts=True)
        expected = self.share[own] * (self.total - len(bucket))
        return float((n * self._ratio(self.target[own] - n, expected, self.marked[own])).sum())


def _weights(docs: DataFrame, ratios) -> DataFrame:
    """``(id, h, good, n_grams, weight)`` of every row ``(text, good, id, h)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ratios.value
        for batch in batches:
            target = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False) == 1
            for lo, hi, bucket, row in _ngrams(batch, 0):
                n = np.bincount(row, minlength=hi - lo)
                total = np.bincount(row, weights=known.ratio[bucket], minlength=hi - lo)
                for i in np.flatnonzero(target[lo:hi]):
                    total[i] = known.without_own(bucket[row == i])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(x).slice(lo, hi - lo) for x in (2, 3, 1)), pa.array(n),
                    pa.array(total / np.sqrt(np.maximum(n, 1)))], ["id", "h", "good", "n_grams", "weight"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, h bigint, good int, n_grams bigint, weight double")


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that rejects most bad rows against the good rows it rejects."""
    cuts = np.unique(np.r_[good, bad])
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    caught = np.searchsorted(np.sort(bad), cuts) / len(bad)
    best = int(np.argmax(caught - 3 * lost))
    below = np.r_[cuts[0] - 1, cuts]
    return float((below[best] + cuts[best]) / 2)


def _kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest ``key``: a histogram of ever narrower ranges, each a small aggregate."""
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    above = 0
    while True:
        width = (hi - lo) / bins
        if not width > 0 or lo + width == lo:
            return lo
        part = F.least(F.floor((F.col("key") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        rows = keys.filter((F.col("key") >= lo) & (F.col("key") <= hi)).groupBy(part.alias("part")) \
            .agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("lo"), F.max("key").alias("hi")) \
            .orderBy(F.desc("part")).collect()
        for r in rows:
            if above + r["c"] >= k:
                if r["lo"] == r["hi"]:
                    return r["lo"]
                lo, hi = r["lo"], r["hi"]
                break
            above += r["c"]


def _resample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_labels: int, temperature: float,
              seed: int) -> DataFrame:
    """``(id, h, n_grams, weight, key, kept)`` of every row; ``h`` is a hash of the text."""
    spark = docs.sparkSession
    src = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id")) \
        .withColumn("h", F.xxhash64("text", F.lit(seed)))
    marks = labels.select(F.col(id_col).cast(src.schema["id"].dataType).alias("id"), F.when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 1).when(
        (F.col("quality") == 0) | (F.col("toxic") == 1), 0).alias("good")).dropna()
    marks = marks.groupBy("id").agg(F.min("good").alias("good")).join(src.select("id", "h"), "id") \
        .groupBy("h").agg(F.min(F.struct("id", "good")).alias("r"))
    marks = marks.orderBy("h").limit(max_labels).select("r.id", "h", "r.good")
    sample = marks.collect()
    n_good = sum(r["good"] for r in sample)
    n_bad = len(sample) - n_good
    rows = src.join(F.broadcast(spark.createDataFrame(sample, marks.schema)), ["id", "h"], "left") \
        .select("text", "good", "id", "h")  # at most max_labels rows are sent to the tasks
    table = _counts(rows.select("text", "good")).toPandas().to_numpy(float).reshape(-1, 5)  # at most BUCKETS rows
    ratios = spark.sparkContext.broadcast(Ratios(table, n_good, n_bad))
    noise = -F.log(-F.log((F.pmod(F.xxhash64(F.col("id"), F.lit(seed + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)))
    scored = save(_weights(rows, ratios).withColumn("key", F.col("weight") / temperature + noise), "weights")
    cut = float("-inf")
    if n_good and n_bad:
        known = scored.filter("good is not null").groupBy("h").agg(
            F.first("weight"), F.first("good")).drop("h").collect()
        values = np.array([tuple(r) for r in known], float).reshape(-1, 2)
        limit = _threshold(values[values[:, 1] == 1, 0], values[values[:, 1] == 0, 0])
        k = scored.filter(F.col("weight") >= limit).count()
        cut = _kth_largest(scored, k) if k else float("inf")
    return scored.select("id", "h", "n_grams", "weight", "key", (F.col("key") >= F.lit(cut)).alias("kept"))


def importance_resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        max_labels: int = 20_000, temperature: float = 1.0, seed: int = 7) -> DataFrame:
    """``(id_col, n_grams, weight, gumbel_key, kept)``, one row per input row; ids of any type.

    ``labels`` has ``(id_col, quality, toxic)``; a row is good if quality is 1 and
    toxic 0, and bad if quality is 0 or toxic 1.
    """
    return _resample(docs, labels, id_col, text_col, max_labels, temperature, seed).select(
        F.col("id").alias(id_col), "n_grams", "weight", F.col("key").alias("gumbel_key"), "kept")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_labels: int = 20_000, temperature: float = 1.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that ``importance_resample`` keeps; judged row by row, whatever their ids."""
    found = _resample(docs, labels, id_col, text_col, max_labels, temperature, seed)
    gone = found.filter(~F.col("kept")).select(F.struct("id", F.col("h").alias("text")))
    return without_rows(docs, id_col, text_col, gone, seed)
