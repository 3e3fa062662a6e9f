"""Language identification by averaged hashed subword embeddings (after fastText).

A text is the mean of the embeddings of its hashed byte n-grams (one to four
bytes, A-Z as a-z), classified by a linear softmax; both are trained by
stochastic gradient descent in numpy.  The classifier is linear in the mean, so
for prediction embeddings and output weights are multiplied once into one table
of class scores by n-gram, and executors sum rows of that table.

It learns from at most ``per_label`` rows of each label, those with the smallest
hash of their id, whole texts.  A fifth of them isn't trained on: on those rows
the softmax's temperature is fitted, and the rejection limit is the smallest score
above which their predictions reach ``precision``.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected, as is every text if there is nothing to learn from; rows without a
label are not learnt from; extra columns are ignored; repeated rows are
predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm import textnum

BUCKETS, LONGEST, DIM = 1 << 15, 4, 16


def _subwords(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: ``(lo, hi, n-gram buckets, row of each)``."""
    offsets, data = textnum.text_buffers(batch.column(at))
    for lo, hi in textnum.blocks(offsets):
        part = textnum._BYTE[data[offsets[lo]:offsets[hi]]]
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
        acc, buckets, rows = part, [], []
        for n in range(1, LONGEST + 1):
            if n > 1:
                acc = acc[:-1] * textnum._P + part[n - 1:]
            inside = row[:len(acc)] == row[n - 1:]
            buckets.append((textnum.mix(acc[inside]) % np.uint64(BUCKETS)).astype(np.int32))
            rows.append(row[:len(acc)][inside])
        yield lo, hi, np.concatenate(buckets), np.concatenate(rows)


def _bags(rows: DataFrame) -> DataFrame:
    """``(label, buckets, counts)`` of rows ``(label, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, bucket, row in _subwords(batch, 1):
                order = np.argsort(row, kind="stable")
                ends = np.searchsorted(row[order], np.arange(hi - lo + 1))
                bags = [np.unique(bucket[order[a:b]], return_counts=True) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([b for b, _ in bags], pa.list_(pa.int32())),
                    pa.array([c.astype(np.int32) for _, c in bags], pa.list_(pa.int32())),
                ], ["label", "buckets", "counts"])

    return rows.mapInArrow(run, "label string, buckets array<int>, counts array<int>")


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, epochs: int = 12,
          rate: float = 0.5, seed: int = 1) -> np.ndarray:
    """The (BUCKETS, n_labels) table of class scores, from (label, buckets, counts) rows."""
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out = np.zeros((DIM, n_labels))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            label, buckets, counts = bags[i]
            step = rate * (1 - done / steps)
            share = counts / counts.sum()
            mean = share @ embed[buckets]
            error = _softmax(mean @ out)
            error[label] -= 1
            back = out @ error
            out -= step * np.outer(mean, error)
            embed[buckets] -= step * len(buckets) * 0.1 * np.outer(share, back)
            done += 1
    return (embed @ out).astype(np.float32)


def _calibrate(table: np.ndarray, bags: list, precision: float) -> tuple[float, float]:
    """``(temperature, rejection limit)`` from rows that weren't trained on."""
    if not bags:
        return 1.0, 0.0
    z = np.array([(c / c.sum()) @ table[b] for _, b, c in bags])
    y = np.array([label for label, _, _ in bags])
    heat = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(
        np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean())
    p = _softmax(z / heat)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score)
    enough = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= precision
    return float(heat), float(score[order][np.flatnonzero(enough).max()]) if enough.any() else 1.1


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", per_label: int = 400, precision: float = 0.99) -> DataFrame:
    """``(id_col, lang_pred, score, accepted)`` for every row; ``learn`` marks the rows
    that may be learnt from."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    able = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("label"),
                F.xxhash64(F.col(id_col)).alias("h"))
    first = Window.partitionBy("label").orderBy("h", "id")
    chosen = able.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= per_label) \
        .select("id", "label", "h").distinct()
    sample = _bags(texts.join(F.broadcast(chosen), "id").select("label", "text")).collect()
    labels = sorted({r["label"] for r in sample})
    bags = sorted(((labels.index(r["label"]), np.array(r["buckets"]), np.array(r["counts"]))
                   for r in sample if r["buckets"]), key=lambda b: (b[0], len(b[1]), b[1].tobytes(), b[2].tobytes()))
    aside = [b for i, b in enumerate(bags) if i % 5 == 0]
    table, heat, limit = np.zeros((BUCKETS, 1), np.float32), 1.0, 1.1
    if bags:
        table = train([b for i, b in enumerate(bags) if i % 5], len(labels))
        heat, limit = _calibrate(table, aside, precision)
    shared = spark.sparkContext.broadcast((table, heat, limit, labels))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, heat, limit, labels = shared.value
        letter = regex.compile(r"\p{L}")
        for batch in batches:
            for lo, hi, bucket, row in _subwords(batch, 1):
                n = np.maximum(np.bincount(row, minlength=hi - lo), 1)
                z = np.stack([np.bincount(row, weights=table[bucket, k], minlength=hi - lo) / n
                              for k in range(table.shape[1])], axis=1)
                p = _softmax(z / heat)
                best, score = p.argmax(axis=1), p.max(axis=1)
                told = [bool(labels) and t is not None and letter.search(t) is not None
                        for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([labels[b] if ok else "und" for b, ok in zip(best, told)]),
                    pa.array(np.where(told, score, 0.0)),
                    pa.array(np.asarray(told, bool) & (score >= limit))], ["id", "lang_pred", "score", "accepted"])

    return texts.mapInArrow(run, f"id {kind}, lang_pred string, score double, accepted boolean") \
        .withColumnRenamed("id", id_col)
