"""Scoring a document stream with a built-in file sink.

The per-token work (tokenize, in-row bag, lookup in the model) is stateless,
so it runs as a streaming query: a stream-static join of each arriving
document's tokens and marker to the model's term table, whose deltas (an array over the classes, or
(class, delta) pairs of many classes) are written with the parquet file sink.  The table's most frequent terms are broadcast;
only tokens of the others are shuffled.  Marker and contributions of a
document belong to one micro-batch of one sink, which is exactly-once through its
checkpoint and commit log: a document is either complete in it or absent.  The
per-document sums and the argmax are then a batch step over what the
sink has committed (``stream_scores``); no streaming state, no Python callback into
the stream, and no column per class.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_path(path: str) -> str:
    """``path`` as a stream's source, be it one file or a folder of files.

    A stream takes a plain path for a folder; as a pattern (which matches nothing else) it may be either.
    """
    head, last = re.sub(r"([\\*?\[\]{}])", r"\\\1", path[:-1]), path[-1]
    return f"{head}[{last}]"


# Bytes of input that a micro-batch has for each core, at least: two whole splits.
CORE_BYTES = 256 << 20


def batch_bytes(model, spark: SparkSession) -> int:
    """Input of a micro-batch, as a file source's ``maxBytesPerTrigger``.

    Every micro-batch reads the model's table, so it has at least as many bytes: all micro-batches together read no
    more of the model than of the stream, however both grow.
    """
    return max(CORE_BYTES * spark.sparkContext.defaultParallelism, model.table_bytes(32) or 0)


def score_stream(model, stream: DataFrame, id_cols: Sequence[str], base_path: str,
                 text_col: str = "text", keep: Sequence[str] = (),
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the file-sink query under ``base_path``.  ``prepare`` may
    filter or join the stream with static tables first (stateless)."""
    rows = prepare(stream) if prepare is not None else stream
    w = (model.known_terms(rows, id_cols, text_col, keep).writeStream.format("parquet").option("path", f"{base_path}/scored")
         .option("checkpointLocation", f"{base_path}/_checkpoints/scored"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_scores(model, spark: SparkSession, base_path: str, id_cols: Sequence[str],
                  keep: Sequence[str] = ()) -> DataFrame:
    """Predictions ``(ids…, keep…, prediction, score)`` for every document the
    stream has committed so far."""
    cols = [*id_cols, *[k for k in keep if k not in id_cols]]
    return model.term_scores(spark.read.parquet(f"{base_path}/scored"), cols)
