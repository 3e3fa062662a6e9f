"""Streaming plan: unlabeled documents arrive as a file stream and are scored
micro-batch by micro-batch with the model trained on the labeled ones."""

from __future__ import annotations

from tallybayes.operators.model import fit_multinomial
from tallybayes.plans import text_plans
from tallybayes.plans.fixtures import ALPHA, quality_docs, table
from tallybayes.session import scratch_dir
from tallybayes.streaming import batch_bytes, score_stream, stream_path, stream_scores

QUERIES: dict = {}
ORACLE: dict = {}


def q_nb_predict_stream(spark, sf_dir):
    """Same result as nb_predict_new, computed by a Structured Streaming query."""
    model = fit_multinomial(quality_docs(spark, sf_dir, "quality"), alpha=ALPHA)
    labeled = table(spark, sf_dir, "labels").select("doc_id")
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    stream = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxBytesPerTrigger", batch_bytes(model, spark)).parquet(stream_path(path)))
    base = scratch_dir(spark, "stream")
    query = score_stream(model, stream.select("doc_id", "text"), ["doc_id"], base,
                         prepare=lambda b: b.join(labeled, "doc_id", "left_anti"))
    query.awaitTermination()
    return stream_scores(model, spark, base, ["doc_id"]).select("doc_id", "prediction", "score")


QUERIES["nb_predict_stream"] = q_nb_predict_stream
ORACLE["nb_predict_stream"] = text_plans.ORACLE["nb_predict_new"]
