"""Structured Streaming: score arriving documents with a fitted model."""

from tallybayes.streaming.scoring import batch_bytes, score_stream, stream_path, stream_scores

__all__ = ["batch_bytes", "score_stream", "stream_path", "stream_scores"]
