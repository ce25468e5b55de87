"""Scoring a stream. Preparation, binning, scoring and leaf indexes are stateless column expressions, so
the same functions serve a streaming DataFrame; only the sink differs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from grove.forest import Forest


def score_stream(stream: DataFrame, forest: Forest, features: str = "features", leaves: bool = False) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("score_stream takes a streaming DataFrame")
    scored = forest.transform(stream, features)
    return forest.leaf_index(scored, features) if leaves else scored


def write_scores_stream(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows to Parquet; the checkpoint makes the output exactly-once."""
    return (
        scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
    )
