"""Structured Streaming forms of the stateless quality chain and of exact deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.functions import text as t
from corpusloom.operators.cleaning import QualityConfig, quality_chain


def clean_stream(stream: DataFrame, cfg: QualityConfig, text: str = "text") -> DataFrame:
    """Rows of a stream that pass the quality chain, with ``clean`` and ``fingerprint``."""
    from pyspark.sql import functions as F

    x = quality_chain(stream, cfg, text).where("reject is null")
    return x.withColumn("fingerprint", t.fingerprint(F.col("clean")))


def unique_stream(stream: DataFrame, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First row of each fingerprint.  With an event time, state older than the watermark is dropped, so a
    copy that comes later than ``delay`` passes again; without one, state grows with the distinct texts."""
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["fingerprint"])
    return stream.dropDuplicates(["fingerprint"])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes what is there and stops; the sink is exactly-once through its log."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
