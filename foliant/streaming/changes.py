"""Streams: keyed upserts of changes, and page-wise publication, in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_changes(stream: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Running last change per key: state is one row per key, combined before the shuffle."""
    rest = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("last")).select(*keys, *[F.col("last")[c].alias(c) for c in rest])


def publish_stream(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``merge(batch, batch_id)`` on everything that is there, then stop.

    ``merge`` must be idempotent per ``batch_id``: a batch is repeated after a failure."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Event-time counts per window; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).count().select(F.col("window.start").alias("window_start"), *keys, "count")
