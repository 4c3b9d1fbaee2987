"""Incremental runs with Structured Streaming: queues, URL dedup, look-back joins, windowed health, late group members."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.runs import health_by_window


def distinct_urls(stream: DataFrame, url: str = "source_url", ts: str = "ts", delay: str = "72 hours") -> DataFrame:
    """Each URL once within the watermark; the state of older ones is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([url])


def lookback_join(left: DataFrame, right: DataFrame, key: str, hours: int = 72) -> DataFrame:
    """Stream-stream join: equal keys at most ``hours`` apart. Both sides have ``ts`` and ``id``; state older than that goes."""
    delay = f"{hours} hours"
    a = left.select(F.col("id").alias("a_id"), F.col("ts").alias("a_ts"), F.col(key).alias("a_key")).withWatermark("a_ts", delay)
    b = right.select(F.col("id").alias("b_id"), F.col("ts").alias("b_ts"), F.col(key).alias("b_key")).withWatermark("b_ts", delay)
    near = F.expr(f"a_key = b_key AND b_ts BETWEEN a_ts - INTERVAL {hours} HOURS AND a_ts + INTERVAL {hours} HOURS AND a_id < b_id")
    return a.join(b, near)


def health_stream(log: DataFrame, width: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    return health_by_window(log.withWatermark("ts", delay), width)


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """All that is there now, into a Parquet table; the next call goes on where this one ended."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start().awaitTermination()


def drain_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Each micro-batch through ``step``. A batch counts as done only if its step succeeds; else the next run repeats it whole."""
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
