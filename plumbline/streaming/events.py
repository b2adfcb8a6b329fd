"""Event-time windows over streams or tables with a ``ts`` column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str, slide: str | None = None, late: str | None = "10 minutes", by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Events and summed value per window and key; ``late`` is the watermark of a stream."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    frame = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = rows.groupBy(frame.alias("w"), *by).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "events", "total")


def session_counts(events: DataFrame, gap: str, late: str | None = "10 minutes", by: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Events per session: runs of a key's events with gaps below ``gap``."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    out = rows.groupBy(*by, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return out.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def read_events(spark, folder: str) -> DataFrame:
    """The events table as a file stream."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def replay_requests(requests: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str):
    """Replay a request stream through ``handle(batch, id)``, such as a model call and its reply sink."""
    return requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_retry(function: Callable, attempts: int = 40, errors: tuple[type[Exception], ...] = (Exception,)) -> Callable:
    """``function`` called again after an error, at most ``attempts`` times in all; the last error is raised. For calls
    out of a batch handler; lost tasks are Spark's own to repeat."""

    def run(*args, **kw):
        for left in range(attempts - 1, -1, -1):
            try:
                return function(*args, **kw)
            except errors:
                if not left:
                    raise

    return run
