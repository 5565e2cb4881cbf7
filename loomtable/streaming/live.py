"""Structured Streaming forms of what the engine does over events that still arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def telemetry(samples: DataFrame, every: str = "0.5 seconds", late: str = "10 seconds") -> DataFrame:
    """Memory and utilisation in windows of time (X02, S18): window, peak_memory_mb, avg_utilization_pct, samples."""
    return (
        samples.withWatermark("ts", late).groupBy(F.window("ts", every))
        .agg(F.max("memory_used_mb").alias("peak_memory_mb"), F.avg("utilization_pct").alias("avg_utilization_pct"), F.count("*").alias("samples"))
    )


def token_stream(chunks: DataFrame, late: str = "1 minute") -> DataFrame:
    """State of each request as its chunks arrive (X01, S19): first content, last chunk, chunks so far. For update mode."""
    return (
        chunks.withWatermark("ts", late).groupBy("request_id")
        .agg(F.min(F.when(F.col("has_content"), F.col("ts"))).alias("first_ts"), F.max("ts").alias("last_ts"), F.count_if("has_content").alias("chunks"), F.max("usage_tokens").alias("usage_tokens"))
    )


def new_links(links: DataFrame, late: str = "1 hour", url: str = "url") -> DataFrame:
    """Each address once within the time that lateness is allowed (X03, X04); a repeat that comes later passes again, as
    the state must stay bounded."""
    return links.withWatermark("ts", late).dropDuplicatesWithinWatermark([url])


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events of each type in tumbling windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
