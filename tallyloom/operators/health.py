"""Operational figures as data: event rate and latency."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.windows import MINUTE_MS, window_start


def event_rate(forked: DataFrame) -> DataFrame:
    """Aggregated events per minute of event time, and per second within it."""
    minute = window_start(F.col("event_ms"), F.lit(MINUTE_MS)).alias("minute_ms")
    return forked.groupBy(minute).agg(
        F.count(F.lit(1)).alias("events"), (F.count(F.lit(1)) / 60.0).alias("per_second")
    )


def with_latency(forked: DataFrame, now: Column | None = None) -> DataFrame:
    """Milliseconds from reading an event to now, for every forked event."""
    now = F.current_timestamp() if now is None else now
    return forked.withColumn(
        "latency_ms", F.unix_millis(now) - F.unix_millis(F.col("ingestion_time"))
    )


def latency_stats(latencies: DataFrame, *keys: str) -> DataFrame:
    return latencies.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.avg("latency_ms").alias("avg_ms"),
        F.percentile_approx("latency_ms", 0.5, 10_000).alias("p50_ms"),
        F.percentile_approx("latency_ms", 0.99, 10_000).alias("p99_ms"),
    )


#: Size of the sketches: ranks are right within about 0.7 percent with high probability.
SKETCH_K = 400
RANK_ERROR = 0.02


def latency_sketches(latencies: DataFrame, *keys: str) -> DataFrame:
    """Mergeable figures of latencies per key and minute of event time: counts, extremes and a quantile sketch of fixed size."""
    minute = window_start(F.col("event_ms"), F.lit(MINUTE_MS)).alias("minute_ms")
    return latencies.groupBy(*keys, minute).agg(
        F.count(F.lit(1)).alias("events"), F.min("latency_ms").alias("min_ms"), F.max("latency_ms").alias("max_ms"),
        F.sum("latency_ms").alias("sum_ms"), F.kll_sketch_agg_bigint("latency_ms", F.lit(SKETCH_K)).alias("sketch"),
    )


def merged_latency(sketches: DataFrame, *keys: str) -> DataFrame:
    """As :func:`latency_stats`, from sketches of any number of minutes and micro-batches.

    Percentiles are values whose rank is right within :data:`RANK_ERROR`; the other figures are exact.
    """
    done = sketches.groupBy(*keys).agg(
        F.sum("events").alias("events"), F.min("min_ms").alias("min_ms"), F.max("max_ms").alias("max_ms"),
        F.sum("sum_ms").alias("sum_ms"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("sketch"),
    )
    at = lambda p, name: F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name)
    return done.select(
        *keys, "events", "min_ms", "max_ms", (F.col("sum_ms") / F.col("events")).alias("avg_ms"), at(0.5, "p50_ms"), at(0.99, "p99_ms")
    )
