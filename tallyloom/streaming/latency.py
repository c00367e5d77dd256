"""Latency of a stream as a table of sketches, one row per rule, minute and micro-batch."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.fork import fork
from tallyloom.operators.health import latency_sketches, merged_latency, with_latency


def start_latency(
    events: DataFrame, rules: DataFrame, path: str, checkpoint: str, now: Column | None = None,
    trigger: dict | None = None, small_rules: bool | None = None,
) -> StreamingQuery:
    """Keep the latency of every event under every rule that it matches, from its ingestion to ``now``.

    Sketches are made before the shuffle and have a fixed size, so a rule with very many events is no hot spot. There is no
    state: a micro-batch writes a folder of its own, which a repeated one replaces.
    """

    def write(batch: DataFrame, number: int) -> None:
        measured = with_latency(fork(batch, rules, small_rules), now)
        latency_sketches(measured, "rule_id").write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_latency(spark: SparkSession, path: str, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Latency figures per rule, of a stretch of event time or of all."""
    sketches = spark.read.parquet(path)
    if from_ms is not None:
        sketches = sketches.filter(F.col("minute_ms") >= from_ms)
    if to_ms is not None:
        sketches = sketches.filter(F.col("minute_ms") < to_ms)
    return merged_latency(sketches, "rule_id")
