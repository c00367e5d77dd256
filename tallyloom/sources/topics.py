"""Topics as sources and sinks. Needs Spark's Kafka package on the cluster."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.sources.rules import parse_rules, usable


def topic_options(host: str, port: int, topic: str) -> dict[str, str]:
    """Reader options: the topic from its earliest record."""
    return {
        "kafka.bootstrap.servers": f"{host}:{port}",
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def topic_order(timestamp: Column, offset: Column) -> Column:
    return F.unix_millis(timestamp) * F.lit(1 << 20) + F.pmod(offset, F.lit(1 << 20))


def topic_lines(spark: SparkSession, host: str, port: int, topic: str) -> DataFrame:
    """The records of a topic as a stream of text lines."""
    reader = spark.readStream.format("kafka").options(**topic_options(host, port, topic))
    return reader.load().select(F.col("value").cast("string").alias("line"))


def topic_rules(spark: SparkSession, host: str, port: int, topic: str) -> DataFrame:
    """The rules in a topic, read whole and again each time, with ``seq`` in arrival order.

    A batch read, so that it can be folded to the current rules. ``seq`` is one number, as
    rule versions need it: the record time in milliseconds, then the lower digits of the offset.
    The order of records that share a millisecond is that of their offsets, which holds in a
    topic of one partition.
    """
    reader = spark.read.format("kafka").options(**topic_options(host, port, topic))
    records = reader.load().select(
        F.col("value").cast("string").alias("line"),
        topic_order(F.col("timestamp"), F.col("offset")).alias("seq"),
    )
    return usable(parse_rules(records)).drop("line")


def write_topic(rows: DataFrame, host: str, port: int, topic: str, checkpoint: str) -> StreamingQuery:
    """Write a streaming frame to a topic, each row as JSON."""
    return (
        rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", f"{host}:{port}")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
