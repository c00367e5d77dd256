"""Results once, when their window has closed: rules of any window length, and new ones while the stream runs.

The closing time is data here, not part of the plan. Every micro-batch adds mergeable aggregates of its
events to a table of open windows, dealt out by the day on which a window ends; it takes
the watermark on, and what has come to its end since the last one is added up and
written as results. Rows whose window had closed before their micro-batch began are kept apart, as late.

Each micro-batch reads the mark that the one before it left and replaces its own folders, so one
that is repeated after a failure does the same again, and every result counts once.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.model import PARTS, RESULTS
from tallyloom.operators.aggregate import finish, merge, partials
from tallyloom.operators.documents import read_versions, write_versions
from tallyloom.operators.fork import fork

# fixed value: the default bound on lateness for closing a window
DELAY_MS = 500
_DAY_MS = 24 * 60 * 60_000
_NEVER = -(1 << 62)
_OPEN = T.StructType(list(PARTS.fields)).add("late", T.IntegerType()).add("closes", T.LongType())
_MARK = "watermark_ms bigint, events bigint, late bigint"


def watermark(spark: SparkSession, path: str, batch: int) -> int:
    """The event time up to which windows have closed by the end of micro-batch ``batch``."""
    if batch < 0:
        return _NEVER
    return spark.read.schema(_MARK).parquet(f"{path}/marks/batch={batch}").first()["watermark_ms"]


def _write_open(parts: DataFrame, folder: str) -> None:
    day = F.call_function("div", F.col("window_end_ms"), F.lit(_DAY_MS))
    (
        parts.withColumns({"late": F.col("part").cast("int"), "closes": day})
        .hint("rebalance", "late", "closes")
        .write.mode("overwrite").partitionBy("late", "closes").parquet(folder)
    )


def open_parts(spark: SparkSession, path: str, batch: int, compact_every: int) -> DataFrame:
    """Aggregates up to micro-batch ``batch``: the last compaction before it and the micro-batches since."""
    first = batch // compact_every * compact_every
    folders = [f"{path}/open/batch={k}" for k in range(first, batch + 1)]
    if first:
        folders.append(f"{path}/compacted/batch={first - 1}")
    frames = [spark.read.schema(_OPEN).parquet(folder) for folder in folders]
    parts = frames[0]
    for frame in frames[1:]:
        parts = parts.unionByName(frame)
    return parts


def _between(parts: DataFrame, after_ms: int, until_ms: int | None) -> DataFrame:
    """Aggregates in time of windows that end after one instant and up to another; other days' folders are not read."""
    end = F.col("window_end_ms")
    chosen = (F.col("late") == 0) & (end > after_ms) & (F.col("closes") >= after_ms // _DAY_MS)
    if until_ms is not None:
        chosen = chosen & (end <= until_ms) & (F.col("closes") <= until_ms // _DAY_MS)
    return parts.filter(chosen)


def start_closing(
    events: DataFrame,
    rules: DataFrame,
    path: str,
    checkpoint: str,
    delay_ms: int = DELAY_MS,
    compact_every: int = 32,
    trigger: dict | None = None,
    small_rules: bool | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Evaluate a stream of ``events`` and write each result when its window has closed; read them with :func:`closed_results`.

    The watermark is the latest event time so far less ``delay_ms``. A window closes with the micro-batch
    that brings the watermark to its end; rows that come in a later one are late: they change
    nothing and are listed by :func:`late_rows`. Rules are read anew in every micro-batch if their source is
    (:func:`tallyloom.streaming.rule_feed.live_rules`): a rule with a window length that the stream never
    had joins like any other, and an edit goes on with the totals of the windows that are open. Rules
    without keys have a running total, which never closes: they are left out here. Commands that clear
    the state are for update mode.

    Only aggregates are kept, one row per group, window, field and micro-batch; every ``compact_every``
    micro-batches those of windows that are open are added up into one folder. Folders of
    ``open`` before the last compaction are not read again, except by :func:`late_rows`.
    """
    spark = events.sparkSession
    keyed = rules.filter(F.size("grouping_keys") > 0).drop("epoch")

    def write(batch: DataFrame, number: int) -> None:
        before = watermark(spark, path, number - 1)
        seen = batch.agg(F.max("event_ms").alias("last"), F.count(F.lit(1)).alias("events")).first()
        now = before if seen["last"] is None else max(before, seen["last"] - delay_ms)
        late = F.when(F.col("window_end_ms") <= before, 1).otherwise(0).cast("bigint")
        _write_open(partials(fork(batch, keyed, small_rules), mark=late), f"{path}/open/batch={number}")
        parts = open_parts(spark, path, number, compact_every)
        write_versions(finish(merge(_between(parts, before, now))), f"{path}/results", number)
        own = spark.read.schema(_OPEN).parquet(f"{path}/open/batch={number}")
        mark = own.agg(F.coalesce(F.sum(F.when(F.col("late") == 1, F.col("n"))), F.lit(0)).alias("late")).select(
            F.lit(now).cast("bigint").alias("watermark_ms"), F.lit(seen["events"]).cast("bigint").alias("events"), "late"
        )
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        if (number + 1) % compact_every == 0:
            still = merge(_between(parts, now, None))
            columns = {"running": F.lit(False), "part": F.lit(0).cast("bigint"), "epoch": F.lit(0).cast("bigint")}
            _write_open(still.withColumns(columns).select(*PARTS.names), f"{path}/compacted/batch={number}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def closed_results(spark: SparkSession, path: str) -> DataFrame:
    """Long results of all windows that have closed."""
    return read_versions(spark, f"{path}/results").select(*RESULTS.names)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per rule, group, window and field, how many rows came after their window had closed."""
    parts = spark.read.schema(T.StructType(list(_OPEN.fields)).add("batch", T.LongType())).parquet(f"{path}/open")
    keys = ["rule_id", "table_name", "grouping_keys", "grouping_values", "window_start_ms", "window_end_ms", "field"]
    return parts.filter("late = 1").groupBy(*keys).agg(F.sum("n").alias("n"))
