"""Streaming evaluation into a versioned table of results.

Update mode (the default) writes every aggregate that changed in a micro-batch: a late
event corrects results that were written before. On-close mode writes a result once,
when the watermark has passed the end of its window; later events are dropped.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.aggregate import finish, partials
from tallyloom.operators.documents import batch_parts, write_parts
from tallyloom.operators.fork import fork
from tallyloom.operators.rules import active
from tallyloom.session import state_on_disk

# fixed values: the default bound on lateness for closing a window, and the default
# time for which state is kept
DELAY = "500 milliseconds"
ALLOWED_LATENESS = "1 day"
# the length of the parts in which a stream keeps its groups
DAY = f"{24 * 60} minutes"

SideOutput = Callable[[DataFrame, int], None]


def _keyed(rules: DataFrame) -> DataFrame:
    return rules.filter(F.size("grouping_keys") > 0)


def update_partials(
    events: DataFrame,
    rules: DataFrame,
    allowed_lateness: str | None = ALLOWED_LATENESS,
    small_rules: bool | None = None,
) -> DataFrame:
    """Partial aggregates in update mode, with state that ends: any rule, any window length.

    Spark lets go of a group when the watermark has passed a window in its key, and the
    length of such a window is part of the plan, while rules bring their own lengths.
    So every group is kept in parts, one per day of its events; a day's parts leave the state
    when it is over by more than ``allowed_lateness``, and readers add a group's parts up. A window over
    several days, one that crosses midnight, and a total without a window are as right as any.
    Events later than that are dropped. With ``None`` state is kept for good and no event is too late.
    """
    if allowed_lateness is None:
        return partials(fork(events, rules, small_rules))
    day = F.window("event_time", DAY)
    return partials(fork(events.withWatermark("event_time", allowed_lateness), rules, small_rules), evict_by=day)


def window_lengths(rules: DataFrame) -> list[int]:
    """The distinct window lengths of the active rules, in minutes: a handful of numbers."""
    rows = active(_keyed(rules)).select("window_minutes").distinct().collect()
    return sorted(row[0] for row in rows)


def closing_partials(
    events: DataFrame,
    rules: DataFrame,
    lengths: list[int] | None = None,
    delay: str = DELAY,
    small_rules: bool | None = None,
) -> DataFrame:
    """Partial aggregates in append mode: each once, when its window has closed.

    One branch per distinct window length, because the length of a closing window is
    part of the plan. A rule that gets a new length while the stream runs stops it with an
    error, and a restart takes the length in; any other edit needs none. A rule without keys has
    a running total, which never closes: it is for :func:`update_partials`.
    """
    if lengths is None:
        lengths = window_lengths(rules)
    if not lengths:
        raise ValueError("no active rule with grouping keys")
    marked = events.withWatermark("event_time", delay)
    known = F.col("window_minutes").isin(lengths) | (F.col("rule_state") != "ACTIVE") | (F.size("grouping_keys") == 0)
    message = F.concat(F.lit("restart the stream for the window of rule "), F.col("rule_id").cast("string"))
    rules = rules.withColumn(
        "window_minutes", F.when(known, F.col("window_minutes")).otherwise(F.raise_error(message).cast("int"))
    )
    branches = []
    for minutes in lengths:
        of_length = _keyed(rules).filter(F.col("window_minutes") == minutes)
        window = F.window("event_time", f"{minutes} minutes")
        branches.append(partials(fork(marked, of_length, small_rules), evict_by=window))
    return reduce(DataFrame.unionByName, branches)


def start(
    parts: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    generation: int = 0,
    trigger: dict | None = None,
    side_output: SideOutput | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write streaming ``parts`` into the versioned table at ``path``; ``live_results`` reads it.

    State is recovered from ``checkpoint``; a batch that is repeated after a failure
    replaces its own folder, so every result counts once. ``side_output`` is called
    with the results of what each batch changed, for latency, alerts or exports; a group that is
    kept in several parts shows the changed one. State is kept on the executors' disks
    unless the session names a store (:func:`tallyloom.session.state_on_disk`).
    """

    def write(batch: DataFrame, number: int) -> None:
        write_parts(batch, path, number, generation)
        if side_output is not None:
            # from the rows just written: the batch is computed once and not kept in memory beside the state
            side_output(finish(batch_parts(batch.sparkSession, path, number, generation)), number)

    writer = parts.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with state_on_disk(parts.sparkSession):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def observed(forked: DataFrame, name: str = "evaluation", now: Column | None = None) -> DataFrame:
    """Count forked events and their latency as they pass; read from the query's progress."""
    now = F.current_timestamp() if now is None else now
    latency = F.unix_millis(now) - F.unix_millis(F.col("ingestion_time"))
    return forked.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.max(latency).alias("max_latency_ms"),
        F.avg(latency).alias("avg_latency_ms"),
    )


def heartbeat(events: DataFrame, beats: DataFrame) -> DataFrame:
    """Events with heartbeat rows among them, so that an idle source still closes windows.

    ``beats`` is a stream with an ``event_time``; its rows have no fields, match no rule
    and only move the watermark. Apply before the watermark is set. (With a NULL table
    name they would be filtered out ahead of the watermark.)
    """
    at = F.col("event_time").cast("timestamp")
    given = {
        "table_name": F.lit(""),
        "fields": F.create_map().cast("map<string,string>"),
        "event_ms": F.unix_millis(at),
        "event_time": at,
    }
    typed = beats.select(
        *[given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema.fields]
    )
    return events.unionByName(typed)
