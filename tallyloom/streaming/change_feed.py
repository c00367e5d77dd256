"""Changes of rules as a live source: a folder of change records, folded into rule sets that streams follow.

The records are read by Spark's file source, whose offsets are in the checkpoint: after a restart every
change counts once. :func:`maintain_rules` keeps the folded state and publishes each new set as a
version that :func:`tallyloom.streaming.rule_feed.live_rules` picks up. :func:`live_changes` gives all changes with
their order instead, for events that must meet the rules as they stood at their own place in it.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.model import RULE_TABLE, RULES
from tallyloom.operators.aggregate import partials
from tallyloom.operators.asof import fork_asof, rule_versions
from tallyloom.operators.bounded import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from tallyloom.operators.rules import export_rules
from tallyloom.sources.rules import changed_rows, parse_rules, rules_from_table, usable
from tallyloom.streaming.job import ALLOWED_LATENESS, DAY
from tallyloom.streaming.rule_feed import FORMAT, RuleFolder

#: A change record: its place in the order of changes, what happened, and the row after it.
CHANGES = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("after", T.StructType([*RULE_TABLE.fields, T.StructField("control_type", T.StringType())])),
    ]
)
_STATE = T.StructType([*RULES.fields, T.StructField("seq", T.LongType())])


def stream_changes(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Rule rows with their ``seq`` from a growing folder of JSON change records.

    Deletes of a table's row are no changes of rules, and records that cannot be used are left out.
    """
    reader = spark.readStream.schema(CHANGES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return usable(rules_from_table(changed_rows(reader.json(folder))))


def _state(spark: SparkSession, path: str, batch: int) -> DataFrame:
    if batch < 0:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{path}/state/batch={batch}")


def _last_changes(rows: DataFrame) -> DataFrame:
    """Of every rule its last change by ``seq``, deletes too; of commands the last of each kind.

    What a ``DELETE_RULES_ALL`` voids is gone for good, and the command stays to void what comes late.
    """
    is_command = F.col("rule_state") == "CONTROL"
    values = [n for n in _STATE.names if n not in ("rule_id", "control_type")]
    key = F.when(~is_command, F.col("rule_id")).alias("rule_id"), F.when(is_command, F.col("control_type")).alias("control_type")
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*values), "seq").alias("_last"))
    return last.select("rule_id", "control_type", "_last.*").select(*_STATE.names)


def _current(state: DataFrame) -> DataFrame:
    """The rules that hold: not voided by a later command, not deleted."""
    cut = state.filter("control_type = 'DELETE_RULES_ALL'").agg(F.max("seq")).scalar()
    live = state.filter(F.col("rule_state").isin("ACTIVE", "PAUSE"))
    return live.filter(cut.isNull() | (F.col("seq") > cut))


def maintain_rules(
    changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Fold a stream of ``changes`` into the rule set at ``path``; ``live_rules(spark, f"{path}/rules")`` follows it.

    Every micro-batch folds its changes into the state that the one before it left, one row per rule, and
    publishes the rules that hold as the next version. It replaces its own folders, so a repeated one does
    the same again. Changes may come out of order: the larger ``seq`` holds.
    """
    spark = changes.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        state = _last_changes(_state(spark, path, number - 1).unionByName(batch.select(*_STATE.names)))
        state.write.mode("overwrite").parquet(f"{path}/state/batch={number}")
        lines = export_rules(_current(_state(spark, path, number)).select(*RULES.names)).select("json")
        lines.coalesce(1).write.mode("overwrite").text(f"{path}/rules/version={number + 1}")

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def live_changes(
    spark: SparkSession, path: str, max_rows: int | None = MAX_BROADCAST_ROWS, max_bytes: int | None = MAX_BROADCAST_BYTES,
    patience: float = 30,
) -> DataFrame:
    """All changes in the folder ``path`` with their ``seq``, read anew in every micro-batch.

    A line is a rule as JSON with a member ``seq``; lines are added by adding files. The bounds
    are those of :func:`tallyloom.streaming.rule_feed.live_rules`.
    """
    spark.dataSource.register(RuleFolder)
    reader = spark.read.format(FORMAT).option("path", path).option("patience", patience)
    for name, limit in (("maxRows", max_rows), ("maxBytes", max_bytes)):
        if limit is not None:
            reader = reader.option(name, limit)
    seq = F.get_json_object("line", "$.seq").try_cast("bigint")
    parsed = usable(parse_rules(reader.load().select("line"))).withColumn("seq", seq)
    return parsed.filter("seq IS NOT NULL").drop("line")


def asof_partials(
    events: DataFrame, changes: DataFrame, allowed_lateness: str | None = ALLOWED_LATENESS, small_rules: bool | None = None
) -> DataFrame:
    """Partial aggregates of a stream of events with a ``seq``, each by the rules that held at its ``seq``.

    The ranges in which rule versions hold are made anew from ``changes`` (:func:`live_changes`) in every
    micro-batch and joined by ``seq`` inside it, so one micro-batch may lie on both sides of an edit, and how
    events are cut into micro-batches does not matter. A change must be in its folder before the events
    that come after it in the order are read.
    """
    versions = rule_versions(changes)
    if allowed_lateness is None:
        return partials(fork_asof(events, versions, small_rules))
    return partials(fork_asof(events.withWatermark("event_time", allowed_lateness), versions, small_rules), evict_by=F.window("event_time", DAY))
