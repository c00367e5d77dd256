"""Rule versions over time, for replaying events against changing rules."""

from pyspark.sql import DataFrame, functions as F

from tallyloom.model import RULES
from tallyloom.operators.fork import fork
from tallyloom.operators.running import running

_END = 2**63 - 1


def rule_versions(changes: DataFrame) -> DataFrame:
    """Each change with the range of ``seq`` in which it is the current one, ``[from, to)``.

    A version ends where the next change of the same rule begins, deletes and pauses
    included.
    """
    live = changes.filter(F.col("rule_state").isin("ACTIVE", "PAUSE", "DELETE"))
    rows = live.select(*RULES.names, F.col("seq").alias("from_seq"), (-F.col("seq")).alias("_back"))
    # the next change's seq: the smallest of the later ones, found by running backwards
    # over pairs of neighbours, so that no rule's history has to fit one task
    marks = rows.select("rule_id", "_back").withColumn("_seq", -F.col("_back"))
    steps = marks.select(
        "rule_id", "_seq",
        F.inline(
            F.array(
                # the row itself asks first, then becomes visible to earlier rows
                F.struct((F.col("_back") * 2).alias("_at"), F.lit(None).cast("bigint").alias("_next"), F.lit(True).alias("_asks")),
                F.struct((F.col("_back") * 2 + 1).alias("_at"), F.col("_seq").alias("_next"), F.lit(False).alias("_asks")),
            )
        ),
    )
    ends = (
        running(steps, ["rule_id"], ["_at"], {"to_seq": ("min", "_next")}, F.shiftright("_at", 17))
        .filter("_asks")
        .select("rule_id", F.col("_seq").alias("from_seq"), "to_seq")
    )
    return rows.drop("_back").join(ends, ["rule_id", "from_seq"]).select(
        *RULES.names, "from_seq", F.coalesce("to_seq", F.lit(_END)).alias("to_seq")
    )


def fork_asof(events: DataFrame, versions: DataFrame, small_rules: bool | None = None) -> DataFrame:
    """Fork every event (with ``seq``) by the rule versions current at its ``seq``.

    The range is a condition on top of the hash join by table name, never a nested loop.
    """
    current = (F.col("seq") >= F.col("from_seq")) & (F.col("seq") < F.col("to_seq"))
    return fork(events, versions, small_rules, when=current, more=("from_seq", "to_seq"))
