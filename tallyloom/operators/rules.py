"""The rule relation: current set, export, commands, counts."""

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.model import RULES


def _last_command(changes: DataFrame, command: str) -> DataFrame:
    is_command = (F.col("rule_state") == "CONTROL") & (F.col("control_type") == command)
    return changes.filter(is_command).agg(F.max("seq"))


def _after_command(df: DataFrame, changes: DataFrame, command: str) -> DataFrame:
    cut = _last_command(changes, command).scalar()
    return df.filter(cut.isNull() | (F.col("seq") > cut))


def fold_changes(changes: DataFrame) -> DataFrame:
    """The current rules after all changes, in the order of their unique ``seq``.

    The last change of an id wins; a delete takes the rule away; control rows change no
    rule by themselves, but ``DELETE_RULES_ALL`` voids every change before it. ``max_by``
    shrinks each id to one row before the shuffle, so an id with very many changes is
    no hot spot.
    """
    live = _after_command(changes, changes, "DELETE_RULES_ALL")
    last = (
        live.filter(F.col("rule_state").isin("ACTIVE", "PAUSE", "DELETE"))
        .groupBy("rule_id")
        .agg(F.max_by(F.struct(*[n for n in RULES.names if n != "rule_id"]), "seq").alias("_last"))
        .select("rule_id", "_last.*")
    )
    return last.filter(F.col("rule_state") != "DELETE").select(*RULES.names)


def clear_state(events: DataFrame, changes: DataFrame) -> DataFrame:
    """Events (with ``seq``) after the last ``CLEAR_STATE_ALL``; earlier ones no longer count."""
    return _after_command(events, changes, "CLEAR_STATE_ALL")


def last_per_id(rules: DataFrame, *more: str) -> DataFrame:
    """One row per rule id (and per value of ``more``): the last by ``seq``, if there is such a column.

    Of rows that nothing puts in order, a delete holds before a pause and a pause before an
    active rule; then the larger by value holds. Equal rows count once.
    """
    values = [n for n in RULES.names if n != "rule_id"]
    state = F.col("rule_state")
    rank = F.when(state == "DELETE", 2).when(state == "PAUSE", 1).otherwise(0)
    order = F.struct(*(["seq"] if "seq" in rules.columns else []), rank, *values)
    last = rules.filter(F.col("rule_id").isNotNull()).groupBy("rule_id", *more).agg(
        F.max_by(F.struct(*values), order).alias("_last")
    )
    return last.select("rule_id", "_last.*", *more)


def repeated_ids(rules: DataFrame) -> DataFrame:
    """Ids that come in several rows, of which :func:`last_per_id` keeps one."""
    counted = rules.filter(F.col("rule_id").isNotNull()).groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def current_rules(changes: DataFrame) -> DataFrame:
    """As :func:`fold_changes`, reading ``changes`` once: for a source that may change between two reads.

    Finding the last command brings all changes into one task, so it is for sources that
    hold to a bound.
    """
    is_command = (F.col("rule_state") == "CONTROL") & (F.col("control_type") == "DELETE_RULES_ALL")
    cut = F.max(F.when(is_command, F.col("seq"))).over(Window.partitionBy(F.lit(0)))
    live = changes.withColumn("_cut", cut).filter(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut")))
    more = ["epoch"] if "epoch" in changes.columns else []
    return last_per_id(live.filter(F.col("rule_state") != "CONTROL"), *more).filter(F.col("rule_state") != "DELETE")


def with_epoch(changes: DataFrame) -> DataFrame:
    """Changes with ``epoch``: how many ``CLEAR_STATE_ALL`` commands there are among them.

    One number for all rows; aggregates of an earlier epoch no longer count. As in
    :func:`current_rules`, all changes meet in one task, so it is for sources that hold to a bound.
    """
    clears = (F.col("rule_state") == "CONTROL") & (F.col("control_type") == "CLEAR_STATE_ALL")
    return changes.withColumn("epoch", F.count_if(F.coalesce(clears, F.lit(False))).over(Window.partitionBy(F.lit(0))))


def active(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("rule_state") == "ACTIVE")


def export_rules(rules: DataFrame, *more: str) -> DataFrame:
    """Every rule as one JSON object that :func:`parse_rules` reads back; ``more`` columns are members too."""
    named = F.struct(
        *more,
        F.col("rule_id").alias("ruleId"),
        F.col("table_name").alias("tableName"),
        F.col("rule_state").alias("ruleState"),
        F.col("grouping_keys").alias("groupingKeyNames"),
        F.transform(
            "aggs", lambda a: F.struct(a["field"].alias("f0"), a["func"].alias("f1"))
        ).alias("aggFields"),
        F.col("window_minutes").alias("windowMinutes"),
        F.col("control_type").alias("controlType"),
    )
    return rules.select("rule_id", *more, F.to_json(named).alias("json"))


def flag_rules(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """Keyed rows with ``has_rule``: whether their rule still exists. One join for both outcomes.

    No hint: Spark broadcasts the ids when it finds them small, and splits an id that
    holds very many rows otherwise.
    """
    ids = rules.select("rule_id").distinct().withColumn("_found", F.lit(True))
    return keyed.join(ids, "rule_id", "left").withColumn("has_rule", F.coalesce("_found", F.lit(False))).drop("_found")


def without_rule(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """Keyed rows whose rule is gone: they are dropped from aggregation, and listed here."""
    return flag_rules(keyed, rules).filter(~F.col("has_rule")).drop("has_rule")


def with_rule(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """Keyed rows whose rule still exists."""
    return flag_rules(keyed, rules).filter("has_rule").drop("has_rule")


def rule_counts(rules: DataFrame) -> DataFrame:
    """All known rules, paused ones included, and the active ones."""
    return rules.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("rule_state") == "ACTIVE").alias("active_rules"),
    )
