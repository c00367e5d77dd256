"""One row per event and matching rule."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.fields import FieldMap, Fields
from tallyloom.functions.keys import group_values
from tallyloom.functions.windows import MINUTE_MS, window_start
from tallyloom.operators.bounded import check_size, join_small
from tallyloom.operators.rules import active, last_per_id

# The functions a rule asks of one field, as bits, so that they travel as one integer.
FUNC_BITS = {"SUM": 1, "COUNT": 2, "MIN": 4, "MAX": 8, "AVG": 16}
# Up to this many grouping keys are picked one by one.
_MAX_SLOTS = 16


def matcher(rules: DataFrame, *more: str) -> DataFrame:
    """Active rules as the fork join needs them: per distinct field the functions asked for.

    An id that comes twice is one rule, the last one (see :func:`last_per_id`).
    """
    asked = lambda field: sum(
        (
            F.when(F.array_contains("aggs", F.struct(field.alias("field"), F.lit(func).alias("func"))), bit).otherwise(0)
            for func, bit in FUNC_BITS.items()
        ),
        F.lit(0),
    )
    names = F.array_distinct("aggs.field")
    return active(last_per_id(rules, *more)).select(
        "rule_id",
        "table_name",
        "grouping_keys",
        names.alias("required"),
        F.transform(names, lambda f: F.struct(f.alias("field"), asked(f).alias("funcs"))).alias("wanted"),
        (F.col("window_minutes").cast("bigint") * MINUTE_MS).alias("size_ms"),
        *more,
    )


def fork(
    indicators: DataFrame,
    rules: DataFrame,
    small_rules: bool | None = None,
    fields: Fields = FieldMap(),
    when: Column | None = None,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """Join events with the active rules of their table.

    A rule matches when every field it aggregates is present in the event (a present
    NULL counts); grouping keys may be missing. Adds the rule's columns, the group
    values and the bounds of the rule's own tumbling window. ``when`` is a further
    condition on both sides, ``more`` further rule columns it needs.

    Rules are rows here, never part of the plan: whatever they say, the plan is one
    hash join on the table name. An ``epoch`` of the rules comes along (see
    :func:`tallyloom.operators.rules.with_epoch`). (If that is one constant for all events, Spark filters
    the rules by it first and has no key left to hash; the pairs are the same.) The rules side is broadcast after a check of its
    size. With ``small_rules`` the caller answers for the size instead; on a stream, which
    is checked once at its start, that is the way for rules that may grow (False), or
    whose source keeps to a bound by itself (True).
    """
    if "epoch" in rules.columns:
        more = (*more, "epoch")
    side = matcher(rules, *more)
    max_keys = None
    if small_rules is None:
        small_rules, max_keys = check_size(side, F.size("grouping_keys"))
        if indicators.isStreaming or (max_keys or 0) > _MAX_SLOTS:
            max_keys = None
    condition = fields.all_present(F.col("required"))
    joined = join_small(
        indicators,
        side,
        "table_name",
        condition if when is None else condition & when,
        [F.col("event_ms"), *fields.content()],
        small_rules,
    )
    start = window_start(F.col("event_ms"), F.col("size_ms"))
    return joined.select(
        *indicators.columns,
        "rule_id",
        "grouping_keys",
        "wanted",
        *more,
        group_values(fields, F.col("grouping_keys"), max_keys).alias("grouping_values"),
        start.alias("window_start_ms"),
        (start + F.col("size_ms")).alias("window_end_ms"),
    )
