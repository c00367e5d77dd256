"""Windowed aggregates of forked events."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.fields import FieldMap, Fields
from tallyloom.functions.keys import metric_name
from tallyloom.functions.numbers import mean, number, overflows
from tallyloom.functions.windows import MINUTE_MS, window_start
from tallyloom.model import RESULTS, TOTAL
from tallyloom.operators.fork import FUNC_BITS

GROUP = ["rule_id", "table_name", "grouping_keys", "grouping_values"]
WINDOW = ["window_start_ms", "window_end_ms"]
_MEASURES = ["total", "n", "low", "high", "funcs", "n_overflow", "wide_total", "wide_low", "wide_high"]


def measured(forked: DataFrame, *keep: str, fields: Fields = FieldMap()) -> DataFrame:
    """One row per forked event and distinct field of its rule, with the field's number.

    Distinct fields, not specs: three functions of one field make one row, not three. A
    number that the decimal type cannot hold stands in ``wide`` as a double, and ``value`` is NULL.
    """
    rows = forked.select(*GROUP, *WINDOW, *keep, *fields.columns, F.inline("wanted"))
    field = F.col("field")
    rows = rows.select("*", fields.decimal(field).alias("_number"))
    double = fields.double(field)
    beyond = overflows(F.col("_number"), double)
    return rows.select(
        *GROUP, *WINDOW, *keep, "field", "funcs",
        F.when(~beyond, number(F.col("_number"))).alias("value"),
        F.when(beyond, double).alias("wide"),
    )


def _measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.bit_or("funcs").alias("funcs"), *_measures_of("value", "wide")]


def _measures_of(value: str, wide: str, end: str = "") -> list[Column]:
    # every buffer is a fixed-width number, so this stays a hash aggregate
    return [
        F.sum(value).alias(f"total{end}"),
        F.min(value).alias(f"low{end}"),
        F.max(value).alias(f"high{end}"),
        F.count(wide).alias(f"n_overflow{end}"),
        # only what the decimals leave out, so ordinary groups stay exact
        F.sum(wide).alias(f"wide_total{end}"),
        F.min(wide).alias(f"wide_low{end}"),
        F.max(wide).alias(f"wide_high{end}"),
    ]


def partials(
    forked: DataFrame,
    keyless: str = "running",
    evict_by: Column | None = None,
    fields: Fields = FieldMap(),
    mark: Column | None = None,
) -> DataFrame:
    """Mergeable aggregates per rule, group, window and field.

    The one shuffle of the evaluation; it moves partial aggregates, never events, so a
    group with very many events is no hot spot. A rule without grouping keys has, with
    ``keyless='running'``, one total over all time whose bounds are those of its latest
    window, and with ``'windowed'`` one total per window.

    ``evict_by`` is a time window in whose parts the groups are kept, which a stream needs to let go of old
    state. ``part`` then says which part of its group a row is (:func:`whole` puts them together);
    ``running`` marks totals without a window in their key. ``mark``, a number made of the rule's
    and the window's columns, keeps a group in parts likewise, and is what ``part`` says then. If the rules
    have an ``epoch``, groups of different epochs are kept apart: raising it clears all state.
    """
    epoch = ["epoch"] if "epoch" in forked.columns else []
    rows = measured(forked, *epoch, *([] if evict_by is None else ["event_time"]), fields=fields)
    running = (F.size("grouping_keys") == 0) if keyless == "running" else F.lit(False)
    keys = [
        *GROUP,
        F.when(~running, F.col("window_start_ms")).alias("_start"),
        F.when(~running, F.col("window_end_ms")).alias("_end"),
        "field",
        *epoch,
    ]
    kept = mark if evict_by is None else evict_by
    if kept is not None:
        keys.append(kept.alias("_kept"))
    done = rows.groupBy(*keys).agg(
        *_measures(),
        F.max("window_start_ms").alias("window_start_ms"),
        F.max("window_end_ms").alias("window_end_ms"),
    )
    part = F.lit(None).cast("bigint") if kept is None else F.col("_kept") if evict_by is None else F.unix_millis("_kept.start")
    return done.select(
        *GROUP, *WINDOW, "field", *_MEASURES, F.col("_start").isNull().alias("running"), part.alias("part"),
        F.col("epoch") if epoch else F.lit(0).cast("bigint").alias("epoch"),
    )


def partials_of_rules(
    forked: DataFrame, side: DataFrame, most_fields: int, keyless: str = "running", fields: Fields = FieldMap()
) -> DataFrame:
    """As :func:`partials`, for a small set of rules that stays as it is while the job runs.

    Where most groups are small, the partial aggregates are as many as the events, and their width is the
    cost of the job. So all fields of a rule (at most ``most_fields``) stand side by side in one row per
    group, and the key is the rule's id instead of its columns, which come back from ``side`` (the
    rules as :func:`tallyloom.operators.fork.matcher` gives them) by a broadcast join. A rule that was edited between
    the two reads of the rules is an error.
    """
    # a small number for what a rule says: rules that differ are not taken for one another
    says = F.xxhash64("table_name", "grouping_keys", "wanted").alias("_rule")
    running = (F.size("grouping_keys") == 0) if keyless == "running" else F.lit(False)
    slots = range(most_fields)
    name = [F.get(F.col("wanted"), F.lit(i))["field"] for i in slots]
    start = F.when(~running, F.col("window_start_ms"))
    # a hash comes first: groups that outgrow the memory are sorted by the key, of which the first number decides at once
    key = ["_hash", "rule_id", "_rule", "grouping_values", "_start"]
    rows = forked.select(
        F.xxhash64("rule_id", "grouping_values", start).alias("_hash"),
        "rule_id", says, "grouping_values", start.alias("_start"), *WINDOW,
        F.size("wanted").alias("_size"), *[fields.decimal(name[i]).alias(f"_number{i}") for i in slots],
        *[fields.double(name[i]).alias(f"_double{i}") for i in slots],
    ).filter("_size > 0")
    beyond = [overflows(F.col(f"_number{i}"), F.col(f"_double{i}")) for i in slots]
    # rules that were edited after their size was checked must not lose a field
    changed = F.raise_error(F.lit("a rule got more fields while the job was planned: run it again"))
    rows = rows.select(
        *key, *WINDOW, F.when(F.col("_size") <= most_fields, 1).otherwise(changed.cast("int")).alias("_one"),
        *[F.when(~beyond[i], number(F.col(f"_number{i}"))).alias(f"value{i}") for i in slots],
        *[F.when(beyond[i], F.col(f"_double{i}")).alias(f"wide{i}") for i in slots],
    )
    done = rows.groupBy(*key).agg(
        F.count("_one").alias("n"),
        *[m for i in slots for m in _measures_of(f"value{i}", f"wide{i}", str(i))],
        *[F.max(c).alias(c) for c in WINDOW],
    )
    said = F.broadcast(side.select("rule_id", says, "table_name", "grouping_keys", "wanted"))
    edited = F.raise_error(F.lit("a rule was edited while the job ran: run it again"))
    wanted = F.when(F.col("wanted").isNotNull(), F.col("wanted")).otherwise(edited.cast(side.schema["wanted"].dataType))
    measures = [m for m in _MEASURES if m not in ("n", "funcs")]
    each = [
        F.struct(F.get(F.col("wanted"), F.lit(i))["field"].alias("field"), F.get(F.col("wanted"), F.lit(i))["funcs"].alias("funcs"),
                 *[F.col(f"{m}{i}").alias(m) for m in measures])
        for i in slots
    ]
    joined = done.join(said, ["rule_id", "_rule"], "left").withColumn("wanted", wanted)
    return joined.select(
        *GROUP, *WINDOW, "n", F.col("_start").isNull().alias("running"),
        F.inline(F.slice(F.array(*each), F.lit(1), F.size("wanted"))),
    ).select(
        *GROUP, *WINDOW, "field", *_MEASURES, "running",
        F.lit(None).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("epoch"),
    )


def whole(parts: DataFrame) -> DataFrame:
    """The parts of every group added up; a running total has the bounds of its latest window."""
    key = [F.when(~F.col("running"), F.col(c)).alias(f"_{c}") for c in WINDOW]
    done = parts.groupBy(*GROUP, *key, "field").agg(
        *_sums_of_parts(), F.max("window_start_ms").alias("window_start_ms"), F.max("window_end_ms").alias("window_end_ms")
    )
    return done.select(*GROUP, *WINDOW, "field", *_MEASURES)


def merge(parts: DataFrame, minutes: int | None = None) -> DataFrame:
    """Merge partial aggregates, optionally into coarser windows of ``minutes``.

    Every window must lie within one coarser window, so ``minutes`` has to be a multiple
    of the windows at hand; a part that straddles a bound is an error, not a guess.
    """
    if minutes is not None:
        size = F.lit(minutes * MINUTE_MS)
        start = window_start(F.col("window_start_ms"), size)
        parts = parts.withColumn(
            "window_start_ms",
            F.when(F.col("window_end_ms") <= start + size, start).otherwise(
                F.raise_error(F.lit("a window does not lie within the coarser window"))
            ),
        ).withColumn("window_end_ms", F.col("window_start_ms") + size)
    return parts.groupBy(*GROUP, *WINDOW, "field").agg(*_sums_of_parts())


def _sums_of_parts() -> list[Column]:
    return [
        F.sum("total").cast(TOTAL).alias("total"),
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.bit_or("funcs").alias("funcs"),
        F.sum("n_overflow").alias("n_overflow"),
        F.sum("wide_total").alias("wide_total"),
        F.min("wide_low").alias("wide_low"),
        F.max("wide_high").alias("wide_high"),
    ]


def finish(parts: DataFrame) -> DataFrame:
    """Long results: one row per metric the rule asks for.

    Where a group holds numbers beyond the decimal type (``n_overflow`` says how many), ``approx``
    has the metric as a double over all its numbers, and ``value`` the same as far as it fits.
    """
    # the names for every combination of function bits, a constant
    names = F.array(
        *[
            F.array(*[F.lit(func) for func, bit in FUNC_BITS.items() if bits & bit]).cast("array<string>")
            for bits in range(2 * max(FUNC_BITS.values()))
        ]
    )
    long = parts.select("*", F.explode(F.get(names, F.col("funcs"))).alias("func"))
    func = F.col("func")
    # fixed values: the closed set of functions
    value = (
        F.when(func == "SUM", F.col("total"))
        .when(func == "COUNT", F.col("n").cast(TOTAL))
        .when(func == "MIN", F.col("low").cast(TOTAL))
        .when(func == "MAX", F.col("high").cast(TOTAL))
        .when(func == "AVG", mean(F.col("total"), F.col("n")))
    )
    total = F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.col("wide_total")
    wide = (
        F.when(func == "SUM", total)
        .when(func == "COUNT", F.col("n").cast("double"))
        .when(func == "MIN", F.least(F.col("low").cast("double"), "wide_low"))
        .when(func == "MAX", F.greatest(F.col("high").cast("double"), "wide_high"))
        .when(func == "AVG", total / F.col("n"))
    )
    beyond = F.col("n_overflow") > 0
    long = long.select("*", F.when(beyond, wide).alias("approx"))
    return long.select(
        *GROUP, *WINDOW, metric_name(F.col("field"), func).alias("metric"),
        F.when(beyond, F.col("approx").try_cast(TOTAL)).otherwise(value).alias("value"),
        "n_overflow", "approx",
    ).select(*RESULTS.names)


def metric_map(results: DataFrame) -> DataFrame:
    """All metrics of a group in one map; their number is bounded by the rule's specs."""
    return results.groupBy(*GROUP, *WINDOW).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")
    )


def last_event(forked: DataFrame, event_id: str) -> DataFrame:
    """The last event of every group by time, then by id."""
    return forked.groupBy(*GROUP, *WINDOW).agg(
        F.max_by(F.struct(event_id, "event_ms", "fields"), F.struct("event_ms", event_id)).alias("last")
    ).select(*GROUP, *WINDOW, "last.*")


def long_average(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The mean of a whole-number column per key, as a double."""
    return df.groupBy(*keys).agg(F.avg(F.col(column).cast("bigint")).alias("average"))


def distinct_values(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The set of values of every key, one row per member.

    As rows, because a set inside one cell would have to fit one task's memory.
    """
    return df.select(*keys, column).distinct()


def distinct_counts(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(column).alias("n_distinct"))
