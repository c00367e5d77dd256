"""Group values, document ids, metric names."""

from pyspark.sql import Column, functions as F

from tallyloom.functions.fields import Fields


def group_values(fields: Fields, keys: Column, max_keys: int | None = None) -> Column:
    """The values of ``keys`` in the event, a missing one as the text ``null``.

    With ``max_keys`` (an upper bound on the length of ``keys`` found when the job was planned) the values are
    picked position by position, which stays inside generated code; without it a
    ``transform`` is used.
    """
    value = lambda key: F.coalesce(fields.text(key), F.lit("null"))
    if max_keys is None:
        return F.transform(keys, value)
    if max_keys == 0:
        return F.array().cast("array<string>")
    slots = [value(F.get(keys, F.lit(i))) for i in range(max_keys)]
    picked = F.slice(F.array(*slots), F.lit(1), F.size(keys))
    # rules that were edited after their size was checked must not lose a key
    changed = F.raise_error(F.lit("a rule got more grouping keys while the job was planned: run it again"))
    return F.when(F.size(keys) <= max_keys, picked).otherwise(changed.cast("array<string>"))


def doc_id(values: Column, start_ms: Column, end_ms: Column) -> Column:
    """``{v1-v2-start-end}``; ``{}`` for a running total, which has no window in its key.

    A ``-`` inside a value is written ``\\-``, and a backslash twice, so that different groups
    never print alike.
    """
    escaped = F.transform(
        values, lambda v: F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit("-"), F.lit("\\-"))
    )
    windowed = F.concat(
        F.lit("{"), F.concat_ws("-", escaped, start_ms.cast("string"), end_ms.cast("string")), F.lit("}")
    )
    return F.when(F.size(values) == 0, F.lit("{}")).otherwise(windowed)


def metric_name(field: Column, func: Column) -> Column:
    return F.concat_ws("-", field, func)


def index_name(table_name: Column) -> Column:
    return F.lower(table_name)
