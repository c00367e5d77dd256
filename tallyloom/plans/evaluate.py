"""The evaluation: events and rules in, results out."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.fields import FieldColumns, FieldMap, Fields
from tallyloom.operators.aggregate import finish, partials, partials_of_rules
from tallyloom.operators.asof import fork_asof, rule_versions
from tallyloom.operators.bounded import check_size
from tallyloom.operators.fork import fork, matcher
from tallyloom.sources.tables import columns_as_events

# Up to this many fields of a rule are aggregated side by side.
_MAX_FIELDS = 4


def evaluate(
    indicators: DataFrame,
    rules: DataFrame,
    keyless: str = "running",
    small_rules: bool | None = None,
    fields: Fields = FieldMap(),
) -> DataFrame:
    """Every active rule over every event, as long results."""
    forked = fork(indicators, rules, small_rules, fields)
    if small_rules is None and "epoch" not in rules.columns:
        side = matcher(rules)
        most = check_size(side, F.size("wanted")).most
        if 0 < (most or 0) <= _MAX_FIELDS:
            return finish(partials_of_rules(forked, side, most, keyless, fields))
    return finish(partials(forked, keyless, fields=fields))


def evaluate_table(
    df: DataFrame,
    table_name: Column | str,
    ts: Column | str,
    columns: Sequence[str],
    rules: DataFrame,
    keyless: str = "running",
    small_rules: bool | None = None,
) -> DataFrame:
    """Every active rule over the rows of a table, whose columns are the fields."""
    rows = columns_as_events(df, table_name, ts, columns)
    return evaluate(rows, rules, keyless, small_rules, FieldColumns(rows, columns))


def replay(events: DataFrame, changes: DataFrame, keyless: str = "running") -> DataFrame:
    """Events and rule changes in one common order of ``seq``, as long results.

    Every event meets the rules as they stood when it came.
    """
    return finish(partials(fork_asof(events, rule_versions(changes)), keyless))
