"""Any DataFrame as events."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.windows import epoch_ms


def indicators_from_table(
    df: DataFrame,
    table_name: Column | str,
    ts: Column | str,
    fields: Mapping[str, Column | str] | Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of a table as events.

    Name only the fields some rule needs: the map is not pruned, so every further
    column is read and carried. ``keep`` passes columns on unchanged (an event id).
    """
    if not isinstance(fields, Mapping):
        fields = {name: name for name in fields}
    entries = [
        part
        for name, column in fields.items()
        for part in (F.lit(name), _column(column).cast("string"))
    ]
    ts = _column(ts).cast("timestamp")
    return df.select(
        _column(table_name).cast("string").alias("table_name"),
        F.create_map(*entries).alias("fields"),
        epoch_ms(ts).alias("event_ms"),
        ts.alias("event_time"),
        *keep,
    )


def columns_as_events(
    df: DataFrame, table_name: Column | str, ts: Column | str, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of a table as events that keep their fields in columns, without a map."""
    ts = _column(ts).cast("timestamp")
    return df.select(
        _column(table_name).cast("string").alias("table_name"),
        epoch_ms(ts).alias("event_ms"),
        ts.alias("event_time"),
        *columns,
        *keep,
    )


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to all cores if the source comes in fewer pieces than there are cores.

    For small inputs, say one file of one row group. A large table has more pieces than
    cores and is left as it is: no shuffle. Spark sorts rows before dealing them out, so a
    task that is run again gets the same rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
