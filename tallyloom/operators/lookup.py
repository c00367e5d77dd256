"""Widen events from a dimension table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def last_rows(dimension: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str | None) -> DataFrame:
    """One row per key: of several the last by ``order`` holds, then the largest by value.

    ``max_by`` reduces every key before the shuffle, so a key with very many rows is no
    hot spot.
    """
    values = F.struct(*columns)
    rank = F.struct(*([order] if order else []), *columns)
    return (
        dimension.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.max_by(values, rank).alias("_ext"))
    )


def widen(
    indicators: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    extend: Sequence[str],
    order: str | None = None,
    unique: bool = False,
    small: bool = False,
) -> DataFrame:
    """Left join the dimension and put its ``extend`` columns into the field map.

    ``on`` maps event fields to dimension columns; all are compared as text, and a
    missing or NULL field matches nothing. A match overwrites equal names, with NULLs
    too; no match leaves the event as it is. ``unique`` says the keys are unique, which
    spares the reduction to the last row. It is not checked: where it is wrong, events
    are multiplied.

    ``small`` has the dimension broadcast: for a source that holds to a bound by itself and whose
    size Spark does not know. Otherwise there is no hint: Spark broadcasts the dimension when it knows it to be below
    ``spark.sql.autoBroadcastJoinThreshold`` (from statistics, or at run time from the
    size of the reduced rows), and splits skewed keys of a shuffled join otherwise.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    text = dimension.select(
        *[F.col(right).cast("string").alias(key) for key, right in zip(keys, on.values())],
        *[F.col(c).cast("string").alias(f"_e{i}") for i, c in enumerate(extend)],
        *([F.col(order).alias("_order")] if order else []),
    )
    columns = [f"_e{i}" for i in range(len(extend))]
    if unique:
        side = text.dropna(subset=keys).select(*keys, F.struct(*columns).alias("_ext"))
    else:
        side = last_rows(text, keys, columns, "_order" if order else None)
    # events without a value match nothing, but in a shuffled join they would all meet in one task:
    # they are dealt out by their content instead
    content = F.xxhash64("event_ms", F.map_values("fields")).cast("string")
    asked = [F.col("fields")[left] for left in on]
    matches = [
        (F.coalesce(value, content) == F.col(key)) & value.isNotNull() for key, value in zip(keys, asked)
    ]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    joined = indicators.join(F.broadcast(side) if small else side, condition, "left")
    added = F.map_from_arrays(
        F.array(*[F.lit(c) for c in extend]), F.array(*[F.col(f"_ext.{c}") for c in columns])
    )
    names = F.array(*[F.lit(c) for c in extend])
    kept = F.when(
        F.arrays_overlap(F.map_keys("fields"), names),
        F.map_filter("fields", lambda k, v: ~F.array_contains(names, k)),
    ).otherwise(F.col("fields"))
    merged = F.when(F.col("_ext").isNotNull(), F.map_concat(kept, added)).otherwise(F.col("fields"))
    return joined.withColumn("fields", merged).select(*indicators.columns)


def read_dimension(
    spark: SparkSession, url: str, table: str, on: Mapping[str, str], extend: Sequence[str],
    properties: dict[str, str], order: str | None = None,
) -> DataFrame:
    """The key, extend and order columns of a database table; the source reads no others.

    ``order`` is the column by which ``widen`` takes the last of several rows.

    A stream joined with it reads it again in every micro-batch, so a change shows
    within one trigger interval.
    """
    return spark.read.jdbc(url, table, properties=properties).select(
        *dict.fromkeys([*on.values(), *extend, *([order] if order else [])])
    )
