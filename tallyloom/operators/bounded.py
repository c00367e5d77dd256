"""Joins with a side that is broadcast only after its size has been checked."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MIN_SALTS = 32


class Size(NamedTuple):
    """What a size check found; ``most`` is only known of a small side."""

    small: bool
    most: int | None


def check_size(
    df: DataFrame,
    most: Column | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> Size:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` of JSON text.

    Runs one job that looks at no more than ``max_rows + 1`` rows. ``most`` asks for the
    largest value of an expression on the way.
    """
    rows, size, largest = (
        df.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)),
            F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint")),
            F.max(F.lit(0) if most is None else most),
        )
        .first()
    )
    small = rows <= max_rows and (size or 0) <= max_bytes
    return Size(small, (largest or 0) if small and most is not None else None)


def join_small(
    big: DataFrame,
    small: DataFrame,
    key: str,
    residual: Column,
    salt_of: Sequence[Column],
    small_enough: bool,
) -> DataFrame:
    """Inner join on ``key`` and ``residual``.

    A side that :func:`check_size` found small is broadcast. A larger one is joined by a shuffle in which every key
    is spread over as many parts of ``big`` as there are shuffle partitions (by a hash
    of ``salt_of``, so a rerun task puts each row in the same part) and ``small`` is
    repeated once per part: a key with a third of all rows then still keeps a third of
    the cluster busy. Either way each pair
    comes out exactly once.
    """
    small = small.withColumnRenamed(key, "_key")
    match = (F.col(key) == F.col("_key")) & residual
    if small_enough:
        return big.join(F.broadcast(small), match).drop("_key")
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(MIN_SALTS, partitions)
    salt_values = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_of), F.lit(salts)))
    right = small.withColumn("_part", F.explode(salt_values))
    return left.join(
        right.hint("shuffle_hash"), match & (F.col("_salt") == F.col("_part"))
    ).drop("_key", "_salt", "_part")
