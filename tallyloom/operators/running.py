"""Running values after each event, and look-back sums, without one task per group.

A window function over a whole group sorts the group in one task. Here each group is cut into
parts by a function of the row that rises with the order, a stretch of time say, so that a
large group spans many tasks; within a part a window function does the work, and each part
then adds what the parts before it hold for the same group. A row's part is the same in every
run, so nothing is sampled or written down, and a lost executor changes nothing.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.numbers import mean
from tallyloom.functions.windows import lookback_start
from tallyloom.model import NUMBER, TOTAL
from tallyloom.operators.aggregate import measured

# into how many parts a group's window is cut
STRETCHES = 256


def stretch(ms: Column, size_ms: Column) -> Column:
    """Number of the stretch of time that holds ``ms``, :data:`STRETCHES` to a window."""
    return F.floor(ms * STRETCHES / size_ms).cast("bigint")


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, tuple[str, str]],
    part_of: Column,
) -> DataFrame:
    """Add running totals in ``order`` within ``group``; ``totals`` is name -> (sum|min|max, column).

    ``order`` must be unique within a group, and ``part_of`` must never fall along it. The rows are shuffled once,
    by group and part; totals of parts (one row per group and part) are all that moves after that.
    """
    placed = df.withColumn("_part", part_of).repartition(*group, "_part")
    part = [*group, "_part"]
    within = (
        Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    before = (
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    per_part = placed.groupBy(*part).agg(
        *[_MERGE[how](column).alias(f"_all_{name}") for name, (how, column) in totals.items()]
    )
    carried = per_part.select(
        *part,
        *[_MERGE[how](f"_all_{name}").over(before).alias(f"_carry_{name}") for name, (how, _) in totals.items()],
    )
    rows = placed.select(
        "*", *[_MERGE[how](column).over(within).alias(f"_in_{name}") for name, (how, column) in totals.items()]
    )
    joined = rows.join(carried, part)
    combine = {
        "sum": lambda a, b: a + F.coalesce(b, F.lit(0)),
        "min": F.least,
        "max": F.greatest,
    }
    return joined.select(
        *df.columns,
        *[combine[how](F.col(f"_in_{name}"), F.col(f"_carry_{name}")).alias(name) for name, (how, _) in totals.items()],
    )


_SERIES = ["rule_id", "table_name", "grouping_keys", "grouping_values"]


def _widened(rows: DataFrame) -> DataFrame:
    """Exact values with 0 where the decimal type cannot hold the number, and that number as a double beside it."""
    return rows.withColumns(
        {
            "_exact": F.coalesce("value", F.lit(0).cast(NUMBER)),
            "_one": F.lit(1).cast("bigint"),
            "_over": F.col("wide").isNotNull().cast("bigint"),
            "_wide": F.coalesce("wide", F.lit(0.0)),
        }
    )


def _approximate(done: DataFrame, wide: dict[str, Column]) -> DataFrame:
    """``approx`` with every figure as a double where numbers beyond the decimal type take part, and the
    figures themselves as far as they fit then."""
    beyond = F.col("n_overflow") > 0
    done = done.withColumn("approx", F.when(beyond, F.struct(*[c.alias(name) for name, c in wide.items()])))
    return done.withColumns(
        {name: F.when(beyond, F.col(f"approx.{name}").try_cast(TOTAL)).otherwise(F.col(name).cast(TOTAL)) for name in wide}
    )


def running_values(forked: DataFrame, event_id: str) -> DataFrame:
    """What every group holds after each of its events, in order of time, then id.

    Totals are exact decimals. Numbers that the type cannot hold are added up as doubles beside them: from the
    first of them on, ``approx`` (total, low, high, average) has the figures over all numbers, and
    ``n_overflow`` says how many there were.
    """
    rows = _widened(measured(forked, "event_ms", event_id))
    done = running(
        rows,
        [*_SERIES, "window_start_ms", "window_end_ms", "field"],
        ["event_ms", event_id],
        {
            "total": ("sum", "_exact"), "n": ("sum", "_one"), "low": ("min", "value"), "high": ("max", "value"),
            "n_overflow": ("sum", "_over"), "wide_total": ("sum", "_wide"), "wide_low": ("min", "wide"), "wide_high": ("max", "wide"),
        },
        stretch(F.col("event_ms") - F.col("window_start_ms"), F.col("window_end_ms") - F.col("window_start_ms")),
    )
    done = done.withColumn("total", F.col("total").cast(TOTAL)).withColumn("average", mean(F.col("total"), F.col("n")))
    total = F.col("total").cast("double") + F.col("wide_total")
    done = _approximate(
        done,
        {
            "total": total, "low": F.least(F.col("low").cast("double"), "wide_low"),
            "high": F.greatest(F.col("high").cast("double"), "wide_high"), "average": total / F.col("n"),
        },
    )
    return done.drop("_one", "_exact", "_over", "_wide", "wide", "wide_total", "wide_low", "wide_high", "funcs")


def _wide_lookback(values: DataFrame, asks: DataFrame, series: Sequence[str]) -> DataFrame:
    """For each time ``at_ms`` of ``asks`` the sum of ``wide`` of ``values`` from a window's length before it up to it.

    Nothing is subtracted, so a huge number leaves no trace once it is out of the window. Time is cut into
    blocks of the window's length: the window is the end of one block and the beginning of the next, a running
    sum backwards and one forwards.
    """
    size = F.col("size_ms")
    sides = []
    for sign, before in ((1, F.lit(0)), (-1, size)):
        at = F.col("at_ms") - before
        points = values.select(*series, "at_ms", "wide", F.lit(None).cast("bigint").alias("_asked")).unionByName(
            asks.select(*series, at.alias("at_ms"), F.lit(0.0).alias("wide"), F.col("at_ms").alias("_asked"))
        )
        # at one time, values come before those that ask
        place = F.col("at_ms") * (2 * sign) + F.col("_asked").isNotNull().cast("bigint")
        points = points.withColumns({"_block": F.floor(F.col("at_ms") / size), "_place": place})
        done = running(points, [*series, "_block"], ["_place"], {"sum": ("sum", "wide")}, stretch(F.col("at_ms") * sign, size))
        sides.append(done.filter(F.col("_asked").isNotNull()).select(*series, F.col("_asked").alias("at_ms"), "sum"))
    return sides[0].unionByName(sides[1]).groupBy(*series, "at_ms").agg(F.sum("sum").alias("wide_total"))


def lookback_values(forked: DataFrame, wide: bool = False) -> DataFrame:
    """Sum, count and mean over the window that ends at each event time of a series.

    The window holds the times from ``t - size`` to ``t``, both included. A value that
    enters at its own time leaves one millisecond after ``t + size``; with entries and
    exits added up per time first, the running total is the look-back total, whatever
    the window length and however many events share a time.

    ``n_overflow`` says how many numbers of a window the decimal type cannot hold. The total and mean of such a window
    are null, unless ``wide`` asks for them: then ``approx`` (total, average) has them as doubles over
    all its numbers, and the columns as far as they fit. That takes two more passes over those series' rows.
    """
    size = F.col("window_end_ms") - F.col("window_start_ms")
    rows = _widened(measured(forked, "event_ms")).withColumn("size_ms", size)
    series = [*_SERIES, "field", "size_ms"]
    steps: list[Column] = [
        F.struct(
            F.col("event_ms").alias("at_ms"), F.col("_exact").cast(TOTAL).alias("v"), F.lit(1).alias("d"),
            F.col("_over").alias("o"), F.lit(1).alias("own"),
        ),
        F.struct(
            (F.col("event_ms") + F.col("size_ms") + 1).alias("at_ms"), (-F.col("_exact")).cast(TOTAL).alias("v"),
            F.lit(-1).alias("d"), (-F.col("_over")).alias("o"), F.lit(0).alias("own"),
        ),
    ]
    changes = (
        rows.select(*series, F.inline(F.array(*steps)))
        .groupBy(*series, "at_ms")
        .agg(F.sum("v").cast(TOTAL).alias("v"), F.sum("d").alias("d"), F.sum("o").alias("o"), F.max("own").alias("own"))
    )
    done = running(
        changes, series, ["at_ms"], {"total": ("sum", "v"), "n": ("sum", "d"), "n_overflow": ("sum", "o")},
        stretch(F.col("at_ms"), F.col("size_ms")),
    )
    done = done.filter(F.col("own") == 1).withColumn("total", F.col("total").cast(TOTAL))
    done = done.withColumn("average", mean(F.col("total"), F.col("n")))
    if wide:
        values = rows.filter(F.col("wide").isNotNull()).groupBy(*series, F.col("event_ms").alias("at_ms")).agg(F.sum("wide").alias("wide"))
        asks = done.filter("n_overflow > 0").select(*series, "at_ms")
        done = done.join(_wide_lookback(values, asks, series), [*series, "at_ms"], "left")
        total = F.col("total").cast("double") + F.col("wide_total")
    else:
        total = F.lit(None).cast("double")
    done = _approximate(done, {"total": total, "average": total / F.col("n")})
    return done.select(
        *_SERIES,
        "field",
        lookback_start(F.col("at_ms"), F.col("size_ms")).alias("from_ms"),
        F.col("at_ms").alias("event_ms"),
        "total",
        "n",
        "average",
        "n_overflow",
        "approx",
    )
