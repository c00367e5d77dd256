"""Numbers out of event text, and the rounded mean."""

from pyspark.sql import Column, functions as F

from tallyloom.model import NUMBER, TOTAL


def as_double(text: Column) -> Column:
    """Text as a double with its quotes dropped; NULL where it is no number."""
    return F.replace(text, F.lit('"'), F.lit("")).try_cast("double")


def number(decimal: Column) -> Column:
    """A field's number, where anything unreadable counts as 0.

    Not-a-number, infinities, missing values and plain words arrive as NULL and read as
    0. A finite number that the type cannot hold is for :func:`overflows`. More than
    eight decimals have been rounded.
    """
    return F.coalesce(decimal, F.lit(0).cast(NUMBER))


def overflows(decimal: Column, double: Column) -> Column:
    """True for a finite number that the type cannot hold: too large, or so small that it reads as 0.

    The double is not looked at for an ordinary number.
    """
    finite = F.coalesce(F.abs(double) < F.lit(float("inf")), F.lit(False))
    return (decimal.isNull() | (decimal == 0)) & finite & (decimal.isNull() | (double != 0))


def mean(total: Column, count: Column) -> Column:
    """``total / count`` rounded once to four decimals, halves away from zero; 0 when empty.

    A plain decimal division followed by ``round`` would round twice. In whole units of
    1e-8, ``floor((2 * units + 10000 * n) / (20000 * n))`` is the mean in units of 1/10000,
    halves up; that fits a BIGINT for sums below 9e9, the usual case. The expression is
    kept short: it shares a generated method with the aggregate, and the JVM does not
    compile methods beyond 8000 bytes.
    """
    n = F.greatest(count, F.lit(1))
    size = F.abs(total)
    units = (size.cast("decimal(18,8)") * F.lit(10**8)).cast("bigint")
    ticks = F.call_function("div", units * 2 + n * 10_000, n * 20_000)
    usual = ticks.cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(4,4)")
    rounded = F.when(size < F.lit(9 * 10**9), usual.cast(TOTAL)).otherwise(
        _mean_of_large(size, n.cast("decimal(19,0)"))
    )
    return F.when(total < 0, -rounded).otherwise(rounded)


def _mean_of_large(size: Column, n: Column) -> Column:
    """Take off what is left over after whole steps of 1/10000, divide the rest exactly, round up or not."""
    step = (n * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(23,4)")
    left = size % step
    whole = ((size.try_cast("decimal(37,8)") - left) / n).cast("decimal(37,4)")
    up = F.when(left * 2 >= step, F.lit("0.0001")).otherwise(F.lit("0")).cast("decimal(4,4)")
    return F.coalesce((whole + up).cast(TOTAL), F.round(size / n, 4).cast(TOTAL))
