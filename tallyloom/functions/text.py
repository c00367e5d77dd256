"""Text splitting where trailing empty parts do not count."""

from pyspark.sql import Column, DataFrame, functions as F


def parts(text: Column, sep: str) -> Column:
    """Split on the one-character ``sep`` and drop empty parts at the end.

    A text made of separators only has no parts at all; the empty text has one.
    """
    body = F.rtrim(text, F.lit(sep))
    return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, sep, -1)
    )


def whole_number(text: Column, type_name: str) -> Column:
    """Text that is an optionally signed run of digits, as an integer; NULL otherwise.

    The digits are checked first because a Spark cast would also accept blanks around them.
    """
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast(type_name))


def strip_controls(text: Column) -> Column:
    """Drop blanks and control characters at both ends."""
    return F.btrim(text, F.lit("".join(map(chr, range(0x21)))))


def settled(df: DataFrame, others: list[str], **columns: Column) -> DataFrame:
    """``others`` and the new ``columns``, which a later filter does not take apart.

    A filter on a parsed column would be pushed below the projections that compute it,
    and repeat their expressions once per use. It is not pushed through ``inline``.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*others, F.inline(F.array(row)))
