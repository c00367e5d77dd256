"""Keep results whose value passes a limit."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.text import settled


def passes(value: Column, operator: Column, limit: Column) -> Column:
    """``value operator limit`` with the operator as data; NULL for an unknown operator."""
    # fixed values: the comparison operators
    return (
        F.when(operator == "=", value == limit)
        .when(operator == "!=", value != limit)
        .when(operator == ">=", value >= limit)
        .when(operator == "<=", value <= limit)
        .when(operator == ">", value > limit)
        .when(operator == "<", value < limit)
    )


def over_limit(results: DataFrame, operator: str, limit: str) -> DataFrame:
    """Results that pass the limit in their own row; ``operator`` and ``limit`` name columns."""
    verdict = passes(F.col("value"), F.col(operator), F.col(limit))
    return settled(results, results.columns, _passes=verdict).filter("_passes").drop("_passes")
