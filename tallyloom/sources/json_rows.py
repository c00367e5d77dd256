"""Rows as JSON text, both ways."""

from pyspark.sql import DataFrame, functions as F, types as T

_BAD = "_unreadable"


def from_json_rows(df: DataFrame, schema: T.StructType, column: str = "json") -> DataFrame:
    """Typed columns out of JSON text plus ``error``; the other columns stay."""
    full = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    row = F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    others = [c for c in df.columns if c != column]
    return df.select(*others, column, row.alias("_row")).select(
        *others,
        "_row.*",
        F.when(F.col("_row").isNull() | F.col(f"_row.{_BAD}").isNotNull(), "bad json").alias("error"),
    ).drop(_BAD)


def to_json_rows(df: DataFrame, column: str = "json") -> DataFrame:
    """Every row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(column))
