"""Where an event keeps its fields: in a map, or in columns of its own.

Rules name fields as data, so a field is looked up by a name that is itself a column.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.numbers import as_double
from tallyloom.model import NUMBER


class FieldMap:
    """Fields in one ``MAP<STRING, STRING>``: any names, as read from event lines."""

    columns = ["fields"]

    def text(self, name: Column) -> Column:
        return F.col("fields")[name]

    def double(self, name: Column) -> Column:
        return as_double(self.text(name))

    def decimal(self, name: Column) -> Column:
        """The field as a number, NULL where it is none or does not fit."""
        return self.double(name).try_cast(NUMBER)

    def all_present(self, required: Column) -> Column:
        return F.size(F.array_except(required, F.map_keys("fields"))) == 0

    def content(self) -> list[Column]:
        return [F.map_values("fields")]


class FieldColumns:
    """Fields in typed columns of a table, which then needs no map.

    The columns are picked by a CASE over the given names. Spark reads those columns
    only, and a number is not turned into text and back. Every named column counts as
    present in every row.
    """

    def __init__(self, df: DataFrame, names: Sequence[str]):
        self.columns = list(names)
        self._types = {name: df.schema[name].dataType for name in names}

    def _pick(self, name: Column, of: Callable[[Column, T.DataType], Column]) -> Column:
        chosen = None
        for column, kind in self._types.items():
            value = of(F.col(column), kind)
            chosen = F.when(name == column, value) if chosen is None else chosen.when(name == column, value)
        return chosen

    def text(self, name: Column) -> Column:
        return self._pick(name, lambda c, kind: c.cast("string"))

    def double(self, name: Column) -> Column:
        return self._pick(
            name,
            lambda c, kind: c.cast("double") if isinstance(kind, T.NumericType) else as_double(c.cast("string")),
        )

    def decimal(self, name: Column) -> Column:
        def value(c: Column, kind: T.DataType) -> Column:
            return (c if isinstance(kind, T.NumericType) else as_double(c.cast("string"))).try_cast(NUMBER)

        return self._pick(name, value)

    def all_present(self, required: Column) -> Column:
        return F.size(F.array_except(required, F.array(*[F.lit(c) for c in self.columns]))) == 0

    def content(self) -> list[Column]:
        return [F.col(c) for c in self.columns]


Fields = FieldMap | FieldColumns
