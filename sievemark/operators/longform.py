"""Turning same-typed columns into (column id, value) rows so that one scan serves all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(values: Sequence[float | int | str | None], index: Column, type_name: str) -> Column:
    """The entry of a short literal list at a zero-based index column."""
    return F.element_at(F.array(*[F.lit(value).cast(type_name) for value in values]), index + 1)


def stack_columns(df: DataFrame, columns: Sequence[Column], value_name: str = "v") -> DataFrame:
    """Rows (c, value) for every non-NULL entry of same-typed columns; ``c`` is the position in the list."""
    pairs = [part for c, column in enumerate(columns) for part in (F.lit(c), column)]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("c", value_name)).where(F.col(value_name).isNotNull())
