"""References to columns by name, and families of their types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever dots or backticks it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_family(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "text" if isinstance(data_type, T.StringType) else "other"
