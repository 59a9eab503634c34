"""Reading many files into the columns and types of the first one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import read_parts, read_schemas


class MissingColumns(ValueError):
    """A part lacks a column of the pinned schema."""


def pin(part: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; further columns are dropped, absent ones raise."""
    absent = [name for name in schema.names if name not in part.columns]
    if absent:
        raise MissingColumns(f"columns not found: {', '.join(absent)}")
    return part.select(*[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in schema.fields])


def unite_pinned(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of the parts, in the columns and types of the first part."""
    schema = parts[0].schema
    return reduce(DataFrame.unionByName, [pin(part, schema) for part in parts])


def ingest_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet inputs in the columns and types of the first one (of its first part, if the parts of a folder differ).

    Every part file is looked at, by its footer. Inputs and parts that store the pinned columns alike, which usually all do,
    are read in one scan; otherwise there is one scan for each kind (and folder, if its parts differ), not one for each part.
    """
    found = read_schemas(spark, paths, "*")
    if not found:
        return spark.read.parquet(*paths)  # which says what is wrong with them
    schema = found[0].schema
    wanted = set(schema.names)
    kinds: dict[tuple, list[str]] = {}
    for item in found:
        folder = item.source if item.source != item.path else None
        kinds.setdefault((folder, frozenset(pair for pair in item.fields if pair[0] in wanted)), []).append(item.path)
    return reduce(DataFrame.unionByName, [pin(read_parts(spark, parts, folder), schema) for (folder, _), parts in kinds.items()])


def ingest_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)
