"""File listings as DataFrames: names, months from names, completeness; inputs below a folder."""

from __future__ import annotations

from collections.abc import Sequence
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_IN_NAME = r"-(\d+)\.parquet$"

class MissingFiles(FileNotFoundError):
    """Expected input files are absent."""


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_month(path: Column) -> Column:
    """Month number from a name such as ``trips_2019-07.parquet``; NULL if the name has none."""
    return F.nullif(F.regexp_extract(path, MONTH_IN_NAME, 1), F.lit("")).cast("int")


def list_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, file, month, length) of the files below the paths; the contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    return listed.select("path", file_name(F.col("path")).alias("file"), file_month(F.col("path")).alias("month"), "length")


def monthly_names(prefix: str, year: int) -> list[str]:
    return [f"{prefix}{year}-{month:02d}.parquet" for month in range(1, 13)]


def missing_files(spark: SparkSession, listed: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected names that are not in the listing."""
    wanted = spark.createDataFrame([(name,) for name in expected], "file string")
    return wanted.join(listed.select("file").distinct(), "file", "left_anti")


def require_files(spark: SparkSession, directory: str, expected: Sequence[str], pattern: str = "*") -> list[str]:
    """Paths of the expected files in the given order; raises naming those that are absent."""
    listed = list_files(spark, directory, pattern)
    missing = sorted(row.file for row in missing_files(spark, listed, expected).collect())
    if missing:
        raise MissingFiles(f"{len(missing)} of {len(expected)} files missing: {', '.join(missing)}")
    found = listed.where(F.col("file").isin(*expected)).select("file", "path").collect()
    paths = {row.file: row.path for row in found}
    return [paths[name] for name in expected]


def input_paths(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.parquet") -> list[str]:
    """Inputs at the paths in order: a path whose name matches is one (a file, or a folder of part files); any other is a
    folder, whose matching entries are. Listed by the Hadoop file system of each path, whatever store that is."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        if fnmatch(path.rstrip("/").rsplit("/", 1)[-1], pattern):
            found.append(path)
            continue
        glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
        entries = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
        found += sorted(entry.getPath().toString() for entry in entries or ())
    return found


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The part files of an input in order of their paths: the file itself, or what lies below the folder, listed by Spark.

    Names that Spark's readers pass over (a leading underscore or dot) are no parts.
    """
    return sorted(row.path for row in list_files(spark, path).select("path").collect())
