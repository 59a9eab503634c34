"""Schema inventory, drift between files and agreement between file types and table types."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quoted, type_family
from ..functions.concurrent import MAX_JOBS, side_by_side
from .files import input_paths, part_files

# Table types accepted for a file type. A file type not listed matches only its own name.
TABLE_TYPES = {
    "INT64": ("BIGINT", "INTEGER", "INT", "INT8"),
    "DOUBLE": ("DOUBLE", "FLOAT", "REAL", "DECIMAL", "NUMERIC"),
    "STRING": ("VARCHAR", "TEXT", "STRING"),
    "DATE32[DAY]": ("DATE",),
    "TIMESTAMP[US]": ("TIMESTAMP", "DATETIME", "TIMESTAMP_NTZ"),
    "BOOLEAN": ("BOOLEAN", "BOOL"),
}

# Fixed value: where Spark notes down its own types in a file.
SPARK_SCHEMA_KEY = "org.apache.spark.sql.parquet.row.metadata"

# Names of file types that differ from Spark's names.
FILE_TYPES = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "date": "date32[day]",
    "timestamp": "timestamp[us]",
    "timestamp_ntz": "timestamp[us]",
}


def table_type(data_type: T.DataType) -> str:
    return data_type.simpleString().upper()


def types_of(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Types of a column subset, in table order."""
    wanted = set(columns)
    return {field.name: table_type(field.dataType) for field in df.schema.fields if field.name in wanted}


def inventory(df: DataFrame, table: str) -> DataFrame:
    """One row per column of a table: position, type family and number of non-NULL values (one scan)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(quoted(field.name)).alias(f"n_{k}") for k, field in enumerate(fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(k).alias("column_index"),
                F.lit(field.name).alias("column_name"),
                F.lit(type_family(field.dataType)).alias("type_family"),
                F.col(f"n_{k}").alias("non_null_count"),
            )
            for k, field in enumerate(fields)
        ]
    )
    return counts.select(F.inline(entries))


@dataclass(frozen=True)
class FileSchema:
    """Columns of an input (a file or a folder of part files), or of one part of a folder whose parts differ, as Spark reads
    them, with file type names."""

    path: str
    fields: tuple[tuple[str, str], ...]
    row_count: int | None = None
    source: str | None = None  # the input that the part belongs to
    schema: T.StructType | None = field(default=None, compare=False)

    @property
    def file(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


@dataclass(frozen=True)
class Footer:
    """What a part file says about itself: its schema as text, and its number of rows."""

    path: str
    schema: str
    row_count: int


def read_footers(spark: SparkSession, paths: Sequence[str]) -> list[Footer]:
    """Footers of part files, read side by side through the file system of each path; no rows are read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def read(part: Sequence[str]) -> list[Footer]:
        found = []
        for path in part:
            file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
            try:
                meta = reader.getFileMetaData()
                # The columns, and the types that Spark notes down where the file format has none of its own.
                noted = meta.getKeyValueMetaData().get(SPARK_SCHEMA_KEY)
                found.append(Footer(path, f"{meta.getSchema().toString()}{noted or ''}", reader.getRecordCount()))
            finally:
                reader.close()
        return found

    shares = [share for share in (paths[at::MAX_JOBS] for at in range(MAX_JOBS)) if share]
    by_path = {footer.path: footer for share in side_by_side(spark, [partial(read, share) for share in shares]) for footer in share} if shares else {}
    return [by_path[path] for path in paths]


def file_type(data_type: T.DataType) -> str:
    """Name of the type that a file stores for a Spark type."""
    name = data_type.simpleString()
    return FILE_TYPES.get(name, name)


def read_schemas(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.parquet") -> list[FileSchema]:
    """Schemas and row counts of all inputs at the paths.

    Footers of part files are grouped by what they say; a folder whose parts all agree is one input, and one whose parts differ
    is taken apart: its parts are inputs of their own. Spark reads one part of each kind to name the types.
    """
    inputs = [(path, part_files(spark, path)) for path in input_paths(spark, paths, pattern)]
    footers = iter(read_footers(spark, [part for _, parts in inputs for part in parts]))
    grouped = [(path, [next(footers) for _ in parts]) for path, parts in inputs]
    # One part stands for all parts of its folder with the same footer; where all agree, the folder does.
    kinds: dict[tuple[str, str], str] = {}
    for path, held in grouped:
        differ = len({footer.schema for footer in held}) > 1
        for footer in held:
            kinds.setdefault((path, footer.schema), footer.path if differ else path)
    reads = [partial(_schema_of, spark, part, path) for (path, _), part in kinds.items()]
    schemas = dict(zip(kinds, side_by_side(spark, reads))) if reads else {}

    def described(path: str, source: str, footer: Footer, rows: int) -> FileSchema:
        schema = schemas[source, footer.schema]
        return FileSchema(path, tuple((item.name, file_type(item.dataType)) for item in schema.fields), rows, source, schema)

    found = []
    for path, held in grouped:
        if len({footer.schema for footer in held}) > 1:
            found += [described(footer.path, path, footer, footer.row_count) for footer in held]
        elif held:
            found.append(described(path, path, held[0], sum(footer.row_count for footer in held)))
    return found


def _schema_of(spark: SparkSession, part: str, source: str) -> T.StructType:
    return read_parts(spark, [part], source).schema


def read_parts(spark: SparkSession, parts: Sequence[str], source: str | None) -> DataFrame:
    """Rows of inputs, or of some parts of one folder with the columns that its folder names add."""
    inside = source is not None and list(parts) != [source]
    return (spark.read.option("basePath", source) if inside else spark.read).parquet(*parts)


def reference_of(found: Sequence[FileSchema], reference: str) -> FileSchema:
    """The input with this path, or the only one with this file name; of a folder whose parts differ, the first part."""
    same = [item for item in found if item.path == reference] or [item for item in found if item.file == reference]
    if not same:
        parts = [item for item in found if item.source and reference in (item.source, item.source.rstrip("/").rsplit("/", 1)[-1])]
        same = parts[:1] if len({item.source for item in parts}) == 1 else []
    if len(same) != 1:
        raise ValueError(f"{len(same)} inputs are called {reference}")
    return same[0]


def drift(
    spark: SparkSession, found: Sequence[FileSchema], reference: str, rename: Callable[[str], str] = lambda name: name
) -> DataFrame:
    """Differences of every input's (name, type) pairs from the reference's, regardless of order.

    ``missing`` pairs are only in the reference, ``extra`` only in the input; a changed type gives one of each. Inputs are
    told apart by their paths. ``rename`` maps column names before comparing. Schemas are small and stay on the driver.
    """
    base = reference_of(found, reference)
    pairs = {item.path: {(rename(name), kind): None for name, kind in item.fields} for item in found}
    expected, rows = pairs[base.path], []
    for item in found:
        if item.path != base.path:
            own = pairs[item.path]
            for mismatch, wanted, held in (("missing", expected, own), ("extra", own, expected)):
                rows += [(item.path, item.file, mismatch, *pair, item.row_count) for pair in wanted if pair not in held]
    return spark.createDataFrame(
        rows, "path string, file string, mismatch string, column_name string, parquet_type string, row_count bigint"
    )


def drift_summary(found: Sequence[FileSchema], mismatches: DataFrame, reference: str) -> dict:
    """File count, columns of the reference and whether all files agree."""
    base = reference_of(found, reference)
    return {
        "file_count": len(found),
        "reference_file": base.file,
        "column_count": len(base.fields),
        "all_match": mismatches.isEmpty(),
    }


def _candidate_map() -> Column:
    pairs = []
    for file_type, accepted in TABLE_TYPES.items():
        pairs += [F.lit(file_type), F.array(*[F.lit(name) for name in accepted])]
    return F.create_map(*pairs)


def type_matches(file_type: Column, stored_type: Column) -> Column:
    """Whether a table type can hold a file type: by the accepted list, where parameters of the type are ignored; a file
    type that is not listed matches its own name only."""
    wanted, stored = F.upper(F.trim(file_type)), F.upper(F.trim(stored_type))
    accepted = _candidate_map()[wanted]
    base = F.regexp_extract(stored, r"^([^(]*)", 1)
    listed = F.array_contains(accepted, stored) | F.array_contains(accepted, base)
    present = (F.length(wanted) > 0) & (F.length(stored) > 0)
    return F.coalesce(present & F.when(accepted.isNotNull(), listed).otherwise(wanted == stored), F.lit(False))


def compare_types(file_types: DataFrame, stored: Mapping[str, str]) -> DataFrame:
    """(column_name, file_type, table_type, match) over the union of both name sets."""
    spark = file_types.sparkSession
    table = spark.createDataFrame(list(stored.items()), "column_name string, table_type string")
    joined = file_types.join(table, "column_name", "full_outer")
    return joined.withColumn("match", type_matches(F.col("file_type"), F.col("table_type")))


def schema_types(schema: T.StructType, spark) -> DataFrame:
    """(column_name, file_type) of a schema read from a file, with the file type names of ``TABLE_TYPES``."""
    rows = [(field.name, file_type(field.dataType)) for field in schema.fields]
    return spark.createDataFrame(rows, "column_name string, file_type string")


def all_match(comparison: DataFrame) -> bool:
    return comparison.where(~F.col("match")).isEmpty()
