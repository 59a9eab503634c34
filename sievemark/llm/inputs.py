"""What the text operators share: reading tables, and making this package importable in Python workers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package also if the session was started in another folder."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


_HELD: dict[tuple[str, object], object] = {}


def held(owner: str, key: object, make: Callable[[], object]):
    """What an operator keeps between the batches of a Python worker, made when it is first asked for.

    Workers live on from stage to stage. A worker holds one thing at a time, so what an earlier operator kept is freed, and
    its memory given back, when another one begins.
    """
    if (owner, key) not in _HELD:
        if _HELD:
            _HELD.clear()
            give_back()
        _HELD[owner, key] = make()
    return _HELD[owner, key]


def give_back() -> None:
    """Return freed memory to the system, which allocators keep otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the key and the text; other columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def with_columns(df: DataFrame, added: str, make: Callable[[list[str]], list[pa.Array]], rows: int = 1000) -> DataFrame:
    """The rows with columns that `make` gives for some texts at a time; `added` is their schema. Nothing is shuffled."""
    new = T.StructType.fromDDL(added)
    schema = T.StructType([f for f in df.schema.fields if f.name not in new.names] + new.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                kept = [name for name in batch.schema.names if name not in new.names]
                columns = [batch.column(name) for name in kept] + make(texts_of(batch))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new.names])

    return df.mapInArrow(run, schema)
