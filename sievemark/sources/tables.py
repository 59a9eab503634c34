"""Stored tables and intermediate results in shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Store a query result under a table name, replacing what was there.

    The result is written under a name of its own first and then takes the place of the old table, so the query may read the
    table it replaces, and a write that fails leaves the old table as it was.
    """
    spark = df.sparkSession
    fresh, old = _sibling(name), _sibling(name)
    try:
        df.write.saveAsTable(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        return spark.table(name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def _sibling(name: str) -> str:
    """A new table name in the same database."""
    database, _, table = name.rpartition(".")
    mark = f"{table.strip('`')}_{uuid.uuid4().hex[:12]}"
    return f"{database}.`{mark}`" if database else f"`{mark}`"


def ensure_table(spark: SparkSession, name: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The stored table, built first if it is missing (or always with ``refresh``)."""
    if refresh or not spark.catalog.tableExists(name):
        return replace_table(build(), name)
    return spark.table(name)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the checkpoint folder of the session, else its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch").rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder; inside a block of ``temporary_copies`` it is deleted with the block."""
    path = f"{shared_folder(spark)}/materialised/{uuid.uuid4().hex}"
    held = _OPEN.get()
    if held is not None:
        held.paths.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored copy through the file system it lies in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Copies:
    """Paths of the stored copies made in a block."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_OPEN: ContextVar[Copies | None] = ContextVar("open_copies", default=None)


@contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[Copies]:
    """A block whose stored copies are deleted at its end, also when it ends by an error.

    What the block returns must not read them any more: write it, or use ``stored_result``. Copies of a block inside belong to it.
    """
    copies = Copies()
    token = _OPEN.set(copies)
    try:
        yield copies
    finally:
        _OPEN.reset(token)
        for path in copies.paths:
            discard(spark, path)


def stored_result(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The result of a query that makes copies on its way: stored itself, it is the only copy left."""
    with temporary_copies(spark):
        df = build()
        path = f"{shared_folder(spark)}/materialised/{uuid.uuid4().hex}"
        try:
            df.write.parquet(path)
        except BaseException:
            discard(spark, path)
            raise
    held = _OPEN.get()
    if held is not None:
        held.paths.append(path)
    return spark.read.parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Write a result that several jobs will read to the shared folder as Parquet and return the stored copy.

    The copy is columnar, so later jobs read only their columns, and it does not depend on executors staying alive. It lives as
    long as the block of ``temporary_copies`` around it, or until the folder's owner clears it.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
