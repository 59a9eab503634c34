"""Independent jobs at the same time, so that a small job does not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

MAX_JOBS = 8


def side_by_side(spark: SparkSession, calls: Sequence[Callable]) -> list:
    """Results of the calls in order; each runs in a thread that keeps the caller's job settings and open blocks of copies."""
    with ThreadPoolExecutor(min(MAX_JOBS, len(calls))) as pool:
        waiting = [pool.submit(copy_context().run, inheritable_thread_target(spark)(call)) for call in calls]
        return [future.result() for future in waiting]


def union_of(spark: SparkSession, calls: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """United rows of tables whose building runs jobs of its own."""
    return reduce(DataFrame.unionByName, side_by_side(spark, calls))
