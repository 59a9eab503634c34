"""Connected components of links between rows."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.sources.tables import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """Component of nodes of undirected edges (a, b): node, component (its smallest node), for all nodes but these smallest.

    Each round links every node's neighbours to the smallest of them, first the larger ones and then the smaller ones,
    until no edge changes; a round stores its edges, so lineage stays short. The smallest neighbour is a partial sum
    before the shuffle, and a node with many neighbours is a skewed join key that adaptive execution can split.
    """
    stored = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = stored.union(stored.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        larger = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        smallest = larger.groupBy("a").agg(F.min("b").alias("low"))
        joined = larger.join(smallest, "a")
        smaller = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(joined.select("a", F.col("low").alias("b")))
        after = materialise(smaller.filter("a <> b").distinct())
        state = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if stored.inputFiles():
            discard(stored.sparkSession, stored.inputFiles()[0].rsplit("/", 1)[0])
        stored = after
        if before == state:
            break
        before = state
    return stored.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def roots(count: int, left: Iterable[int], right: Iterable[int]) -> np.ndarray:
    """Smallest reachable number for each of `count` numbered rows, given links between them (inside one task)."""
    root = np.arange(count)
    left, right = np.asarray(left, dtype=np.int64), np.asarray(right, dtype=np.int64)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def in_blocks(rows: DataFrame, key: str, group: str, buckets: int) -> DataFrame:
    """Rows of groups dealt out so that all pairs of a group meet, in tasks of bounded size: adds bucket, low, high, side.

    `rows` has the number of blocks of its group in `blocks`. Groups of one block share `buckets` buckets. A larger
    group is cut into blocks by its key, and each pair of blocks (low, high) is a bucket of its own; there, side tells
    the rows of the low block (0) from those of the high one (1), and pairs inside a block meet where low = high.
    """
    own = F.pmod(F.xxhash64(key, F.lit(5)), "blocks").cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    single, alone = F.col("blocks") == 1, F.pmod(F.xxhash64(group), F.lit(buckets)).cast("int")
    return dealt.withColumns(
        {
            "bucket": F.when(single, F.lit(-1).cast("long")).otherwise(F.col(group)),
            "low": F.when(single, alone).otherwise(F.least("own", "other")),
            "high": F.when(single, alone).otherwise(F.greatest("own", "other")),
            "side": F.when(F.col("own") <= F.col("other"), 0).otherwise(1),
        }
    ).drop("own", "other", "blocks")
