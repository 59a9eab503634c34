"""Links between embedding vectors of high cosine within a label, by an index of pivot permutations.

A bounded sample of vectors, thinned so that no two are alike, gives the pivots. Each vector is described by its nearest
pivots in order and stands in the inverted lists of these. Vectors that share enough pivots are candidates; a pair is
looked at in the list of its smallest shared pivot only, and verified by its cosine in double precision. A list longer than
a block becomes lists of that pivot and a second one, where a pair is looked at under its two smallest shared pivots: the same
pairs, in lists that shrink with the square of the number of pivots. Lists still longer, and those without a second pivot, are
dealt out as pairs of bounded blocks. No list of pairs is ever written.

Equal vectors of a label are one class of copies; of equally near pivots the first in the sample counts. Vectors that are null, zero, hold null or non-finite components, or
have no label are linked to nothing. Vectors of other dimensions are never compared; where a dimension has no pivots,
all its vectors of a label share one list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.links import components, in_blocks, roots
from sievemark.sources.tables import materialise

COSINE = 0.93
NEAREST, SHARED = 8, 2
MOST_PIVOTS, MOST_PIVOT_VALUES = 4096, 2_000_000
ALIKE = 0.7
BLOCK_VECTORS = 1024


def usable(embeddings: DataFrame) -> DataFrame:
    """Vectors that can be linked, in double precision."""
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    some = F.exists("vector", lambda v: v != 0)
    return vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(F.forall("vector", finite) & some)


def classes_of(vectors: DataFrame) -> DataFrame:
    """One row for each different vector of a label."""
    return vectors.groupBy("label", "vector").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))


def unit(rows: np.ndarray) -> np.ndarray:
    """Vectors of length one; the largest component is divided out first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def pivots_of(classes: DataFrame, count: int | None = None) -> dict[int, np.ndarray]:
    """Pivots by dimension, from a sample of at most `MOST_PIVOTS` vectors and `MOST_PIVOT_VALUES` components.

    Their number grows with the square root of the number of vectors, so that lists grow no faster.
    """
    facts = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("wide")).first()
    if not facts["n"]:
        return {}
    count = count or int(max(32, 4 * facts["n"] ** 0.5))
    count = max(1, min(count, MOST_PIVOTS, MOST_PIVOT_VALUES // facts["wide"]))
    sample = classes.select("class_id", "vector").orderBy(F.xxhash64("class_id"), "class_id").limit(count).collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    return {size: thinned(unit(np.array(rows))) for size, rows in by_size.items()}


def thinned(pivots: np.ndarray, alike: float = ALIKE) -> np.ndarray:
    """Pivots without those close to an earlier one."""
    near = np.triu(pivots @ pivots.T >= alike, 1)
    keep = np.ones(len(pivots), dtype=bool)
    for at in range(len(pivots)):
        if keep[at]:
            keep[near[at]] = False
    return pivots[keep]


def nearest(rows: np.ndarray, pivots: np.ndarray, count: int = NEAREST) -> np.ndarray:
    """Numbers of the nearest pivots of unit vectors, nearest first."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :count]


def described(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Classes with their nearest pivots."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = [[-1]] * batch.num_rows
            vectors = batch.column("vector").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size, own in pivots.items():
                for part in np.array_split(np.flatnonzero(sizes == size), 1 + batch.num_rows // 2000):
                    if len(part):
                        for at, row in zip(part, nearest(unit(np.array([vectors[p] for p in part])), own).tolist()):
                            found[at] = row
            yield batch.append_column("pivots", pa.array(found, pa.list_(pa.int32())))

    return classes.mapInArrow(run, "label string, vector array<double>, class_id long, copies long, pivots array<int>")


def _verify(cosine: float, shared: int):
    """Verified links inside a bucket of list blocks: for each class the vectors linked, and a tree of links."""

    def run(batch: pa.Table) -> pa.Table:
        across = batch.column("low")[0].as_py() != batch.column("high")[0].as_py()
        ids, sides, lists = (batch.column(name).to_numpy() for name in ("class_id", "side", "list"))
        copies, pivot, second = (batch.column(name).to_numpy() for name in ("copies", "pivot", "second"))
        vectors, described = batch.column("vector").to_pylist(), batch.column("pivots").to_pylist()
        order = np.lexsort((ids, sides, lists))
        out = []
        for rows in np.split(order, np.flatnonzero(np.diff(lists[order])) + 1):
            n = int((sides[rows] == 0).sum())
            units = unit(np.array([vectors[r] for r in rows]))
            held = np.array([described[r] for r in rows])
            numbers, places = np.unique(held, return_inverse=True)
            member = np.zeros((len(rows), len(numbers)), dtype=np.float32)
            member[np.arange(len(rows))[:, None], places.reshape(held.shape)] = 1
            here = int(np.searchsorted(numbers, pivot[rows[0]]))
            first = slice(n, None) if across else slice(0, None)
            enough = member[:n] @ member[first].T >= min(shared, held.shape[1])
            lower = np.arange(here)
            if second[rows[0]] >= 0:
                lower = np.append(lower, np.arange(here + 1, np.searchsorted(numbers, second[rows[0]])))
            smallest = member[:n, lower] @ member[first][:, lower].T == 0
            linked = enough & smallest & (units[:n] @ units[first].T >= cosine)
            a, b = np.nonzero(linked if across else np.triu(linked, 1))
            b = b + (n if across else 0)
            counts = np.bincount(a, copies[rows][b], len(rows)) + np.bincount(b, copies[rows][a], len(rows))
            out.append((ids[rows], counts.astype(np.int64), ids[rows][roots(len(rows), a, b)]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table({"class_id": columns[0], "linked": columns[1], "root": columns[2]})

    return run


def listings(described_classes: DataFrame, shared: int) -> DataFrame:
    """Classes in the inverted lists they are compared in: list, pivot, second (-1: the whole list of the pivot), blocks.

    Lists longer than a block are taken apart by the second shared pivot where pairs have to share two.
    """
    first = described_classes.withColumn("pivot", F.explode("pivots")).withColumn("list", F.xxhash64("label", F.size("vector"), "pivot"))
    placed = first.join(first.groupBy("list").agg(F.count("*").alias("n")).filter("n > 1"), "list")
    long = (F.col("n") > BLOCK_VECTORS) & (F.size("pivots") > 1) & F.lit(shared > 1)
    whole = placed.filter(~long).withColumn("second", F.lit(-1))
    split = placed.filter(long).drop("n").withColumn("second", F.explode(F.filter("pivots", lambda other: other > F.col("pivot"))))
    split = split.withColumn("list", F.xxhash64("list", "second"))
    split = split.join(split.groupBy("list").agg(F.count("*").alias("n")).filter("n > 1"), "list")
    return whole.unionByName(split).withColumn("blocks", F.ceil(F.col("n") / BLOCK_VECTORS).cast("int")).drop("n")


def class_links(classes: DataFrame, cosine: float = COSINE, shared: int = SHARED, count: int | None = None) -> DataFrame:
    """Verified links of classes: class_id, linked (vectors of other classes), root (a class of the same tree)."""
    described_classes = materialise(described(classes, pivots_of(classes, count)))
    places = described_classes.agg(F.coalesce(F.sum(F.size("pivots")), F.lit(0))).first()[0]
    buckets = max(16, -(-places // BLOCK_VECTORS))
    dealt = in_blocks(listings(described_classes, shared), "class_id", "list", buckets)
    return dealt.groupBy("bucket", "low", "high").applyInArrow(_verify(cosine, shared), "class_id long, linked long, root long")


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, shared: int = SHARED, count: int | None = None) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    vectors = usable(embeddings)
    classes = materialise(classes_of(vectors))
    found = materialise(class_links(classes, cosine, shared, count))
    linked = found.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    joined = components(found.filter("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    by_class = classes.join(linked, "class_id", "left").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
    by_class = by_class.withColumn("key", F.struct("label", "vector")).drop("label", "vector")
    keyed = vectors.select("vec_id", F.struct("label", "vector").alias("key")).distinct()
    members = keyed.join(by_class, "key").select("vec_id", "class_id", "copies", "linked", "component")
    # A repeated vec_id with other values counts as one row of each of its vectors.
    members = members.groupBy("vec_id").agg(
        F.min(F.coalesce("component", "class_id")).alias("component_id"),
        F.max(F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"))
    own = F.coalesce("component_id", "vec_id")
    return every.join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), (own == F.col("vec_id")).alias("kept")
    )
