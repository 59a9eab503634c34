"""Embeddings rotated and scaled to unit covariance over distributed blocks.

Entries become whole numbers, floor(256 * c). The fit list holds each distinct whole-number vector once; its mean and
covariance define the principal components, strongest first. Rows get dense numbers, so that centred rows are an
`IndexedRowMatrix` and its `BlockMatrix` A: the scatter is A'A over blocks, partial products summed on the map side, the
d x d result is decomposed on the driver, and A times the scaled components projects all rows.

Rows are dropped whose vector is null, or holds null or non-finite entries; so are vectors of another length than most
have (of equally frequent lengths the greater counts). Repeated rows are projected each, but fitted once. Entries beyond a long are
held at its limits. Components without variance have null results. A sign is fixed by the component's largest entry
being positive; among equal eigenvalues the components are those that the decomposition gives. The driver holds d x d numbers, and
the places of at most `MOST_BLOCKS` blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemark.sources.tables import materialise

SCALE = 256
COMPONENTS = 4
ROWS_PER_BLOCK, COLUMNS_PER_BLOCK = 1024, 1024
MOST_BLOCKS = 1 << 18  # blocks get more rows beyond it, since the driver plans a product by the places of all blocks
BLOCKS_PER_TASK = 8
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """Size, sums by dimension, covariance and the kept components (as columns) of a fit list."""

    n: int
    sums: list[int]
    widest: int
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def means(self) -> list[float]:
        return [total / self.n for total in self.sums]


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the usable rows, of the length that most of them have."""
    entries = F.col("embedding")
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    usable = vectors.select("vec_id", "embedding").filter(entries.isNotNull() & F.forall(entries, finite))
    lengths = usable.groupBy(F.size(entries).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    return usable.filter(F.size(entries) == size).select("vec_id", F.transform(entries, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, stored, with a dense number from 0: each stored part's rows follow those of the parts before it."""
    within = (1 << 33) - 1
    stored = materialise(rows.withColumns({"part": F.spark_partition_id(), "own": F.monotonically_increasing_id().bitwiseAND(F.lit(within))}))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = stored.groupBy("part").agg(F.count("*").alias("rows")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    # One row for each task that wrote rows.
    placed = stored.join(F.broadcast(parts), "part")
    return placed.withColumn("index", F.col("own") + F.col("before")).drop("part", "own", "before")


def centred(rows: DataFrame, means: list[float], count: int) -> BlockMatrix:
    """Rows (index, x) less their mean as blocks; rows that are not there are zeros. `count` numbers are in use."""
    values = F.zip_with(F.col("x"), F.lit(means), lambda x, mean: x.cast("double") - mean)
    table = rows.select("index", array_to_vector(values).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(table, "vector"), count, len(means))
    # A product looks at the places of the blocks first and then at the blocks, so they are kept meanwhile.
    return matrix.toBlockMatrix(max(ROWS_PER_BLOCK, -(-count // MOST_BLOCKS)), COLUMNS_PER_BLOCK).persist(StorageLevel.MEMORY_AND_DISK)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """A'A. The long middle dimension is cut, so that a task multiplies a bounded number of blocks."""
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_PER_TASK))
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper
    product = BlockMatrix(left.call("multiply", right._java_model, splits), COLUMNS_PER_BLOCK, COLUMNS_PER_BLOCK)
    return product.toLocalMatrix().toArray()


def fit(listed: DataFrame, count: int, most: int = COMPONENTS) -> Fit | None:
    """Sums and components of a fit list (index, x); None without entries."""
    places = listed.select(F.posexplode("x").alias("at", "value")).groupBy("at")
    whole = F.col("value").cast(EXACT)
    columns = places.agg(F.count("*").alias("n"), F.sum(whole).alias("sum"), F.max(F.abs(whole)).alias("widest")).orderBy("at").collect()
    if not columns:
        return None
    n, sums = columns[0]["n"], [int(row["sum"]) for row in columns]
    blocks = centred(listed, [total / n for total in sums], count)
    covariance = scatter(blocks) / n
    _release(blocks)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Fit(n, sums, max(int(row["widest"]) for row in columns), float(np.trace(covariance)), values, vectors)


def _release(blocks: BlockMatrix) -> None:
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)


def projected(spark: SparkSession, rows: DataFrame, count: int, model: Fit) -> DataFrame:
    """index and z, stored: the projections over the standard deviation of each component; null for one without variance."""
    limit = len(model.sums) * np.finfo(float).eps * max(float(model.eigenvalues.max(initial=0)), 0.0)
    good = model.eigenvalues > limit
    scale = np.where(good, 1 / np.sqrt(np.where(good, model.eigenvalues, 1.0)), 0.0)
    weights = [(at, Vectors.dense(row)) for at, row in enumerate((model.components * scale).tolist())]
    right = IndexedRowMatrix(spark.createDataFrame(weights, ["index", "vector"]), len(weights), len(scale)).toBlockMatrix(COLUMNS_PER_BLOCK, COLUMNS_PER_BLOCK)
    blocks = centred(rows, model.means, count)
    product = blocks.multiply(right).toIndexedRowMatrix()
    made = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    z = vector_to_array("vector")
    found = materialise(made.select("index", F.array(*(z[at] if ok else F.lit(None).cast("double") for at, ok in enumerate(good.tolist()))).alias("z")))
    _release(blocks)
    return found


def deviation(x: Column, model: Fit) -> Column:
    """Sum over dimensions of (n * x - S)^2, exactly; null beyond 38 digits."""
    step = 2 * model.n * max(model.widest, 1)
    if len(model.sums) * step * step < 1 << 63:
        apart = F.zip_with(x, F.lit(model.sums), lambda value, total: value * model.n - total)
        return F.aggregate(apart, F.lit(0).cast("long"), lambda total, a: total + a * a).cast(EXACT)
    sums = F.array(*(F.lit(str(total)).cast(EXACT) for total in model.sums))
    apart = F.zip_with(x, sums, lambda value, total: F.try_subtract(F.try_multiply(value.cast(EXACT), F.lit(model.n).cast(EXACT)).cast(EXACT), total).cast(EXACT))
    square = lambda a: F.try_multiply(a, a).cast(EXACT)
    return F.aggregate(apart, F.lit(0).cast(EXACT), lambda total, a: F.try_add(total, square(a)).cast(EXACT))


def identity_error(z: DataFrame, known: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the known components, minus the identity."""
    pairs = [(a, b) for a in known for b in known if a <= b]
    if not pairs:
        return None
    row = z.agg(*(F.covar_pop(F.col("z")[a], F.col("z")[b]).alias(f"c_{a}_{b}") for a, b in pairs)).first()
    return max(abs(row[f"c_{a}_{b}"] - (a == b)) for a, b in pairs)


OUTPUT = f"vec_id long, component int, n long, deviation {EXACT}, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """Each usable row's first components: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = numbered(whole_numbers(vectors))
    # Copies of a vector meet as a partial minimum.
    listed = materialise(rows.groupBy("x").agg(F.min("index").alias("index")))
    count = rows.count()
    model = fit(listed, count, most)
    if model is None:
        return spark.createDataFrame([], OUTPUT)
    z = projected(spark, rows, count, model)
    first = z.first()["z"]
    known = [at for at, value in enumerate(first) if value is not None]
    error = identity_error(z.join(listed.select("index"), "index", "left_semi"), known)
    explained = [max(float(value), 0.0) / model.trace if model.trace > 0 else None for value in model.eigenvalues]
    kept = rows.select("index", F.col("vec_id").cast("long").alias("vec_id"), deviation(F.col("x"), model).alias("deviation")).join(z, "index")
    each = kept.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    shares = F.array(*(F.lit(value).cast("double") for value in explained))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whitened_vectors(vectors: DataFrame) -> DataFrame:
    """The rows of `whiten` with the deviation as a long; null where it is beyond one."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("long"))
