"""Whitening of embedding vectors with MLlib's BlockMatrix.

1. Vectors without null or non-finite entries become integer vectors
   x = floor(64 * c) + 1000000, numbered 0 to n - 1 and written once. Their
   count and per-dimension sums S are exact (long counts, decimal sums).
2. Centred rows (x - S / n, exact before its one rounding) are indexed into
   blocks; transpose times matrix is the scatter, summed block by block with
   the middle dimension split over as many tasks as there are row blocks.
3. The driver solves the dimensions x dimensions covariance (its size depends
   on the vectors' length only, never on their number).
4. The blocks times the whitening matrix are the projected rows. Their own
   covariance, made the same way, gives ``identity_error``.

Rows never pass through Python: blocks are built and multiplied in the JVM. A
block matrix has integer coordinates, so rows beyond ``STRIPE`` go into further
matrices whose scatters are added.

Defined results: vectors of another length than the most frequent one (the
longer of equally frequent ones) are left out like null ones, and so are empty
ones; 64 * c beyond +-4e18 counts as that bound. A deviation beyond a long is
null. Null and repeated vec_ids are rows of their own. Directions without
variance (an eigenvalue under ``LEAST`` of the largest per dimension) cannot be
scaled to one and give no component, so one vector alone, or equal ones, give
no rows; nor does an empty table. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.common import saved

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows of one block matrix; columns of one block; bytes of one block.
STRIPE, BLOCK_COLUMNS, BLOCK_BYTES = 1 << 28, 1024, 4 << 20
#: Eigenvalues under this share of the largest, times the dimensions, count as zero.
LEAST = 1e-12


@dataclass
class Whitening:
    """What the fit list gives: n, S = n * whole + rest per dimension, components by falling eigenvalue."""

    n: int
    whole: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray  # dimensions x components
    trace: float


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the vectors that can be used; see the module text."""
    entry = F.col("embedding")
    whole = entry.isNotNull() & (F.size(entry) > 0) & ~F.exists(
        entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), entry.cast("array<double>").alias("embedding")).filter(
        F.coalesce(whole, F.lit(False)))
    usual = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    bound = F.lit(4e18)
    x = F.transform("embedding", lambda c: F.floor(F.greatest(F.least(c * SCALE, bound), -bound)) + SHIFT)
    return rows.filter(F.size("embedding") == (usual["size"] if usual else 0)).select("vec_id", x.alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, written, with ``index`` from 0 without gaps. Task and place in
    the task are written with the rows, so a later job cannot number them otherwise."""
    written = saved(rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_at", 33)
    counts = written.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()
    before = np.cumsum([0, *(r.n for r in counts)])  # one number for each task that wrote
    first = rows.sparkSession.createDataFrame(
        [(int(r["_task"]), int(b)) for r, b in zip(counts, before)], "_task long, _first long")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = written.withColumn("_task", task).join(first, "_task").withColumn("index", F.col("_first") + place)
    return saved(rows.drop("_task", "_first", "_at"), "indexed")  # read several times


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(int(v)).cast("long") for v in values))


def blocks(rows: DataFrame, n_rows: int, n_columns: int) -> BlockMatrix:
    """``rows`` (index long, row array<double>) as a block matrix, without Python."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("row").alias("vector")), "vector")
    columns = min(n_columns, BLOCK_COLUMNS)
    return IndexedRowMatrix(vectors, n_rows, n_columns).toBlockMatrix(max(1, BLOCK_BYTES // (8 * columns)), columns)


def _stripes(rows: DataFrame, n: int, stripe: int):
    """(rows of one block matrix renumbered from 0, their number)."""
    for first in range(0, n, stripe):
        inside = rows.filter(F.col("index").between(first, first + stripe - 1)) if n > stripe else rows
        yield inside.withColumn("index", F.col("index") - first), first, min(stripe, n - first)


def scatter(rows: DataFrame, n: int, dimensions: int, stripe: int = STRIPE) -> np.ndarray:
    """Transposed matrix times matrix of the (centred) rows."""
    total = np.zeros((dimensions, dimensions))
    for part, _, size in _stripes(rows, n, stripe):
        matrix = blocks(part, size, dimensions).persist(StorageLevel.MEMORY_AND_DISK)  # both factors
        turned = matrix.transpose()
        # the middle dimension is dealt over the tasks: one task would get all blocks otherwise
        splits = max(1, -(-size // matrix.rowsPerBlock))
        product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
        total += BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return total


def projected(rows: DataFrame, n: int, matrix: np.ndarray, stripe: int = STRIPE) -> DataFrame:
    """(index, row) of the rows times a small matrix."""
    spark, (dimensions, k) = rows.sparkSession, matrix.shape
    small = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(matrix)], "index long, vector array<double>")
    vectors = MLUtils.convertVectorColumnsFromML(small.select("index", array_to_vector("vector").alias("vector")), "vector")
    right = IndexedRowMatrix(vectors, dimensions, k).toBlockMatrix(min(dimensions, BLOCK_COLUMNS), k)
    parts = []
    for part, first, size in _stripes(rows, n, stripe):
        product = blocks(part, size, dimensions).multiply(right).toIndexedRowMatrix()
        found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
        parts.append(found.select((F.col("index") + first).alias("index"), vector_to_array("vector").alias("row")))
    return reduce(DataFrame.unionByName, parts)


def centred(n: int, whole: list[int], rest: list[int]) -> Column:
    """x - S / n as doubles: the whole part of S / n is taken off exactly."""
    share = F.array(*(F.lit(r / n) for r in rest))
    middle = _longs(whole)
    return F.transform("x", lambda x, i: (x - F.get(middle, i)).cast("double") - F.get(share, i))


def deviation(n: int, whole: list[int], rest: list[int]) -> Column:
    """Sum over dimensions of (n * x - S) squared; null where a long cannot hold it."""
    middle, left = _longs(whole), _longs(rest)
    away = F.transform("x", lambda x, i: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x - F.get(middle, i)), F.get(left, i)))
    return F.aggregate(away, F.lit(0).cast("long"), lambda total, y: F.try_add(total, F.try_multiply(y, y)))


def fit(vectors: DataFrame, components: int = COMPONENTS, stripe: int = STRIPE) -> Whitening:
    """Learns from all numbered rows (index, x)."""
    sums = vectors.select(F.posexplode("x").alias("place", "value")).groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("total")).orderBy("place").collect()
    if not sums:
        return Whitening(0, [], [], np.zeros(0), np.zeros((0, 0)), 0.0)
    n, d = sums[0].n, len(sums)
    whole, rest = zip(*(divmod(int(r.total), n) for r in sums))
    rows = vectors.select("index", centred(n, whole, rest).alias("row"))
    covariance = scatter(rows, n, d, stripe) / n
    values, found = np.linalg.eigh((covariance + covariance.T) / 2)
    values, found = values[::-1], found[:, ::-1]
    keep = int((values > max(LEAST * d * values[0], 0.0)).sum()) if values[0] > 0 else 0
    keep = min(keep, components)
    return Whitening(n, list(whole), list(rest), values[:keep], found[:, :keep], float(np.trace(covariance)))


def whitened(embeddings: DataFrame, components: int = COMPONENTS, stripe: int = STRIPE) -> tuple[DataFrame, Whitening, float]:
    """(vec_id, deviation, row) of every usable vector, what was learned, and the identity error."""
    vectors = numbered(usable(embeddings))
    model = fit(vectors, components, stripe)
    spark = embeddings.sparkSession
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], "vec_id long, deviation long, row array<double>"), model, 0.0
    rows = vectors.select("index", centred(model.n, model.whole, model.rest).alias("row"))
    out = saved(projected(rows, model.n, model.vectors / np.sqrt(model.values), stripe), "projected")
    means = [r.m for r in out.select(F.posexplode("row").alias("place", "v")).groupBy("place").agg(F.avg("v").alias("m")).orderBy("place").collect()]
    middle = F.array(*(F.lit(m) for m in means))
    again = out.select("index", F.transform("row", lambda v, i: v - F.get(middle, i)).alias("row"))
    error = float(np.abs(scatter(again, model.n, k, stripe) / model.n - np.eye(k)).max())
    facts = vectors.select("index", "vec_id", deviation(model.n, model.whole, model.rest).alias("deviation"))
    return facts.join(out, "index").drop("index"), model, error


def report(embeddings: DataFrame, components: int = COMPONENTS, stripe: int = STRIPE) -> DataFrame:
    """One row for each usable vector and component."""
    rows, model, error = whitened(embeddings, components, stripe)
    share = F.array(*(F.lit(float(e) / model.trace) for e in model.values)) if len(model.values) else F.array(F.lit(0.0))
    return rows.select("vec_id", "deviation", F.posexplode("row").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
