"""Whitening of vectors by distributed block matrices.

1. *Fit list.* Every distinct vector once, with a gapless index. Its sums give
   the mean; rows become n * x - S in whole numbers, divided by n.
2. *Scatter.* The centred rows are an ``IndexedRowMatrix`` cut into a
   ``BlockMatrix`` of tall blocks; its transpose times itself is summed in as
   many parts as there are tasks and only then added up.
3. *Eigenvectors* of the small matrix that results are found on the driver.
4. *Projection.* The block matrix times the whitening matrix gives a row per
   distinct vector, which is joined back to the rows that have it.

What reaches the driver is square in the dimension, plus the place of every
block (``BLOCK_BYTES`` of data each), as ``BlockMatrix`` plans products there.

Rows left out: see ``whole_vectors``. Components whose eigenvalue is nought but
for rounding (below 1e-12 of the largest) do not exist: fewer than asked for
are returned, none for a single distinct vector or an empty table. Repeated
rows and ids give rows of their own. A deviation that does not fit into a long
is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running_total, written
from tidemark.llm.vectors import whole_vectors

SCALE, SHIFT = 64, 1_000_000
# Larger components, times the number of rows, do not stay exact.
LARGEST = float(1 << 24)
BLOCK_BYTES = 8_000_000
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """What was learned from the fit list; the matrix has a column per component."""

    n: int
    sums: list[int]
    lowest: list[int]
    highest: list[int]
    matrix: np.ndarray
    explained: list[float]


def block_matrix(rows: DataFrame, dimension: int) -> BlockMatrix:
    """Rows (index, values: array of doubles) as a matrix of tall blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    height = max(1, BLOCK_BYTES // (8 * dimension))
    return IndexedRowMatrix(vectors).toBlockMatrix(height, dimension)


def scatter(matrix: BlockMatrix, parts: int) -> np.ndarray:
    """The transpose times the matrix, summed over ``parts`` slices of the rows at once.

    Without slices all blocks would meet in one task, as the product is one block.
    """
    across = matrix.transpose()._java_matrix_wrapper
    product = across.call("multiply", matrix._java_matrix_wrapper._java_model, parts)
    columns = matrix.numCols()
    return BlockMatrix(product, columns, columns).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """The matrix times ``weights`` as rows (index, values)."""
    small = DenseMatrix(*weights.shape, weights.flatten(order="F"))
    session = matrix.blocks.context
    right = BlockMatrix(session.parallelize([((0, 0), small)], 1), *weights.shape)
    product = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))


def deviations(model_n: int, sums: list[int]) -> Column:
    """n * x - S of the column ``x``, in whole numbers."""
    totals = F.array(*[F.lit(s).cast("long") for s in sums])
    return F.transform("x", lambda v, i: v * F.lit(model_n).cast("long") - F.get(totals, i))


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct ``x`` once with a gapless index, stored."""
    once = written(rows.select("x").distinct().withColumn("one", F.lit(1).cast("long")), "whitening-distinct")
    return written(running_total(once, ["x"], "one", "index", "whitening-order").drop("one"), "whitening-fit")


def fit(listed: DataFrame, components: int) -> Whitening | None:
    """Mean, eigenvectors and explained shares of a fit list; nothing for an empty one."""
    dims = (
        listed.select(F.posexplode("x"))
        .groupBy("pos")
        .agg(F.count("*").alias("n"), F.sum("col").alias("s"), F.min("col").alias("low"), F.max("col").alias("high"))
        .orderBy("pos")
        .collect()
    )
    if not dims:
        return None
    n, sums = dims[0].n, [r.s for r in dims]
    model = Whitening(n, sums, [r.low for r in dims], [r.high for r in dims], np.zeros((len(dims), 0)), [])
    parts = max(1, listed.rdd.getNumPartitions())
    covariance = scatter(block_matrix(centred(listed, model), len(dims)), parts) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(0.0, 1e-12 * values.max())]
    signs = np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(dims))] < 0, -1.0, 1.0)
    model.matrix = (vectors * signs)[:, order] / np.sqrt(values[order])
    model.explained = (values[order] / values.sum()).tolist()
    return model


def centred(listed: DataFrame, model: Whitening) -> DataFrame:
    """Rows (index, values) with the mean taken off."""
    values = F.transform(deviations(model.n, model.sums), lambda v: v.cast("double") / F.lit(float(model.n)))
    return listed.select("index", values.alias("values"))


def squared_deviation(model: Whitening) -> Column:
    """The exact sum of squares of n * x - S: in longs where all fit, else in decimals, null beyond a long."""
    ends = zip(model.sums, model.lowest, model.highest, strict=True)
    farthest = max(max(model.n * high - s, s - model.n * low) for s, low, high in ends)
    kind = "long" if farthest**2 * len(model.sums) < 1 << 63 else "decimal(38,0)"
    squares = F.transform(deviations(model.n, model.sums), lambda v: (v.cast(kind) * v.cast(kind)).cast(kind))
    total = F.aggregate(squares, F.lit(0).cast(kind), lambda a, v: (a + v).cast(kind))
    return total.try_cast("long")


def whitened(vectors: DataFrame, column: str = "embedding", components: int = 16) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row that is kept.

    ``identity_error`` is the largest entry of the whitened fit list's
    covariance minus the identity, found by a second product of block matrices.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, column, ["vec_id"], SCALE, SHIFT, LARGEST, "whitening-rows")
    listed = fit_list(rows)
    model = fit(listed, components)
    if model is None or not model.explained:
        return spark.createDataFrame([], RESULT)
    result = written(projected(block_matrix(centred(listed, model), len(model.sums)), model.matrix), "whitening-projected")
    size = len(model.explained)
    gram = scatter(block_matrix(result, size), max(1, result.rdd.getNumPartitions())) / model.n
    error = float(np.abs(gram - np.eye(size)).max())
    by_vector = listed.withColumn("deviation", squared_deviation(model)).join(result, "index").select("x", "deviation", "values")
    found = rows.join(by_vector, "x").select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    shares = F.array(*[F.lit(e) for e in model.explained])
    return found.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
