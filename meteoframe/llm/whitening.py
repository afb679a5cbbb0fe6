"""Embedding whitening with distributed block matrices.

Vectors become integers; each distinct one, centred and numbered, is a row of
a ``BlockMatrix``.  Its transpose times itself is the scatter, of which the
driver sees the d x d result alone; its eigenvectors over the roots of their
values are the whitening matrix, and a block matrix of all rows times that
matrix projects them.  Matrices are made from DataFrames and turned back into
them inside the JVM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import stored

BLOCK_BYTES = 1 << 20          # of one block of doubles
SPLIT_BLOCKS = 4               # blocks that one task of a product holds
FILE_BYTES = 64 << 20          # of doubles that one task writes at most
RANK = 1e-12                   # eigenvalues up to this share of the trace hold no variance


@dataclass
class Whitening:
    """What ``fit`` learnt: n distinct vectors, their exact sums, and the unit
    eigenvectors (columns, by falling eigenvalue) of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def matrix(self, components: int) -> np.ndarray:
        """d x components; a component without variance is a column of zeros."""
        e = self.values[:components]
        return np.where(self.varies(components), self.vectors[:, :components] / np.sqrt(np.maximum(e, 1e-300)), 0.0)

    def varies(self, components: int) -> np.ndarray:
        return self.values[:components] > RANK * self.trace


def quantised(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``df`` plus ``_x``: floor(scale * c) of each component as long.  Rows whose
    vector is null or holds a null or non-finite component are dropped."""
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(v.isNotNull() & sound).withColumn("_x", F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored, with ``_index`` counting its rows from 0 without gaps.  The
    driver sees one count per written part."""
    placed = stored(df.withColumn("_part", F.spark_partition_id())
                    .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)
    before, parts = 0, []
    for part, count in sorted(placed.groupBy("_part").count().collect()):
        parts.append((part, before))
        before += count
    offsets = df.sparkSession.createDataFrame(parts, "_part int, _before long")
    return placed.join(offsets, "_part").withColumn("_index", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def block_rows(d: int) -> int:
    return max(1, BLOCK_BYTES // (8 * d))


def centred_blocks(rows: DataFrame, mean: np.ndarray) -> BlockMatrix:
    """Rows of ``_index`` and ``_x`` less ``mean`` as a block matrix."""
    means = F.lit([float(m) for m in mean])
    vectors = rows.select(F.col("_index").alias("index"), array_to_vector(F.zip_with("_x", means, lambda x, m: x.cast("double") - m)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector")).toBlockMatrix(block_rows(len(mean)), len(mean))


def gram(m: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times the matrix itself, as a local array.  Block products are
    dealt to tasks a few blocks at a time and summed."""
    blocks = math.ceil(n / m.rowsPerBlock)
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, math.ceil(blocks / SPLIT_BLOCKS))
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def times(m: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    """The block matrix times a local one."""
    d, k = matrix.shape
    local = Matrices.dense(d, k, matrix.ravel(order="F"))
    return m.multiply(BlockMatrix(SparkContext.getOrCreate().parallelize([((0, 0), local)], 1), d, k))


def row_frame(m: BlockMatrix) -> DataFrame:
    """Rows as ``_index`` and ``_z`` (array of double)."""
    rows = callMLlibFunc("getIndexedRows", m.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("_index"), vector_to_array("vector").alias("_z"))


def fit(fitted: DataFrame, d: int) -> tuple[Whitening, BlockMatrix]:
    """Estimates over rows of ``_index`` and ``_x`` of length ``d``, and their
    centred block matrix."""
    n, *sums = fitted.agg(F.count(F.lit(1)), *[F.sum(F.col("_x")[i].cast("decimal(28,0)")) for i in range(d)]).first()
    sums = [int(s) for s in sums]
    blocks = centred_blocks(fitted, np.array([s / n for s in sums]))
    covariance = gram(blocks, n) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1]
    return Whitening(n, sums, values[order], vectors[:, order], float(np.trace(covariance))), blocks


def deviation(x: Column, model: Whitening, reach: int) -> Column:
    """Sum over dimensions of (n*x - S)^2, exact, as decimal.  ``reach`` bounds
    |n*x - S|: where the sum fits a long, longs are added."""
    kind = "long" if reach * reach * len(model.sums) < 1 << 63 else "decimal(38,0)"
    part = "long" if kind == "long" else "decimal(19,0)"
    apart = F.zip_with(x, F.lit([int(s) for s in model.sums]), lambda c, s: (F.lit(model.n) * c - s).cast(part))
    return F.aggregate(apart, F.lit(0).cast(kind), lambda a, c: (a + c * c).cast(kind)).cast("decimal(38,0)")


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """Per row and component up to ``components``: the id, ``component`` (from 1),
    ``n``, ``deviation`` (decimal), ``whitened``, ``explained``,
    ``identity_error``.

    Rows whose vector is null or holds a null or non-finite component take no
    part; nor do vectors of another length than the most frequent one (of equal
    ones the longest).  The estimates are over distinct quantised vectors, each
    once; repeated rows and equal ids all get their rows of the result, a null
    id is an id.  Vectors shorter than ``components`` have as many components
    as dimensions.  A component without variance (all vectors equal, fewer
    vectors than components) has ``whitened`` null, and is left out of
    ``identity_error`` (0 if none is left).  Further columns are ignored.
    Nothing left, or vectors without components: an empty result.  Components
    beyond the range of a long after scaling fail.
    """
    spark = df.sparkSession
    sound = quantised(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector}`").alias("_v")), "_v", scale).select("_id", "_x")
    kind = f"`{id_col}` {dict(df.dtypes)[id_col]}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    lengths = sound.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or not lengths[0].d:
        return spark.createDataFrame([], kind)
    d, held = lengths[0]
    size = 8 * d * held
    parts = max(math.ceil(size / FILE_BYTES), min(math.ceil(size / BLOCK_BYTES), spark.sparkContext.defaultParallelism))
    rows = numbered(sound.where(F.size("_x") == d).repartition(parts), "whitening-rows")
    fitted = numbered(rows.select("_x").distinct().repartition(parts), "whitening-fit")
    model, blocks = fit(fitted, d)

    k = min(components, d)
    live = model.varies(k)
    seen = gram(times(blocks, model.matrix(k)), model.n) / model.n
    error = float(np.abs(seen - np.eye(k))[np.ix_(live, live)].max()) if live.any() else 0.0

    low, high = fitted.agg(F.min(F.array_min("_x")), F.max(F.array_max("_x"))).first()
    z = row_frame(times(centred_blocks(rows, model.mean), model.matrix(k)))
    each = F.array(*[F.struct(F.lit(j + 1).alias("component"),
                              (F.col("_z")[j] if live[j] else F.lit(None).cast("double")).alias("whitened"),
                              F.lit(float(model.values[j] / model.trace) if live[j] else 0.0).alias("explained")) for j in range(k)])
    return (rows.select("_index", F.col("_id"), deviation(F.col("_x"), model, model.n * (high - low)).alias("deviation"))
            .join(z, "_index").withColumn("_c", F.explode(each))
            .select(F.col("_id").alias(id_col), F.col("_c.component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    F.col("_c.whitened"), F.col("_c.explained"), F.lit(error).alias("identity_error")))
