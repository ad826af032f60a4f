"""Whitening of embeddings with distributed block matrices.

The centred rows, numbered without gaps, become a ``BlockMatrix`` of Spark's MLlib; its transpose times itself is the
scatter, whose eigenvectors are found on the driver (its size is the dimension's square, whatever the number of rows); a second
block multiplication by the scaled eigenvectors projects all rows. Rows stay in the JVM all the way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelane.session import materialize

# Rows of a block; of 64 columns it has 2 MB.
BLOCK_ROWS = 4_096


def finite_vector(vector: Column) -> Column:
    """Whether a vector is not null and holds finite numbers only."""
    wide = vector.cast("array<double>")
    return F.coalesce(F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def quantised(vector: Column, factor: int = 64, offset: int = 1_000_000) -> Column:
    """``floor(factor * c) + offset`` of each component."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(factor))) + F.lit(offset))


def numbered(df: DataFrame) -> DataFrame:
    """`df` as a table with ``row``, its rows' numbers from 0 without gaps.

    Rows are counted in each partition, and the counts of the partitions before it added. What leaves this process is one number a partition.
    """
    place = F.monotonically_increasing_id()
    table = materialize(df.withColumn("__place", place), "placed")
    part = F.shiftright("__place", 33)
    counts = sorted(tuple(r) for r in table.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for part_, n in counts:
        offsets.append((part_, before))
        before += n
    starts = df.sparkSession.createDataFrame(offsets, "__part long, __before long")
    row = F.col("__before") + F.col("__place").bitwiseAND((1 << 33) - 1)
    return table.join(starts, part == F.col("__part")).select(*df.columns, row.alias("row"))


def _blocks(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """(row, vector) as blocks."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select("row", "vector"), "vector")
    return IndexedRowMatrix(indexed, n, dim).toBlockMatrix(BLOCK_ROWS, dim)


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times itself: the blocks are dealt to as many sums as each sum has blocks, so no task gets them all."""
    splits = math.isqrt(blocks.numRowBlocks - 1) + 1
    turned = blocks.transpose()
    # The number of sums is an argument of Spark's multiply that its Python form does not have.
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _rows(blocks: BlockMatrix) -> DataFrame:
    """The rows of a block matrix: row long, values array<double>."""
    rows = callMLlibFunc("getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("values"))


def _empty(spark: SparkSession, vectors: DataFrame, id_col: str) -> DataFrame:
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    return spark.createDataFrame([], schema)


def _sums(rows: DataFrame) -> list[int]:
    """The exact sum of each component of ``x``."""
    parts = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s")).orderBy("at")
    return [r["s"] for r in parts.collect()]


def _array(values: Sequence, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def whiten(
    vectors: DataFrame, components: int = 32, factor: int = 64, offset: int = 1_000_000,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Per row and component (from 1, by falling eigenvalue): the row whitened, and what describes the fit.

    Components c become x = floor(factor * c) + offset; the fit list is all rows that remain. n is their number,
    deviation the exact sum over dimensions of (n x - S)^2 with the sums S, whitened the centred row projected on the unit
    eigenvector of the covariance (divisor n) over the root of its eigenvalue, explained that eigenvalue's share, and
    identity_error the largest absolute entry of the covariance of all whitened rows less the identity.

    Rows whose vector is null, empty, or holds null or non-finite entries go, and those of another length than the
    commonest one (of two as common, the longer one). There are at most as many components as dimensions. Directions without variance
    (eigenvalue 0 but for rounding) cannot be scaled: whitened is null there, and they are left out of identity_error; without any
    variance explained is null too, and identity_error 0. Repeated rows and null ids stay and count each time. Deviations
    beyond 64 bits are an error. Other columns go; an empty table gives an empty one. Jobs run while it is planned.
    """
    spark = vectors.sparkSession
    bare = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("v"))
    kept = bare.filter(finite_vector(F.col("v")) & (F.size("v") > 0))
    sized = kept.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sized is None:
        return _empty(spark, vectors, id_col)
    dim, n = sized["dim"], sized["count"]
    fit = materialize(numbered(kept.filter(F.size("v") == dim).select("id", quantised(F.col("v"), factor, offset).alias("x"))), "fit")
    # n x - S is a whole number, so the mean costs no digits of the centred rows.
    apart = F.zip_with("x", _array(_sums(fit), "bigint"), lambda x, s: x * F.lit(n) - s)
    centred = fit.withColumn("apart", apart).select(
        "row", "id", F.aggregate("apart", F.lit(0).cast("long"), lambda a, y: a + y * y).alias("deviation"),
        array_to_vector(F.transform("apart", lambda y: y.cast("double") / F.lit(float(n)))).alias("vector"),
    )
    blocks = _blocks(centred, n, dim)
    values, vectors_ = np.linalg.eigh(_scatter(blocks) / n)
    order = np.argsort(values)[::-1][: min(components, dim)]
    total = float(values.sum())
    values, vectors_ = values[order], vectors_[:, order]
    real = values > max(values[0], 0.0) * dim * np.finfo(float).eps * 16
    scaled = np.where(real, vectors_ / np.sqrt(np.where(real, values, 1.0)), 0.0)
    shape = (dim, len(order))
    map_ = DenseMatrix(*shape, scaled.ravel(order="F").tolist())
    turned = BlockMatrix(spark.sparkContext.parallelize([((0, 0), map_)], 1), dim, len(order))
    projected = blocks.multiply(turned)
    white = materialize(_rows(projected), "white")
    error = _identity_error(white, len(order), n, real)
    explained = [float(v) / total if total > 0 else None for v in values]
    taken = centred.select("row", "id", "deviation").join(white, "row")
    each = taken.select("id", "deviation", F.posexplode("values").alias("at", "w"))
    return each.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(_array(real.tolist(), "boolean")[F.col("at")], F.col("w")).alias("whitened"),
        _array(explained, "double")[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _identity_error(white: DataFrame, width: int, n: int, real: np.ndarray) -> float:
    """The largest absolute entry of the covariance of the whitened rows less the identity."""
    if not real.any():
        return 0.0
    means = white.select(F.posexplode("values").alias("at", "w")).groupBy("at").agg(F.avg("w").alias("m")).orderBy("at")
    centre = _array([r["m"] for r in means.collect()], "double")
    centred = white.select("row", array_to_vector(F.zip_with("values", centre, lambda w, m: w - m)).alias("vector"))
    covariance = _scatter(_blocks(centred, n, width)) / n
    return float(np.abs(covariance - np.eye(width))[np.ix_(real, real)].max())
