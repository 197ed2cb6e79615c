"""Embedding whitening: principal components of distributed vectors, scaled to variance one.

Vectors become whole numbers (`floor(SCALE * c) + SHIFT`), so sums and deviations are exact. Their
means are taken off before anything is multiplied: (n * x - S) / n has no cancellation. MLlib's
`computeSVD` of the centred rows gives the right singular vectors and the singular values s; rescaled
by divisor n, the eigenvalues of the covariance are s^2 / n. The total variance is computed apart
from them, from the exact deviations: sum((n * x - S)^2) / n^3. What tasks and the driver hold is a
square of the dimensions, never all rows; every step is a pass over the stored vectors.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; rows that
repeat count each, under their own ids. Vectors of several lengths are an error, as are entries of
2^53 and more and deviations beyond a long. Components without variance (a singular value below
`LEAST` of the greatest, so all of equal rows and of empty vectors) do not exist; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tempora.llm.common import release, stored, with_batches_of

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Share of the greatest singular value under which one is rounding, not variance.
LEAST = 3e-6
#: Up to so many dimensions all components are asked for: MLlib then adds up one square matrix in one pass.
SQUARE = 2048
#: Vectors of an Arrow batch.
ROWS = 2000


@dataclass
class Fit:
    """n rows with sums `sums`; a component a column of `axes`, its eigenvalue, and its share of the variance."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x * self.n - self.sums) / self.n @ self.axes / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """sum((n * x - S)^2) of each row, exact."""
        off = x * self.n - self.sums
        if (np.square(off.astype(float)).sum(1) >= 2.0**63 * 0.999).any():
            raise OverflowError("a deviation is beyond a long")
        return np.square(off).sum(1)


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, x (whole numbers) of the rows whose vector has only finite entries."""
    named = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    left = named.filter(F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c)))
    x = lambda c: F.when(F.abs(c * SCALE) < float(1 << 53), F.floor(c * SCALE).cast("long") + SHIFT).otherwise(F.raise_error(F.lit("an entry of 2^53 or more")).cast("long"))
    return left.select("id", F.transform("v", x).alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(vectors: DataFrame, fn) -> dict[tuple[int, int], float]:
    """The sums, over all tasks, of the matrix that `fn` gives for a batch of vectors, by (row, column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = fn(matrix(batch.column(0)))
                total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    kind = "long" if fn is np_sums else "double"
    parts = vectors.select("x").mapInArrow(run, f"i long, j long, v {kind}")
    return {(r.i, r.j): r.v for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def np_sums(x: np.ndarray) -> np.ndarray:
    return x.sum(0, keepdims=True)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The components of stored vectors (id, x); None if there is none with variance."""
    with_batches_of(vectors.sparkSession, ROWS)
    size = vectors.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if not size.n or not size.most:
        return None
    if size.least != size.most:
        raise ValueError(f"vectors of {size.least} and of {size.most} entries")
    n, dims = size.n, size.most
    sums = np.array([v for _, v in sorted(summed(vectors, np_sums).items())], np.int64)
    box = F.lit(sums.tolist())
    centred = vectors.select(array_to_vector(F.transform("x", lambda c, i: (c * n - F.get(box, i)) / F.lit(float(n)))).alias("v"))
    rows = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "v"), n, dims)
    svd = rows.computeSVD(dims if dims <= SQUARE else min(components, dims), False, LEAST)
    found = np.array(svd.s.toArray())
    k = min(components, int((found > LEAST * found[0]).sum()) if found[0] > 0 else 0)
    if not k:
        return None
    axes = svd.V.toArray()[:, :k]
    axes = axes / np.sqrt(np.square(axes).sum(0))
    out = Fit(n, sums, axes, found[:k] ** 2 / n, np.zeros(k), 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        white = out.whiten(x)
        # the last row is the variance: the whole squares, as far as they are exact, over n^3
        return np.vstack([white.T @ white, np.full((1, k), out.deviation(x).astype(float).sum())])

    found = summed(vectors, moments)
    total = found[k, 0] / float(n) ** 3
    out.explained = out.eigenvalues / total
    out.identity_error = max(abs(found[i, j] / n - (i == j)) for i in range(k) for j in range(k))
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    spark = rows.sparkSession
    vectors = stored(whole_vectors(rows, id_col, vector_col), "vectors")
    kind = vectors.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    ddl = f"id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(vectors, components)
    if model is None:
        return spark.createDataFrame([], ddl).withColumnRenamed("id", id_col)
    box = spark.sparkContext.broadcast(model)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = box.value
        for batch in batches:
            if batch.num_rows:
                x, many = matrix(batch.column(1)), batch.num_rows
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(many), k))).cast(schema.field(0).type)
                cols = [np.tile(np.arange(1, k + 1, dtype=np.int32), many), np.full(many * k, model.n), np.repeat(model.deviation(x), k), model.whiten(x).ravel(), np.tile(model.explained, many), np.full(many * k, model.identity_error)]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)
        release()

    return vectors.mapInArrow(run, ddl).withColumnRenamed("id", id_col)
