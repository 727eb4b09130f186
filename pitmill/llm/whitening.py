"""Whitening of embeddings with MLlib's distributed block matrices.

Vectors become whole numbers ``x = floor(256 * c)``. The fit list holds each distinct ``x`` once; its size and sums are
exact. The centred rows of the fit list are indexed into a ``BlockMatrix`` of row blocks, whose transpose is multiplied
with it to the scatter matrix: the inner dimension is split among tasks, a few blocks each, and partial products are
added up. Only that matrix, of the square of the dimensions, is decomposed at the driver (``eigh``). A second product,
of the centred rows of the whole table with the whitening matrix, projects every row, and a third measures how far the
covariance of the projected fit list is from the identity.

MLlib keeps the place of every block, but not the blocks, at the driver while it multiplies: one of ``BLOCK_BYTES``.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; shorter vectors are
taken as if zeros followed; rows with one vector and repeated rows are projected alike, with each id, a null one too;
components without variance have ``whitened`` and ``explained`` zero, and the identity error says so (1); fewer dimensions than
components give as many as there are; entries beyond the range of a long are held to it, and a ``deviation`` beyond it is null;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.plans.numbering import numbered
from pitmill.llm.workers import lean
from pitmill.plans.staging import stage

#: Bytes of a block of rows, and blocks that a task of a product holds.
BLOCK_BYTES, TASK_BLOCKS = 1 << 20, 8
#: Columns of a block at most.
BLOCK_COLUMNS = 1024


@dataclass
class Whitening:
    """``n`` rows of the fit list with exact ``sums`` by dimension; eigenvalues by falling size and their unit vectors as columns; the largest error of the whitened covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> list[float]:
        return [s / self.n for s in self.sums]

    @property
    def scale(self) -> np.ndarray:
        """One over the root of each eigenvalue; 0 for those that are zero but for rounding."""
        least = self.values.max(initial=0) * len(self.sums) * np.finfo(float).eps
        held = self.values > least
        return np.where(held, 1 / np.sqrt(np.where(held, self.values, 1)), 0)


def whole_numbers(rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``(vec_id, x)`` of the rows that take part."""
    v = F.col(vec_col)
    inf = F.lit(float("inf"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < inf))
    x = F.transform(v, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))
    return rows.where(v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _blocks(rows: DataFrame, mean: list[float], n: int) -> BlockMatrix:
    """The centred rows ``(index, x)`` as a block matrix of ``n`` rows."""
    d = len(mean)
    at = F.lit(mean)
    centred = F.transform(F.sequence(F.lit(1), F.lit(d)), lambda i: F.coalesce(F.try_element_at("x", i).cast("double"), F.lit(0.0)) - F.element_at(at, i))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("vector")), "vector")
    columns = min(d, BLOCK_COLUMNS)
    return IndexedRowMatrix(vectors, numRows=n, numCols=d).toBlockMatrix(max(1, BLOCK_BYTES // (8 * columns)), columns)


def _gram(m: BlockMatrix) -> np.ndarray:
    """The product of the transpose of ``m`` with ``m``, its inner dimension split so that a task holds ``TASK_BLOCKS`` blocks of it."""
    splits = -(-m.numRows() // (m.rowsPerBlock * TASK_BLOCKS))
    left, right = m.transpose()._java_matrix_wrapper._java_model, m._java_matrix_wrapper._java_model
    product = left.multiply(right, int(splits))
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def _projected(m: BlockMatrix, w: np.ndarray) -> BlockMatrix:
    step = m.colsPerBlock
    parts = [((k, 0), DenseMatrix(len(p), w.shape[1], np.asfortranarray(p).ravel(order="F").tolist())) for k, p in enumerate(np.split(w, range(step, len(w), step)))]
    spark = m.blocks.ctx
    return m.multiply(BlockMatrix(spark.parallelize(parts, 1), step, w.shape[1], len(w), w.shape[1]))


def fit_whitening(xs: DataFrame, components: int = 4) -> Whitening | None:
    """Fit on the distinct vectors of ``x``; None where there are none. ``components``: how many the error is measured over."""
    fit = numbered(xs.select("x").distinct(), "fit")
    entries = fit.select(F.posexplode("x").alias("pos", "x"))
    sums = {r["pos"]: int(r["s"]) for r in entries.groupBy("pos").agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s")).collect()}  # one for each dimension
    n = fit.count()
    if not n:
        return None
    d = max(sums, default=-1) + 1
    out = Whitening(n, [sums[k] for k in range(d)], np.empty(0), np.empty((0, 0)), 0.0, 0.0)
    if not d:
        return out
    rows = _blocks(fit, out.mean, n)
    scatter = _gram(rows) / n
    values, vectors = np.linalg.eigh((scatter + scatter.T) / 2)
    out.values, out.vectors, out.trace = np.maximum(values[::-1], 0), np.ascontiguousarray(vectors[:, ::-1]), float(np.trace(scatter))
    k = min(components, d)
    got = _gram(_projected(rows, out.vectors[:, :k] * out.scale[:k])) / n
    out.identity_error = float(np.abs(got - np.eye(k)).max())
    return out


def _deviation(x: np.ndarray, begin: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of ``(n * x - S) ** 2`` over the dimensions of each row; None beyond a long."""
    most = (1 << 63) - 1
    bound = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums))
    kind = np.int64 if bound * bound * len(sums) <= most else object
    s, out = np.array(sums, kind), []
    for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        row = np.zeros(len(sums), kind)
        row[: hi - lo] = x[lo:hi]
        total = int(((row * n - s) ** 2).sum())
        out.append(total if total <= most else None)
    return out


def whiten(xs: DataFrame, model: Whitening | None, components: int = 4) -> DataFrame:
    """A row for each row of ``(vec_id, x)`` and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark, schema = xs.sparkSession, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not model.sums:
        return spark.createDataFrame([], schema)
    k = min(components, len(model.sums))
    rows = numbered(xs, "vectors")
    n_rows = rows.agg(F.max("index").alias("m")).first()["m"]
    z = _projected(_blocks(rows, model.mean, n_rows + 1), model.vectors[:, :k] * model.scale[:k])
    per = z.rowsPerBlock

    def lines(block: tuple) -> Iterator[tuple[int, list[float]]]:
        (i, _), m = block
        for r, line in enumerate(m.toArray().tolist()):
            yield i * per + r, line

    found = z.blocks.flatMap(lines).toDF("index long, z array<double>")
    n, sums = model.n, model.sums

    @lean
    def deviations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2)
            off = np.asarray(x.offsets).astype(np.int64)
            values = np.asarray(x.flatten())
            got = _deviation(values, off - off[0], n, sums)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.int64())], ["index", "vec_id", "deviation"])

    named = rows.select("index", "vec_id", "x").mapInArrow(deviations, "index long, vec_id long, deviation long")
    both = stage(named.join(found, "index").select("vec_id", "deviation", F.posexplode("z").alias("pos", "whitened")), "whitened")
    share = [float(v / model.trace) if model.trace > 0 else 0.0 for v in model.values[:k]]
    return both.select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.lit(share), F.col("pos") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
