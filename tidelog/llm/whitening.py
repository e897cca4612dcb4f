"""Embedding whitening: distributed centred covariance, leading components of it, and a broadcast projection.

Vectors are whole numbers (embeddings on a grid, see ``on_grid``), so that counts, sums and distances from the mean are exact.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from tidelog.llm.eigen import leading
from tidelog.llm.tables import stored

MOST_DIMENSIONS = 4096  # the covariance has the square of that many numbers; longer vectors are refused
#: Components that explain less than that part of the first one count as constant: beyond it rounding decides.
LEAST_VARIANCE = 1e-10


@dataclass
class Whitening:
    """What was learned from ``n`` different vectors: their sums, the components (rows), eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n times the distances from the mean, exact: 64-bit numbers where they fit, else Python's."""
        widest = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
        fits = self.n * widest < 1 << 61 and max(map(abs, self.sums), default=0) < 1 << 61
        return x * self.n - np.array(self.sums, np.int64) if fits else x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def projected(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T

    def squares(self, x: np.ndarray) -> list[int]:
        d = self.deviations(x)
        widest = max(int(d.max(initial=0)), -int(d.min(initial=0)))
        if widest * widest * max(x.shape[1], 1) >= 1 << 62:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def on_grid(embedding: Column, steps: int, offset: int) -> Column:
    """floor(steps * c) + offset for each component; null for vectors that are null or have a null, a non-finite
    component or one whose number does not fit (2^62 and beyond)."""
    wide = embedding.cast("array<double>")
    usable = wide.isNotNull() & F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * steps) < float(1 << 62)))
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(wide, lambda c: F.floor(c * steps).cast("bigint") + F.lit(offset).cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(points: DataFrame, width: int, rows_of, kind: pa.DataType, sql: str) -> np.ndarray:
    """The sum of the matrices ``rows_of`` makes of the points of each task, row by row of the matrix; a few rows of ``width`` or so numbers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = rows_of(_matrix(batch.column(0), width))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(kind))], names=["i", "part"])

    def add(table: pa.Table) -> pa.Table:
        parts = table["part"].combine_chunks()
        total = parts.flatten().to_numpy().reshape(len(parts), -1).sum(axis=0)
        return pa.table({"i": table["i"].slice(0, 1), "part": pa.array([total], pa.list_(kind))})

    schema = f"i bigint, part array<{sql}>"
    rows = points.mapInArrow(partial, schema).groupBy("i").applyInArrow(add, schema).collect()
    return np.array([r.part for r in sorted(rows, key=lambda r: r.i)])


def fit(points: DataFrame, vector: str, k: int) -> tuple[Whitening, DataFrame]:
    """What to whiten by, from each different vector of ``points`` once, and the table of these vectors (column ``vector``).

    Null vectors take no part. If vectors have several lengths, those of the length most different vectors have
    do (of equal frequencies, the longest). No vectors, or only equal ones: no components. The driver sees sums and the
    covariance, whose size depends on the length of a vector only (MOST_DIMENSIONS).
    """
    x = F.col(f"`{vector}`")
    several = stored(points.select(x.alias("vector")).where(F.size("vector") > 0).dropDuplicates())
    sizes = several.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0), several
    width, n = sizes["size"], sizes["count"]
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} components; at most {MOST_DIMENSIONS} can be whitened")
    several = several.where(F.size("vector") == width)
    # upper and lower half apart, so that no sum leaves 64 bits
    halves = _summed(several, width, lambda m: np.stack([(m >> 32).sum(axis=0), (m & 0xFFFFFFFF).sum(axis=0)]), pa.int64(), "bigint")
    sums = [(int(high) << 32) + int(low) for high, low in zip(*halves)]
    centre = Whitening(n, sums, np.zeros(0), np.zeros((0, width)), 0.0)

    def products(m: np.ndarray) -> np.ndarray:
        z = centre.centred(m)
        return z.T @ z

    covariance = _summed(several, width, products, pa.float64(), "double") / n
    covariance = (covariance + covariance.T) / 2
    values, components = leading(covariance, min(k, width))
    real = values > LEAST_VARIANCE * max(values[0], 0.0)
    return Whitening(n, sums, values[real], components[real], float(np.trace(covariance))), several


def identity_error(fitted: Whitening, several: DataFrame) -> float:
    """The largest entry of the covariance of the whitened vectors less the identity: 0 if all is well. Null without components."""
    k = len(fitted.values)
    if not k:
        return None

    def products(m: np.ndarray) -> np.ndarray:
        w = fitted.projected(m)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    *grams, sums = _summed(several, len(fitted.sums), products, pa.float64(), "double") / fitted.n
    return float(np.abs(np.array(grams) - np.outer(sums, sums) - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str, keep: list[str], fitted: Whitening) -> DataFrame:
    """(row, deviation, whitened) of the rows with a vector of the fitted length: a struct of the columns ``keep``,
    the exact squared distance from the mean times n squared (38 digits; more are refused), and the projections on all
    components, each with variance 1."""
    width = len(fitted.sums)
    sent = rows.sparkSession.sparkContext.broadcast(fitted)
    names = ["row", "deviation", "whitened"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(1), width)
            squares = pa.array([decimal.Decimal(s) for s in sent.value.squares(m)], pa.decimal128(38))
            projected = sent.value.projected(m)
            ends = np.arange(len(m) + 1, dtype=np.int32) * projected.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), squares, pa.ListArray.from_arrays(ends, projected.ravel())], names=names)

    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    picked = rows.select(row, F.col(f"`{vector}`").alias("vector")).where((F.size("vector") == width) & F.lit(width > 0))
    schema = StructType([picked.schema["row"], StructField("deviation", DecimalType(38)), StructField("whitened", ArrayType(DoubleType()))])
    return picked.mapInArrow(run, schema)
