"""Embedding whitening by spectrum slicing.

Vectors become whole numbers ``x = floor(SCALE * c) + OFFSET``, so counts, sums
and products are exact whatever the order in which tasks finish.  One scan
takes the sums per dimension, a second the products of the entries centred on
the rounded means; the driver turns these into the covariance by exact integer
arithmetic, rounded once.  Its leading eigenpairs come from ``spectrum.py``
(inertia counts, Rayleigh quotient iteration, counted numbering).  A third
scan measures the covariance of the whitened rows, a fourth returns them.

Scale: four map-only scans of two columns; tasks send one number per pair of
dimensions, added up by Spark, and the driver holds matrices of dimension x
dimension, whatever the number of rows.  No row is shuffled, so a vector that
a third of the rows share costs no more than others.  A vector of 1,000
entries makes 500,500 sums; embeddings have that order of dimensions.

Defined cases: rows whose vector is NULL, has a NULL or non-finite entry, or
one of ``LARGEST`` or more (not a long once scaled) are dropped; so are empty
vectors and vectors of another length than the most common one (ties: the
longer).  Repeated rows count and return as often as they occur; a NULL
``vec_id`` is returned as NULL.  Components under ``FLOOR`` of the largest
eigenvalue have no variance to divide by and are not returned, so equal
vectors, one vector or an empty table give no rows.  Equal eigenvalues get an
orthonormal basis of their space.  ``deviation`` is NULL where it is no long.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import bound_batches
from condmon.llm.spectrum import leading

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FLOOR = 2.0**-36
LARGEST = float(1 << 55)
_MAX_LONG = (1 << 63) - 1


@dataclass
class Fit:
    """The whitening of a table of vectors."""

    n: int
    centre: Any  # rounded means, int64
    rest: list[int]  # sums of the entries less the centre
    values: Any  # eigenvalues, falling
    vectors: Any  # unit eigenvectors as columns
    trace: float

    def shares(self):
        return self.values / self.trace

    def apply(self, x):
        import numpy as np

        off = np.array([d / self.n for d in self.rest])
        return ((x - self.centre) - off) @ self.vectors / np.sqrt(self.values)


def usable(embeddings: DataFrame, vec: str = "embedding", keep=("vec_id",)) -> tuple[DataFrame, int]:
    """``keep`` columns and ``_vec`` of the rows that can be whitened, and
    the length of their vectors (0: none)."""
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST)
    rows = embeddings.select(*keep, F.col(vec).cast("array<double>").alias("_vec"))
    rows = rows.where(F.col("_vec").isNotNull() & F.forall("_vec", fine) & (F.size("_vec") > 0))
    sizes = rows.groupBy(F.size("_vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("_vec") == d), d


def _matrix(batch, d: int):
    """The scaled vectors of an Arrow batch, one per row, as int64."""
    import numpy as np

    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(-1, d)).astype(np.int64) + OFFSET


def _totals(df: DataFrame, d: int, kind: str, batch_sums) -> dict[int, Any]:
    """Sums over all rows of ``batch_sums(x)`` (a flat array per batch, of
    float64 or Python ints): one row per entry and task goes to Spark's sum."""
    from decimal import Decimal

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = batch_sums(_matrix(batch, d))
                total = part if total is None else total + part
        if total is None:
            return
        values = [Decimal(int(v)) for v in total] if kind != "double" else total.tolist()
        for at in range(0, len(values), 10_000):
            part = values[at : at + 10_000]
            keys = pa.array(np.arange(at, at + len(part)), pa.int32())
            arrow = pa.float64() if kind == "double" else pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([keys, pa.array(part, arrow)], names=["k", "v"])

    parts = df.select("_vec").mapInArrow(run, f"k int, v {kind}")
    return {r["k"]: r["v"] for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}


def _products(x, centre):
    """Products of all pairs of centred entries, summed exactly."""
    import numpy as np

    z = x - centre
    up = np.triu_indices(z.shape[1])
    most = int(np.abs(z).max())
    if most * most * len(z) < 1 << 53:
        f = z.astype(float)
        return (f.T @ f)[up].astype(np.int64).astype(object)
    z = z.astype(object)
    return (z.T @ z)[up]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Fit | None:
    """The whitening of ``usable`` rows; ``None`` without any variance."""
    import numpy as np

    if d == 0:
        return None
    sums = _totals(rows, d, "decimal(38,0)", lambda x: np.append(x.astype(object).sum(axis=0), len(x)))
    s, n = [int(sums[k]) for k in range(d)], int(sums[d])
    means = [(2 * v + n) // (2 * n) for v in s]
    rest = [v - n * m for v, m in zip(s, means, strict=True)]
    centre = np.array(means, np.int64)
    products = _totals(rows, d, "decimal(38,0)", lambda x: _products(x, centre))
    cov, trace = np.zeros((d, d)), 0
    for k, (i, j) in enumerate(zip(*np.triu_indices(d), strict=True)):
        exact = n * int(products[k]) - rest[i] * rest[j]
        cov[i, j] = cov[j, i] = exact / (n * n)
        trace += exact if i == j else 0
    values, vectors = leading(cov, components, FLOOR)
    return Fit(n, centre, rest, values, vectors, trace / (n * n)) if len(values) else None


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus 1."""
    import numpy as np

    d, c = model.vectors.shape
    up = np.triu_indices(c)

    def sums(x):
        w = model.apply(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w)[up]])

    got = _totals(rows, d, "double", sums)
    total = np.array([got[k] for k in range(len(got))]) / model.n
    mean, square = total[:c], np.zeros((c, c))
    square[up] = total[c:]
    return float(np.abs(np.triu(square - np.outer(mean, mean) - np.eye(c))).max())


def _deviations(x, model: Fit):
    """Sum over dimensions of ``(n * x - S) ** 2`` per row; None beyond a long."""
    import numpy as np

    z = x - model.centre
    top = model.n * (int(np.abs(z).max(initial=0)) + 1)
    if top * top * z.shape[1] <= _MAX_LONG:
        return ((model.n * z - np.array(model.rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((model.n * z.astype(object) - np.array(model.rest, object)) ** 2).sum(axis=1)
    return [int(v) if v <= _MAX_LONG else None for v in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained,
    identity_error`` per usable row and component."""
    rows, d = usable(embeddings)
    out = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"  # noqa: E501
    model = fit(rows, d, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], out)
    error = identity_error(rows, model)
    bound_batches(embeddings.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shares = model.shares()
        c = len(shares)
        for batch in batches:
            x, k = _matrix(batch, d), batch.num_rows
            at = pa.array(np.repeat(np.arange(k), c))
            cols = [
                batch.column(0).take(at),
                pa.array(np.tile(np.arange(1, c + 1), k), pa.int32()),
                pa.array(np.full(k * c, model.n), pa.int64()),
                pa.array(_deviations(x, model), pa.int64()).take(at),
                pa.array(model.apply(x).ravel()),
                pa.array(np.tile(shares, k)),
                pa.array(np.full(k * c, error)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split(" ")[0] for f in out.split(", ")])

    return rows.select("vec_id", "_vec").mapInArrow(run, out)
