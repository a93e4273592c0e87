"""Embedding whitening by hierarchical SVD merging.

Each partition keeps the number of its vectors, their mean, and the singular
values and right vectors of its centred rows, all of them: as many as there are
dimensions. Two such summaries merge without loss: their scaled right vectors
are stacked, with one more row, the difference of the means times the root of
``n1 * n2 / (n1 + n2)``, and decomposed again. Merging goes in a tree of groups
of FAN by partition number, in tasks, until one is left; the right vectors are
then the components, and the squared singular values over n the eigenvalues of
the covariance, without a covariance ever being formed.

Entries are whole numbers, ``floor(SCALE * c) + SHIFT``, so sums are exact and
carried beside; a partition's rows are centred before they are decomposed, so
the shift costs no digits. A row's distance from the mean comes as
``n * x - S`` in whole numbers.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries go, as do those with an entry of LIMIT or more in size and those of
another length than most (of equally frequent lengths the longest stays);
repeated rows count as vectors each; an id may be null; a component without
variance (an eigenvalue that rounding can't tell from 0, and all of a single
vector's) has a null ``whitened`` and takes no part in ``identity_error``;
``deviation`` is null where it exceeds 64 bits, and ``deviation_exact`` has 38
digits; equal eigenvalues leave their components any basis of the same space;
each component's sign makes its largest entry positive; an empty table gives an
empty result. Only the two columns named are read. A partition takes up a batch
of rows at a time; no task holds more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.vectors import matrix, usable
from weftline.scratch import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Summaries that one task merges.
FAN = 16
#: Rows that are decomposed at once.
BLOCK = 8192
#: Entries from this size on count as non-finite: beyond it, whole numbers don't fit 64 bits.
LIMIT = float(2**50)
#: Relative to the largest one: an eigenvalue up to this is no variance.
NOTHING = 1e-17

_SUMMARY = "id long, n long, sums array<string>, mean array<double>, parts array<double>"


class Summary:
    """n, exact sums, mean, and singular values times right vectors of centred rows."""

    def __init__(self, dims: int) -> None:
        import numpy as np

        self.n, self.sums, self.mean, self.parts = 0, [0] * dims, np.zeros(dims), np.zeros((0, dims))

    def add(self, n: int, sums, mean, parts) -> None:
        """Takes up another summary: its scaled right vectors and the mean correction below one's own, decomposed again."""
        import numpy as np

        if not n:
            return
        both = self.n + n
        correction = (mean - self.mean) * np.sqrt(self.n / both * n)
        self.parts = _right(np.vstack([self.parts, parts, correction[None, :]]))
        self.mean = self.mean + (mean - self.mean) * (n / both)
        self.n, self.sums = both, [a + b for a, b in zip(self.sums, sums)]

    def add_rows(self, x) -> None:
        """Takes up rows of whole numbers."""
        import numpy as np

        sums = _column_sums(x)
        mean = np.array([s / len(x) for s in sums])
        self.add(len(x), sums, mean, _right(x - mean))

    def row(self, number: int) -> list:
        return [number, self.n, [str(s) for s in self.sums], self.mean.tolist(), self.parts.ravel().tolist()]


def _right(rows):
    """Singular values times right vectors of rows, none left out."""
    import numpy as np

    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, s, v = np.linalg.svd(rows, full_matrices=False)
    return s[:, None] * v


def _column_sums(x) -> list[int]:
    """Exact sums of the columns, as Python's whole numbers."""
    import numpy as np

    wide = float(np.abs(x).max(initial=0)) * len(x) >= 2**62
    return [int(s) for s in (x.astype(object) if wide else x).sum(axis=0)]


def whole(vectors):
    """Entries as whole numbers."""
    import numpy as np

    return np.floor(vectors * SCALE).astype(np.int64) + SHIFT


def summaries(rows: DataFrame, dims: int) -> DataFrame:
    """A summary of each partition that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = Summary(dims)
        for batch in batches:
            x = whole(matrix(batch.column("v"), dims))
            for at in range(0, len(x), BLOCK):
                held.add_rows(x[at : at + BLOCK])
        if held.n:
            yield pa.RecordBatch.from_pandas(pd.DataFrame([held.row(TaskContext.get().partitionId())], columns=["id", "n", "sums", "mean", "parts"]), preserve_index=False)

    return rows.select("v").mapInArrow(run, _SUMMARY)


def merged(parts: DataFrame, dims: int, fan: int = FAN) -> DataFrame:
    """One summary of all: neighbours by number merge, ``fan`` in a task, level by level."""

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        held = Summary(dims)
        for r in group.sort_values("id").itertuples():
            held.add(r.n, [int(s) for s in r.sums], np.array(r.mean), np.array(r.parts).reshape(-1, dims))
        return pd.DataFrame([held.row(int(key[0]))], columns=["id", "n", "sums", "mean", "parts"])

    level = materialize(parts, "svd")
    while level.select(F.max("id")).first()[0]:
        level = materialize(level.groupBy(F.floor(F.col("id") / fan).alias("above")).applyInPandas(merge, _SUMMARY), "svd")
    return level


class Whitener:
    """Components of a merged summary: ``directions`` (a row each), ``eigen`` (their eigenvalues) and what maps rows."""

    def __init__(self, n: int, sums, parts, k: int = COMPONENTS) -> None:
        import numpy as np

        _, s, v = np.linalg.svd(parts, full_matrices=False)
        eigen = s * s / n
        self.n, self.sums, self.trace, self.used = n, sums, float(eigen.sum()), min(k, v.shape[1])
        v, eigen = v[: self.used], eigen[: self.used]
        if len(v) < self.used:  # fewer rows than components
            v, eigen = np.vstack([v, np.zeros((self.used - len(v), v.shape[1]))]), np.append(eigen, np.zeros(self.used - len(eigen)))
        top = np.abs(v).argmax(axis=1)
        self.directions = v * np.where(v[np.arange(len(v)), top] < 0, -1.0, 1.0)[:, None]
        self.eigen = eigen
        self.varies = eigen > max(NOTHING * float(eigen.max(initial=0.0)), 0.0)
        if n < 2:
            self.varies[:] = False
        self.scale = np.where(self.varies, 1 / np.sqrt(np.where(self.varies, eigen, 1.0)), np.nan)

    def deviations(self, x):
        """n * x - S in whole numbers: 64 bits where they suffice."""
        import numpy as np

        if self.n < 2**61 // max(1, int(np.abs(x).max(initial=1)), max(map(abs, self.sums)) // self.n):
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def apply(self, x):
        return (self.deviations(x).astype(float) / self.n) @ self.directions.T * self.scale


def fit(rows: DataFrame, dims: int, k: int = COMPONENTS) -> Whitener | None:
    """The components of all rows (v), none of an empty table. What comes to the driver is one summary, of dims x dims numbers."""
    import numpy as np

    found = merged(summaries(rows, dims), dims).first()
    return found and Whitener(found.n, [int(s) for s in found.sums], np.array(found.parts).reshape(-1, dims), k)


def whitened(rows: DataFrame, dims: int, model: Whitener) -> DataFrame:
    """vec_id, deviation_exact (text of a whole number) and w, the whitened components, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                x = whole(matrix(some.column("v"), dims))
                d = model.deviations(x)
                small = d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * dims < 2**62
                far = (d * d).sum(axis=1) if small else (d.astype(object) ** 2).sum(axis=1)
                w = model.apply(x)
                yield pa.RecordBatch.from_arrays([some.column("vec_id"), pa.array([str(f) for f in far.tolist()], pa.string()), pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "far", "w"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, far string, w array<double>")


def identity_error(found: DataFrame, model: Whitener) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over the components that vary."""
    use = [k for k in range(model.used) if model.varies[k]]
    if not use:
        return None
    w = lambda k: F.element_at("w", k + 1)
    pairs = [(i, j) for i in use for j in use if i <= j]
    # Spark's covariance centres before it multiplies and merges partitions by their means
    covered = found.agg(*[F.covar_pop(w(i), w(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(covered[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(table: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact: a row for each vector and component up to k."""
    rows, dims = usable(table, also=~F.exists("v", lambda c: F.abs(c) >= LIMIT))
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    model = fit(rows, dims, k)
    if model is None:
        return rows.sparkSession.createDataFrame([], out)
    found = materialize(whitened(rows, dims, model), "whitened")
    error = F.lit(identity_error(found, model)).cast("double")
    explained = F.array(*[F.lit(float(e / model.trace) if model.trace else None).cast("double") for e in model.eigen])
    each = found.select("vec_id", F.col("far").cast("decimal(38,0)").alias("far"), F.posexplode("w").alias("c", "x"))
    return each.select(
        "vec_id", (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("far").try_cast("long").alias("deviation"),
        F.nanvl("x", F.lit(None).cast("double")).alias("whitened"), F.get(explained, F.col("c")).alias("explained"), error.alias("identity_error"), F.col("far").alias("deviation_exact"),
    )
