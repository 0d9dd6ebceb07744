"""Pairwise co-moments of number columns as one mergeable state: counts, means, squares and products in one pass.

A state holds, for every pair of columns, the rows where both have a value: their number, the mean of each, the sum of
squared deviations and the sum of products of deviations. A batch of rows becomes a state by a few matrix products of
its centred values; two states merge by the parallel update of Chan, Golub and LeVeque, so the order of merging does not
matter and nothing is lost to cancellation. Every task fills one state (one row of ``columns * columns`` numbers, whatever its
rows), and states merge in a tree of shuffles, ``FAN_IN`` to one.

A NaN or an infinity makes the pairs of its column NaN, as in Spark's own ``corr``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubjay.session import ship_package

FAN_IN = 32
_SCHEMA = "state binary"


class CoMoments:
    """For columns i and j over the rows where both have a value: n, mean of i, squares of i, products of i and j."""

    def __init__(self, width: int, parts: np.ndarray | None = None) -> None:
        self.n, self.mean, self.square, self.product, self.bad = (
            parts if parts is not None else np.zeros((5, width, width)))

    def fill(self, x: np.ndarray, known: np.ndarray) -> CoMoments:
        """Becomes the state of a batch: rows by columns, and which of them are values."""
        bad = known & ~np.isfinite(x)
        mask = known.astype(float)
        use = known & ~bad
        count = use.sum(axis=0)
        centre = np.where(use, x, 0.0).sum(axis=0) / np.maximum(count, 1)
        z = np.where(use, x - centre, 0.0)
        self.n = mask.T @ mask
        with np.errstate(divide="ignore", invalid="ignore"):
            total, some = z.T @ mask, np.maximum(self.n, 1)
            self.mean = np.where(self.n > 0, centre[:, None] + total / some, 0.0)
            self.square = (z * z).T @ mask - total * total / some
            self.product = z.T @ z - total * total.T / some
        odd = bad.astype(float).T @ mask
        self.bad = odd + odd.T
        return self

    def merge(self, other: CoMoments) -> CoMoments:
        n = self.n + other.n
        some = np.maximum(n, 1)
        gap = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / some
        out = CoMoments(len(n))
        out.n, out.bad = n, self.bad + other.bad
        out.mean = (self.mean * self.n + other.mean * other.n) / some
        out.square = self.square + other.square + gap * gap * weight
        out.product = self.product + other.product + gap * gap.T * weight
        return out

    def correlations(self) -> np.ndarray:
        """Pearson's r of every pair; NaN where it is undefined."""
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.sqrt(np.maximum(self.square, 0)) * np.sqrt(np.maximum(self.square.T, 0))
            r = np.where((self.n > 1) & (spread > 0), self.product / spread, np.nan)
        return np.clip(r, -1, 1)

    def pack(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product, self.bad]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, width: int) -> CoMoments:
        return cls(width, np.frombuffer(data).reshape(5, width, width).copy())


def _one(state: CoMoments) -> pa.RecordBatch:
    return pa.record_batch([pa.array([state.pack()], pa.binary())], names=["state"])


def _fill(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = CoMoments(width)
        for batch in batches:
            if batch.num_rows:
                known = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns])
                x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
                state = state.merge(CoMoments(width).fill(x, known))
        yield _one(state)
    return run


def _merge(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, some = CoMoments(width), False
        for batch in batches:
            for data in batch.column(0).to_pylist():
                state, some = state.merge(CoMoments.unpack(data, width)), True
        if some:
            yield _one(state)
    return run


def comoments(df: DataFrame, cols: Sequence[str]) -> CoMoments:
    """The state of all rows: one pass over ``cols``, then a tree of merges; one state reaches the driver."""
    width = len(cols)
    ship_package(df.sparkSession)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    states = rows.mapInArrow(_fill(width), _SCHEMA)
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    left = int(parts) if str(parts).isdigit() else 200
    while left > FAN_IN:  # one state a task: neighbours meet, FAN_IN to one
        left = -(-left // FAN_IN)
        states = states.repartition(left).mapInArrow(_merge(width), _SCHEMA)
    out = CoMoments(width)
    for row in states.repartition(1).mapInArrow(_merge(width), _SCHEMA).collect():
        out = out.merge(CoMoments.unpack(row.state, width))
    return out
