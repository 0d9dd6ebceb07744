"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubjay.session import cut_lineage

#: Work inside a task is done on slices of at most about this many bytes of text (a longer text is a slice alone).
SLICE_BYTES = 1 << 21


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers: once per application, through Spark's own file distribution."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="scrubjay-"), "scrubjay_workers.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("scrubjay", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus))


def bounded_sample(df: DataFrame, key: str, rows: int, salt: int = 17) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer), chosen by a hash of ``key``: the same rows on every run.

    One count decides the share, so nothing is sorted and nothing meets in one task. Used for fitting only.
    """
    total = df.count()
    if total <= rows:
        return df
    share = int(rows / total * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30)) < share)


def filled(sizes: dict, bound: float) -> dict:
    """Each label's share within a bound on all of them together: small labels whole, the rest split evenly."""
    out, rest = {}, float(bound)
    order = sorted(sizes, key=lambda label: (sizes[label], str(label)))
    for at, label in enumerate(order):
        take = min(float(sizes[label]), rest / (len(order) - at))
        out[label] = take / sizes[label] if sizes[label] else 1.0
        rest -= take
    return out


def sample_by_label(df: DataFrame, key: str, label: str, shares: dict, salt: int = 17) -> DataFrame:
    """The rows of ``df`` whose hash of ``key`` is within their label's share: the same rows on every run."""
    if all(share >= 1 for share in shares.values()):
        return df
    limits = F.create_map(*(F.lit(x) for name, share in shares.items() for x in (name, int(min(share, 1) * (1 << 30)))))
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30)) < F.try_element_at(limits, F.col(label)))


def strings(column: pa.Array) -> pa.StringArray:
    """A contiguous plain string array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.string())


def each_text(column: pa.StringArray, rows: int = 256):
    """The texts of a column, of which only a few hundred are Python strings at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(start, stop) row ranges of at most ``limit`` bytes of text, or of one row."""
    n = len(column)
    if not n:
        return
    sizes = np.diff(text_buffers(column)[1])
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    yield start, n


def text_buffers(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets into them (a null row spans no bytes)."""
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # Spans below nulls are normally empty already; rebuild if a writer left bytes there.
        valid = np.asarray(column.is_valid())
        if np.any(np.diff(off)[~valid]):
            return text_buffers(pa.array(column.to_pylist(), pa.string()))
    return raw[off[0]:off[-1]], off - off[0]


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back."""
    return cut_lineage(df, name)


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression by Newton's method; classes count alike.

    With one class or no rows the weights are zero but for the intercept, which gives 0.5 or leans to that class.
    """
    x = np.column_stack([x, np.ones(len(x))]) if len(x) else np.zeros((0, x.shape[1] + 1 if x.ndim > 1 else 2))
    w = np.zeros(x.shape[1])
    pos = float(np.sum(y == 1))
    if pos == 0 or pos == len(y):
        w[-1] = 0.0 if not len(y) else (2.0 if pos else -2.0)
        return w
    weight = np.where(y == 1, 0.5 / pos, 0.5 / (len(y) - pos))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * np.append(w[:-1], 0) / len(y)
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge / len(y) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.max(np.abs(step)) < 1e-8:
            break
    return w


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
