"""Nearest neighbours by shifted space-filling curves.

``CURVES`` random rotations project the vectors to ``DIMS`` dimensions; each projection is shifted, quantised to
``BITS`` bits a dimension and ordered along a Hilbert curve, so near vectors tend to have near keys on some curve.

1. Each task counts the keys of its rows on every curve; Spark adds the counts up and sums along each curve, which gives
   every key's place among all rows and so the borders of ``RANGES`` ranges of a curve with about equally many rows (at
   least ``LEAST_RANGE``). A curve has at most 2^(DIMS * BITS) keys, so this stays small whatever the number of rows.
2. Every row is placed in its key range on each curve: one shuffle by curve and range. A query goes to its own range on
   each curve and to the two beside it, and nowhere else: its window reaches at least one whole range, a
   ``RANGES``-th of all rows, to each side. A range is split into blocks of bounded size on both sides (rows and
   queries), so one key that holds a third of all rows is many tasks.
3. A block's rows are ranked for its queries by one matrix product, and those that can be among the ``k`` nearest by their
   exact Euclidean distance in double precision. The windows of all ranges and curves merge: equal findings count once.

The work on one curve is queries times rows times three ``RANGES``-ths. Vectors without low-dimensional structure need
that many curves and windows that wide; recall and the share of rows reranked are measured in the tests and the README.

Fitting (centre and spread of the projections) uses a bounded, hashed sample of ``FIT_ROWS`` vectors; every row is
indexed.

Defined results: vectors that are null, empty, zero, of another length than most of the sample's, or that hold null or
non-finite components take no part as query or candidate, nor do rows with a null id; a query is not its own
candidate; rows that repeat an id are candidates each; ties go to the smaller id; with fewer than ``k`` candidates all
are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType
from pyspark.sql.window import Window

from .common import bounded_sample, saved

CURVES, DIMS, BITS = 24, 8, 2
RANGES, LEAST_RANGE = 64, 128
FIT_ROWS = 20_000
#: A block holds at most about so many vector components of rows, and as many of queries.
BLOCK_VALUES = 1 << 20
#: Distances that a task holds at once.
CHUNK_DISTANCES = 1 << 22
SEED = 20_250
_SIZE = 1 << (DIMS * BITS)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The Hilbert key of each row of integer cell numbers (below 2^bits), by Skilling's transposition."""
    x = np.ascontiguousarray(cells.T.astype(np.uint32))
    dims, n = x.shape
    for level in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(hit, low, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[dims - 1] >> np.uint32(level)) & 1, np.uint32((1 << level) - 1), 0).astype(np.uint32)
    x ^= turn
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> np.uint32(level)) & 1)
    return key


class Curves:
    """Fitted projections: rotation, centre, spread and shift of every curve."""

    def __init__(self, sample: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.width = sample.shape[1]
        dims = min(DIMS, self.width)
        self.rotations = [np.linalg.qr(rng.standard_normal((self.width, self.width)))[0][:, :dims]
                          for _ in range(CURVES)]
        self.centre = sample.mean(axis=0)
        spread = [((sample - self.centre) @ r).std(axis=0) for r in self.rotations]
        self.spread = [np.where(s > 0, s, 1.0) for s in spread]
        self.shift = rng.uniform(-0.5, 0.5, (CURVES, dims))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(CURVES, n) keys."""
        top = (1 << BITS) - 1
        out = np.empty((CURVES, len(x)), np.int64)
        for c in range(CURVES):
            z = ((x - self.centre) @ self.rotations[c]) / self.spread[c] + self.shift[c]
            cells = np.clip(np.floor((z + 2.5) / 5.0 * (top + 1)), 0, top)
            out[c] = hilbert_keys(cells, BITS)
        return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector, digest and number of copies of the distinct rows that take part; lengths are checked later."""
    kind = vectors.schema[vector_col].dataType
    exact = isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))
    v = F.col(vector_col) if exact else F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id", "v").agg(F.count("*").alias("copies")).withColumn("h", F.xxhash64("id", "v"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors of a column of lists of one width."""
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, width)


def best(ids: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` nearest, ties to the smaller id."""
    if len(ids) > 4 * k:
        limit = np.partition(distance, k - 1)[k - 1]
        near = np.flatnonzero(distance <= limit)
        return near[np.lexsort((ids[near], distance[near]))[:k]]
    return np.lexsort((ids, distance))[:k]


class Ranges:
    """Each curve's ranges: the first key of each, and for each cell (curve and range) its blocks of rows and of queries."""

    def __init__(self, curves: Curves, found: pa.Table):
        self.curves = curves
        curve, first, rows = (np.asarray(found[c]) for c in ("curve", "first", "rows"))
        self.borders, sizes = [], np.zeros((CURVES, RANGES + 2), np.int64)
        for c in range(CURVES):
            own = np.flatnonzero(curve == c)
            own = own[np.argsort(first[own])]
            self.borders.append(first[own])
            sizes[c, :len(own)] = rows[own]
        self.block = max(256, BLOCK_VALUES // curves.width)
        self.row_blocks = -(-sizes.ravel() // self.block)
        self.query_blocks = np.zeros_like(self.row_blocks)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(CURVES, n) cells of the vectors' keys."""
        keys = self.curves.keys(x)
        return np.stack([c * (RANGES + 2) + np.maximum(np.searchsorted(b, keys[c], "right") - 1, 0)
                         for c, b in enumerate(self.borders)])

    def window(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, cells) of the vectors whose window meets a cell: the own range and both beside it."""
        for c, cells in enumerate(self.cells(x)):
            at = cells - c * (RANGES + 2)
            for step in (-1, 0, 1):
                inside = np.flatnonzero((at + step >= 0) & (at + step < len(self.borders[c])))
                yield inside, cells[inside] + step


def fitted_ranges(rows: DataFrame, curves: Curves, total: int) -> Ranges:
    """The ranges of every curve, from counts of all rows' keys."""
    held = rows.sparkSession.sparkContext.broadcast(curves)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CURVES, _SIZE), np.int64)
        for batch in batches:
            for c, keys in enumerate(held.value.keys(matrix(batch.column(0), held.value.width))):
                table[c] += np.bincount(keys, minlength=_SIZE)
        for c in range(CURVES):
            keys = np.flatnonzero(table[c])
            yield pa.record_batch([pa.array(np.full(len(keys), c), pa.int32()), pa.array(keys, pa.int64()),
                                   pa.array(table[c][keys])], names=["curve", "key", "n"])

    step = max(LEAST_RANGE, -(-total // RANGES))
    counts = rows.select("v").mapInArrow(count, "curve int, key long, n long").groupBy("curve", "key").agg(
        F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("curve").orderBy("key")) - F.col("n")
    return Ranges(curves, counts.withColumn("range", F.floor(before / step)).groupBy("curve", "range").agg(
        F.min("key").alias("first"), F.sum("n").alias("rows")).toArrow())


def placed_rows(rows: DataFrame, ranges: Ranges) -> DataFrame:
    """Each row once for each curve, in the blocks of its range that have queries."""
    held = rows.sparkSession.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            mixed = np.asarray(batch.column("h")).view(np.uint64)
            for cells in own.cells(matrix(batch.column("v"), own.curves.width)):
                asked = np.flatnonzero(own.query_blocks[cells] > 0)
                cell = cells[asked]
                part = mixed[asked] % own.row_blocks[cell].astype(np.uint64)
                yield pa.record_batch([*batch.take(pa.array(asked)).columns, pa.array(cell), pa.array(part.astype(np.int64)),
                                       pa.array(own.query_blocks[cell])], names=[*batch.schema.names, "cell", "rb", "n"])

    kind = rows.schema["v"].dataType.simpleString()
    out = rows.select("id", "v", "copies", "h").mapInArrow(
        run, f"id long, v {kind}, copies long, h long, cell long, rb long, n long")
    return out.select("id", "v", "copies", "h", "cell", "rb", F.explode(F.sequence(F.lit(1), "n")).alias("qb"))


def query_counts(queries: DataFrame, ranges: Ranges) -> np.ndarray:
    """How many queries go to each cell."""
    held = queries.sparkSession.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        table = np.zeros(len(own.row_blocks), np.int64)
        for batch in batches:
            for _, cells in own.window(matrix(batch.column(0), own.curves.width)):
                table += np.bincount(cells, minlength=len(table))
        hit = np.flatnonzero(table)
        yield pa.record_batch([pa.array(hit), pa.array(table[hit])], names=["cell", "n"])

    found = queries.select("v").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(ranges.row_blocks), np.int64)
    out[np.asarray(found["cell"])] = np.asarray(found["n"])
    return out


def placed_queries(queries: DataFrame, ranges: Ranges) -> DataFrame:
    """Each query in every row block of the ranges that its windows meet."""
    held = queries.sparkSession.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            mixed = np.asarray(batch.column("h")).view(np.uint64)
            for asked, cell in own.window(matrix(batch.column("v"), own.curves.width)):
                part = mixed[asked] % own.query_blocks[cell].astype(np.uint64)
                yield pa.record_batch([*batch.take(pa.array(asked)).columns, pa.array(cell),
                                       pa.array(part.astype(np.int64) + 1), pa.array(own.row_blocks[cell])],
                                      names=[*batch.schema.names, "cell", "qb", "n"])

    kind = queries.schema["v"].dataType.simpleString()
    out = queries.select("id", "v", "h").mapInArrow(run, f"id long, v {kind}, h long, cell long, qb long, n long")
    return out.select("id", "v", "h", "cell", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("rb"), "qb")


_FOUND = "query_id long, query_h long, vec_id long, h long, score double, copies long"


def rerank(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """Each query's ``k`` nearest among the rows of its block."""
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
    parts: list[list[np.ndarray]] = [[np.zeros(0, t.to_pandas_dtype())] for t in kinds]
    if rows.num_rows and queries.num_rows:
        width = len(rows["v"][0])
        x, asked = (matrix(t["v"].combine_chunks(), width) for t in (rows, queries))
        ids, h, copies = (np.asarray(rows[c]) for c in ("id", "h", "copies"))
        own, own_h = np.asarray(queries["id"]), np.asarray(queries["h"])
        square = (x ** 2).sum(axis=1)
        step = max(1, CHUNK_DISTANCES // len(x))
        for at in range(0, len(asked), step):
            part = asked[at:at + step]
            # Squared distances but for rounding, which is far below ``slack``.
            most = (part ** 2).sum(axis=1)
            rough = square - 2 * (part @ x.T) + most[:, None]
            slack = 1e-9 * (most + square.max())
            rough[own[at:at + step, None] == ids] = np.inf
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if k < len(ids) else np.full(len(part), np.inf)
            for i, q in enumerate(range(at, at + len(part))):
                bound = limit[i] + 2 * slack[i]
                # Squares beyond a double's range leave no bound, so that all rows are measured.
                near = np.flatnonzero((rough[i] <= bound) | ~np.isfinite(bound))
                near = near[ids[near] != own[q]]
                apart = np.sqrt(((x[near] - asked[q]) ** 2).sum(axis=1))
                top = best(ids[near], apart, k)
                near = near[top]
                for held, new in zip(parts, (np.full(len(near), own[q]), np.full(len(near), own_h[q]), ids[near], h[near],
                                             apart[top], copies[near])):
                    held.append(new)
    return pa.table({n: pa.array(np.concatenate(p), t) for n, p, t in zip(names, parts, kinds)})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (the distance) of the ``k`` nearest rows of ``vectors`` found for each query."""
    spark = vectors.sparkSession
    rows = saved(usable(vectors, id_col, vector_col), "ann-rows")
    sample = bounded_sample(rows.select("id", "v"), "id", FIT_ROWS).toArrow().combine_chunks()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = np.asarray(pa.compute.list_value_length(sample["v"]))
    width = int(np.bincount(sizes).argmax())
    curves = Curves(matrix(sample.filter(pa.array(sizes == width))["v"].combine_chunks(), width))
    rows = rows.filter(F.size("v") == width)
    asked = saved(usable(queries, id_col, vector_col).filter(F.size("v") == width), "ann-queries")
    ranges = fitted_ranges(rows, curves, rows.count())
    ranges.query_blocks = -(-query_counts(asked, ranges) // ranges.block)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return rerank(left, right, k)

    block = ("cell", "rb", "qb")
    found = placed_rows(rows, ranges).groupBy(*block).cogroup(placed_queries(asked, ranges).groupBy(*block)).applyInArrow(
        search, _FOUND)
    merged = found.repartition("query_id").groupBy("query_id", "query_h", "vec_id", "h").agg(
        F.min("score").alias("score"), F.max("copies").alias("copies"))
    each = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
