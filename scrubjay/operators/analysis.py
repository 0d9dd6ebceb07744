"""Report-side operators: ranking, pivots, correlation, histograms, shares, samples."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from scrubjay.functions.comoments import comoments
from scrubjay.session import cut_lineage


def _sort(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows under ``order``; planned as a per-task top-n plus a final merge."""
    return df.orderBy(*_sort(order)).limit(n)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int,
                    rank_name: str = "rank", method: str = "rank") -> DataFrame:
    """Rows ranked ``<= k`` inside each group (``rank`` keeps ties)."""
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*group).orderBy(*_sort(order))
    return df.withColumn(rank_name, fn().over(w)).filter(F.col(rank_name) <= k)


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, agg: Column) -> DataFrame:
    """Pivot with an explicit value list (no extra job to discover the values)."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(agg)


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Long Pearson matrix ``(col_x, col_y, corr)`` for every ordered pair.

    Each pair counts the rows where both values are present (pandas' pairwise semantics). One pass over the columns
    fills a mergeable co-moment state in each task; no row is repeated and only the states are shuffled
    (``functions.comoments``). Undefined (constant column, < 2 rows) -> null, a NaN or infinite value -> NaN.
    """
    cols = list(cols)
    state = comoments(df, cols)
    r = state.correlations()
    found = [(x, y, float("nan") if state.bad[i, j] else None if math.isnan(r[i, j]) else float(r[i, j]))
             for i, x in enumerate(cols) for j, y in enumerate(cols)]
    rows = df.sparkSession.createDataFrame(found, "col_x string, col_y string, corr double")
    return rows.withColumn("corr", F.round("corr", digits))


def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Long summary of columns of any type: ``(column_name, stat, value, number)``.

    Every column has count, min and max, whose ``value`` is text in the column's own type, so a large id keeps all its
    digits; numbers also have mean and stddev. ``number`` is the statistic as a rounded double where it is one. Every
    statistic is an aggregate of its own typed column in one pass over the table.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    numeric = {c for c in cols if types[c] in _NUMBERS or types[c].startswith("decimal")}
    aggs, items = [], []
    for i, c in enumerate(cols):
        stats = {"count": F.count(c), "min": F.min(c), "max": F.max(c)}
        if c in numeric:
            stats |= {"mean": F.avg(c), "stddev": F.stddev_samp(c)}
        for s in ("count", "mean", "stddev", "min", "max"):
            if s not in stats:
                continue
            name = f"_{i}_{s}"
            aggs.append(stats[s].alias(name))
            number = F.round(F.col(name).cast("double"), digits) if c in numeric or s == "count" else F.lit(None)
            value = F.lit(None) if s in ("mean", "stddev") else F.col(name)
            items.append(F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"),
                                  value.cast("string").alias("value"), number.cast("double").alias("number")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def histogram(df: DataFrame, c: str, lo: float, hi: float, bins: int, name: str = "rows",
              keep_empty: bool = False) -> DataFrame:
    """Fixed-width bins over ``[lo, hi]``; the top edge falls in the last bin. ``keep_empty``: bins without rows, too.

    Values outside the range are not counted. Binning is a projection and the
    counting a combined group-by, so only ``bins`` rows leave the executors.
    """
    width = (hi - lo) / bins
    x = F.col(c)
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    out = (df.where(x.between(lo, hi)).select(b.alias("bin"))
           .groupBy("bin").agg(F.count(F.lit(1)).alias(name)))
    if keep_empty:
        axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        out = axis.join(out, "bin", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), name)


def share(df: DataFrame, key: str | Sequence[str], name: str = "rows", digits: int = 2) -> DataFrame:
    """Count per key and its percent of all rows.

    The total is a scalar subquery that sums the counts already aggregated; both
    read one exchange of them, so the input is scanned once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    total = counts.agg(F.sum(name)).scalar()
    return counts.withColumn("share_pct", F.round(F.try_divide(F.col(name) * F.lit(100.0), total), digits))


def two_way_counts(df: DataFrame, a: str, b: str, name: str = "rows") -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(name))


def facet_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values of several columns as ``(facet, value)``, in one pass."""
    arr = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in cols])
    return (df.select(F.inline(arr)).where(F.col("value").isNotNull()).distinct()
            .orderBy("facet", "value"))


#: How many times the wanted number of rows the first pass of a sample aims at, since its row count is a guess.
GUESS_SLACK = 16


def _guessed_rows(df: DataFrame) -> int | None:
    """The optimiser's idea of how many rows ``df`` has; it may be far off, and only saves work where it is near."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    stats = plan.queryExecution().optimizedPlan().stats()
    if stats.rowCount().isDefined():
        return int(str(stats.rowCount().get()))
    return int(str(stats.sizeInBytes())) // max(plan.schema().defaultSize(), 1)


def _threshold_sample(df: DataFrame, n: int, score: Column, order: Sequence[Column] = ()) -> DataFrame:
    """The ``n`` rows of least ``score`` (uniform in 0..1), ties in ``order``.

    Only rows below a threshold are kept: they are written once, while the same job counts all rows. Where a guess of
    the row count was good, that one pass over ``df`` is all; else the count now known sets the threshold (for ``n`` rows plus five
    standard deviations) and a second pass follows. So no task sorts more than its share of some ``n`` rows, and every
    reader of the result sees the same rows.
    """
    need = n + 5 * n ** 0.5 + 10
    guess = _guessed_rows(df)
    share = min(1.0, GUESS_SLACK * need / guess) if guess else 1.0
    scored = df.withColumn("__score", score)
    while True:
        seen = Observation()
        under = F.col("__score") < F.lit(share) if share < 1 else F.lit(True)
        kept = cut_lineage(scored.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(under).alias("kept"))
                           .where(under), "sample")
        rows, found = seen.get["rows"], seen.get["kept"]
        if found >= min(n, rows):
            return kept.orderBy("__score", *order).limit(n).drop("__score")
        share = min(1.0, max(need / rows, 8 * share))


def _hash_score(key: Sequence[str], seed: int) -> Column:
    """A number from 0 to 1 from the key's values, each with its length, so that no two keys read alike; null apart."""
    parts = []
    for k in key:
        text = F.col(k).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    digest = F.md5(F.concat(*parts, F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(16 ** 13))


def sample_random(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Uniform sample of exactly ``min(n, rows)`` rows, another one for each seed (random if none is given).

    Every row draws its own score, so equal rows are drawn independently of each other and each of a row's copies has the same chance
    as any other row. The drawn rows are written before use: a task that runs again cannot change the sample.
    """
    return _threshold_sample(df, n, F.rand(random.randrange(1 << 62) if seed is None else seed))


def sample_repeatable(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Sample of ``min(n, rows)`` rows chosen by a hash of key and seed.

    The choice depends only on the data, not on partitioning, so reruns (and a
    recomputation after a lost executor) pick the same rows.
    """
    return _threshold_sample(df, n, _hash_score(key, seed), [F.col(k).asc_nulls_last() for k in key])
