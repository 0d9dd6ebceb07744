"""Statistics expressions.

Aggregates are returned as ``Column`` objects so callers can put many of them
into a single ``agg`` (one scan). One-row statistics reach the rows they
describe without a join in one of two ways: as a Spark scalar subquery
(``DataFrame.scalar()``, lazy, re-run by every job that contains it) or, where
a statistic feeds several jobs, computed once by ``collect_stats`` and inlined
as typed literals (one row reaches the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default accuracy of Spark's percentile_approx (relative rank error 1/accuracy).
DEFAULT_APPROX_ACCURACY = 10000


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as DOUBLE; null when ``whole`` is 0 (no ANSI error)."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def percent_where(cond: Column) -> Column:
    """Percent of rows meeting ``cond``."""
    return percent(F.count_if(cond), F.count(F.lit(1)))


def rate_pct(flag: str | Column) -> Column:
    """``100 * avg(flag)`` for a 0/1 flag, as DOUBLE."""
    return F.avg(col_(flag)).cast("double") * F.lit(100.0)


def quantile(c: str | Column, p: float | Sequence[float], method: str = "percentile",
             accuracy: int = DEFAULT_APPROX_ACCURACY) -> Column:
    """Quantile as an aggregate ``Column`` (usable per group).

    ``percentile``: Spark's exact interpolated percentile (= SQL ``PERCENTILE``,
    DuckDB ``quantile_cont``); its buffer holds every distinct value, so keep it
    for small groups. ``approx``: Greenwald-Khanna sketch, bounded memory, rank
    error ``n / accuracy``. For an exact whole-table quantile at scale use
    ``scrubjay.functions.quantiles.exact_quantiles``.
    """
    x = col_(c)
    ps = F.array(*[F.lit(float(v)) for v in p]) if isinstance(p, (list, tuple)) else F.lit(float(p))
    if method == "percentile":
        return F.percentile(x, ps)
    if method == "approx":
        return F.percentile_approx(x, ps, accuracy)
    raise ValueError(f"unknown quantile method {method!r}; use 'percentile' or 'approx'")


def collect_stats(df: DataFrame, aggs: dict[str, Column]) -> Column:
    """Run a one-row aggregate now and return it as a struct of typed literals.

    Used by pipelines where the statistic feeds several later jobs: a scalar
    subquery would be executed again inside every job that contains it, a
    literal is computed once. Only one row (one value per statistic) reaches
    the driver.
    """
    stats = df.agg(*[v.alias(k) for k, v in aggs.items()])
    row = stats.first()
    types = {f.name: f.dataType for f in stats.schema.fields}
    return F.struct(*[F.lit(row[k]).cast(types[k]).alias(k) for k in aggs])


def literal_struct(values: dict[str, float | None]) -> Column:
    """A struct of DOUBLE literals (statistics computed by a bounded driver-side step)."""
    return F.struct(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


STATS_COL = "_scrubjay_stats"


def attach(df: DataFrame, stats: Column, name: str = STATS_COL) -> DataFrame:
    """Bind a (struct-valued) scalar subquery to ``df`` as one temporary column.

    Referencing the subquery through this column makes Spark execute it once;
    repeating ``stats["field"]`` on the subquery expression itself would plan
    one subquery per reference. Drop the column when done.
    """
    return df.withColumn(name, stats)
