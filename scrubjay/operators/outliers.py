"""Quantiles, IQR and z-score outlier operators.

Bounds are one-row aggregates attached to the rows as scalar subqueries, so
flagging is a single narrow projection over the table (no join, no driver
round trip, and the statistic is computed once per query).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubjay.functions.quantiles import exact_quantiles
from scrubjay.functions.stats import (DEFAULT_APPROX_ACCURACY, STATS_COL, attach, collect_stats, literal_struct,
                                     quantile)

# method: "exact" (bounded distributed selection, default), "percentile" (Spark's
# built-in exact aggregate, memory per distinct value) or "approx" (GK sketch).


def quantiles(df: DataFrame, c: str, ps: Sequence[float], method: str = "exact",
              accuracy: int = DEFAULT_APPROX_ACCURACY, prefix: str = "q") -> DataFrame:
    """One row with one column per requested quantile."""
    names = [f"{prefix}{int(round(p * 100)):02d}" for p in ps]
    if method == "exact":
        vals = exact_quantiles(df, {c: list(ps)})[c]
        return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for v, n in zip(vals, names)])
    arr = df.agg(quantile(c, list(ps), method, accuracy).alias("_q"))
    return arr.select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def fence_values(q1, q3, k: float = 1.5) -> dict[str, float | None]:
    """Quartiles, range and fences; all null where there are no values."""
    if q1 is None or q3 is None:
        return {"q1": None, "q3": None, "iqr": None, "lower_bound": None, "upper_bound": None}
    iqr = q3 - q1
    return {"q1": q1, "q3": q3, "iqr": iqr, "lower_bound": q1 - k * iqr, "upper_bound": q3 + k * iqr}


def iqr_bounds(df: DataFrame, c: str, k: float = 1.5, method: str = "exact",
               accuracy: int = DEFAULT_APPROX_ACCURACY) -> Column:
    """The IQR statistics as a struct of literals, computed once (bounded driver step)."""
    if method == "exact":
        q1, q3 = exact_quantiles(df, {c: [0.25, 0.75]})[c]
    else:
        row = df.agg(quantile(c, [0.25, 0.75], method, accuracy).alias("_q")).first()
        q1, q3 = (float(v) if v is not None else None for v in (row["_q"] or [None, None]))
    return literal_struct(fence_values(q1, q3, k))


def iqr_report(df: DataFrame, c: str, k: float = 1.5, method: str = "exact", digits: int = 2) -> DataFrame:
    """One row: total rows, low and high outlier counts, rounded fences."""
    b = F.col(STATS_COL)
    x = F.col(c)
    return attach(df.select(c), iqr_bounds(df, c, k, method)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(x < b["lower_bound"]).alias("low_outliers"),
        F.count_if(x > b["upper_bound"]).alias("high_outliers"),
        F.any_value(b).alias("_b"),
    ).select("total", "low_outliers", "high_outliers",
             F.round(F.col("_b")["lower_bound"], digits).alias("lower_bound"),
             F.round(F.col("_b")["upper_bound"], digits).alias("upper_bound"))


def fences(q1: float | None, q3: float | None, k: float = 1.5) -> Column:
    """IQR statistics from known quartiles, as a struct of literals (for ``iqr_flag(bounds=...)``)."""
    return literal_struct(fence_values(q1, q3, k))


def iqr_flag(df: DataFrame, c: str, flag: str | None = None, k: float = 1.5, method: str = "exact",
             accuracy: int = DEFAULT_APPROX_ACCURACY, as_int: bool = False,
             bounds_prefix: str | None = None, stats_from: DataFrame | None = None,
             bounds: Column | None = None) -> DataFrame:
    """Flag values outside the IQR fences; a null value is not an outlier.

    ``bounds_prefix`` also adds the fences as ``<prefix>lower_bound`` / ``upper_bound``.
    ``stats_from`` computes the fences on another frame (default: ``df``);
    ``bounds`` passes fences already computed (see ``fences``).
    """
    if bounds is None:
        bounds = iqr_bounds(stats_from if stats_from is not None else df, c, k, method, accuracy)
    b = F.col(STATS_COL)
    x = F.col(c)
    out = x.isNotNull() & ((x < b["lower_bound"]) | (x > b["upper_bound"]))
    out = F.coalesce(out, F.lit(False))
    cols = {flag or f"{c}_outlier": out.cast("int") if as_int else out}
    if bounds_prefix is not None:
        cols[f"{bounds_prefix}lower_bound"] = b["lower_bound"]
        cols[f"{bounds_prefix}upper_bound"] = b["upper_bound"]
    return attach(df, bounds).withColumns(cols).drop(STATS_COL)


def zscore(df: DataFrame, c: str, threshold: float | None = 3.0, digits: int = 2,
           name: str = "z_score") -> DataFrame:
    """z-score against the mean and sample standard deviation of the non-null values.

    With ``threshold`` set, keeps rows whose raw ``|z|`` exceeds it; the value is
    rounded for output only. A zero deviation gives a null z (never an error).
    """
    s = collect_stats(df, {"mu": F.avg(c), "sd": F.stddev_samp(c)})
    st = F.col(STATS_COL)
    z = F.try_divide(F.col(c) - st["mu"], st["sd"])
    out = attach(df.where(F.col(c).isNotNull()), s).withColumn("_z", z).drop(STATS_COL)
    if threshold is not None:
        out = out.where(F.abs(F.col("_z")) > threshold)
    return out.withColumn(name, F.round(F.col("_z"), digits)).drop("_z")
