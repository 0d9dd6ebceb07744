"""Deduplication, missing values and type fixing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubjay.functions.quantiles import key_table, select_keys
from scrubjay.functions.stats import DEFAULT_APPROX_ACCURACY, STATS_COL, attach, collect_stats, literal_struct, quantile
from scrubjay.session import cut_lineage_observed


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


# --- duplicates -----------------------------------------------------------------

def _digest(cols: Sequence[str]) -> list[Column]:
    """A 128-bit digest of some columns, as two numbers; equal values have equal digests, null counts as a value."""
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"__d{seed}") for seed in (1, 2)]


def _split_repeated(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """``df`` as rows whose key digest stands alone and rows whose digest repeats (None if there are none).

    Only digests are shuffled, 16 bytes a row and combined map-side. Those that repeat are written once and marked by a
    join whose side Spark broadcasts while it is small; so rows without a double never move.
    """
    marks = ["__d1", "__d2"]
    counts = df.select(*_digest(keys)).groupBy(*marks).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice, seen = cut_lineage_observed(counts.select(*marks), {"digests": F.count(F.lit(1))}, "repeated-digests")
    if not seen["digests"]:
        return df, None
    marked = df.select("*", *_digest(keys))
    return (marked.join(twice, marks, "left_anti").select(*df.columns),
            marked.join(twice, marks, "left_semi").select(*df.columns))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that repeat in every column.

    Rows whose digest stands alone pass as they are; the others alone are compared by their values (so a clash of digests
    loses nothing), where copies of a hot row already meet map-side. ``df`` is read once for the digests and once or
    twice for the rows.
    """
    alone, repeated = _split_repeated(df, df.columns)
    return alone if repeated is None else alone.unionAll(repeated.distinct())


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one whole row per key; which row survives is not defined (use ``dedup_keep_first``).

    As in ``dedup_rows`` only rows whose key repeats are shuffled.
    """
    alone, repeated = _split_repeated(df, list(keys))
    return alone if repeated is None else alone.unionAll(repeated.dropDuplicates(list(keys)))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     total_order: bool = False) -> DataFrame:
    """Keep the first row of every key group under ``order``.

    The order is extended by all remaining columns, so the survivor is always
    the same row. A caller that declares ``order`` to be total (no two rows of a
    key tie in it unless they are equal) spares the shuffle all columns that the
    result's reader does not use. Spark plans ``row_number() ... = 1`` with a partial
    WindowGroupLimit before the shuffle: every map task already keeps only its
    first row per key, so a hot key sends one row per task, not all its rows.
    """
    keys = list(keys)
    used = set(keys) | {o for o in order if isinstance(o, str)}
    rest = [] if total_order else [F.col(c).asc_nulls_last() for c in df.columns if c not in used]
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order), *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "num_records") -> DataFrame:
    """Rows per key (null keys form their own group); partial aggregation happens map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def find_duplicates(df: DataFrame, keys: Sequence[str], limit: int | None = 10) -> DataFrame:
    """Keys seen more than once with their counts, worst first (ties by key)."""
    out = key_counts(df, keys).filter(F.col("num_records") > 1)
    out = out.orderBy(F.col("num_records").desc(), *[F.col(k).asc_nulls_last() for k in keys])
    return out.limit(limit) if limit else out


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys (null counts as a value), surplus rows, duplicated keys."""
    kc = key_counts(df, keys, "n")
    return kc.agg(
        F.sum("n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


# --- missing values -------------------------------------------------------------

def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def _fill(df: DataFrame, stats: Mapping[str, Column], keep_type: bool, suffix: str | None,
          row: Column | None = None) -> DataFrame:
    """Coalesce each column with its one-row statistic (computed once, inlined as literals)."""
    if not stats:
        return df
    if row is None:
        row = collect_stats(df, dict(stats))
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    for c in stats:
        value = F.col(STATS_COL)[c]
        if keep_type:
            value = value.cast(types[c])
        cols[f"{c}{suffix}" if suffix else c] = F.coalesce(F.col(c), value)
    return attach(df, row).withColumns(cols).drop(STATS_COL)


def fill_mean(df: DataFrame, cols: Sequence[str], keep_type: bool = False, suffix: str | None = None) -> DataFrame:
    """Fill nulls with the column mean.

    ``keep_type=False`` follows SQL ``COALESCE`` (an int column becomes double);
    ``keep_type=True`` follows ``fillna`` (the mean is cast to the column type).
    """
    return _fill(df, {c: F.avg(c) for c in cols}, keep_type, suffix)


def fill_median(df: DataFrame, cols: Sequence[str], method: str = "exact",
                accuracy: int = DEFAULT_APPROX_ACCURACY, keep_type: bool = False,
                suffix: str | None = None,
                null_counts: Mapping[str, int] | None = None) -> DataFrame:
    """Fill nulls with the median of each column.

    ``exact`` (default) writes the columns' order keys once and selects all medians
    from them together; ``percentile`` / ``approx`` compute every median in one aggregate.
    A column's type depends on the parameters alone: double, or its own type with
    ``keep_type``. The nulls, counted during that write (or given as ``null_counts``, or
    counted in a pass of their own), spare a gap-free column the median job.
    """
    cols = list(cols)
    if not cols:
        return df
    nulls, keys = null_counts, None
    if method == "exact" and (nulls is None or any(nulls[c] for c in cols)):
        keys, nulls = key_table(df, cols)
    if nulls is None:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    whole = [c for c in cols if not nulls[c]]
    types = {f.name: f.dataType for f in df.schema.fields}
    df = df.withColumns({f"{c}{suffix}" if suffix else c: F.col(c).cast(types[c] if keep_type else "double")
                         for c in whole})
    cols = [c for c in cols if nulls[c]]
    if not cols:
        return df
    if method == "exact":
        med = select_keys(keys, {c: [0.5] for c in cols})
        row = literal_struct({c: med[c][0] for c in cols})
        return _fill(df, {c: F.lit(None) for c in cols}, keep_type, suffix, row=row)
    values = {c: quantile(c, 0.5, method, accuracy).cast("double") for c in cols}
    return _fill(df, values, keep_type, suffix)


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Most frequent non-null value of each column (ties -> smallest), as literals of the column's type.

    One pass counts (column, value) pairs, combined map-side; one row per column leaves it.
    """
    cols = list(cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    # One struct field per column keeps each value in its own type.
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), *[
        (F.col(c) if j == i else F.lit(None).cast(types[d])).alias(f"v{j}") for j, d in enumerate(cols)])
        for i, c in enumerate(cols)])).alias("e")).select("e.*")
    counted = rows.groupBy("i", *[f"v{j}" for j in range(len(cols))]).agg(F.count(F.lit(1)).alias("n")).where(
        F.coalesce(*[F.when(F.col("i") == j, F.col(f"v{j}").isNotNull()) for j in range(len(cols))]))
    first = counted.groupBy("i").agg(*[F.min_by(f"v{j}", F.struct(-F.col("n"), F.col(f"v{j}"))).alias(f"v{j}")
                                       for j in range(len(cols))])
    found = {r["i"]: r[f"v{r['i']}"] for r in first.collect()}
    return {c: F.lit(found.get(i)).cast(types[c]) for i, c in enumerate(cols)}


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls with each column's most frequent value; a column without values stays null."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in mode_values(df, cols).items()})


def missing_indicator(df: DataFrame, cols: Sequence[str], suffix: str = "_missing") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in cols})


def mean_vs_median(df: DataFrame, c: str, accuracy: int = DEFAULT_APPROX_ACCURACY) -> DataFrame:
    """Mean (2 places) beside the approximate median of the non-null values."""
    return df.where(F.col(c).isNotNull()).agg(
        F.round(F.avg(c), 2).alias(f"mean_{c}"),
        F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}"),
    )


# --- types ----------------------------------------------------------------------

def cast_columns(df: DataFrame, plan: Mapping[str, str], safe: bool = True) -> DataFrame:
    """Cast columns per ``{column: type}`` in one projection.

    ``safe`` uses ``try_cast`` (a bad value becomes null instead of failing the
    job under ANSI); pair it with ``cast_failures`` to see how many failed.
    """
    return df.withColumns({c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t)) for c, t in plan.items()})


def cast_failures(df: DataFrame, plan: Mapping[str, str]) -> DataFrame:
    """Long report: per planned column, non-null inputs and how many failed to cast."""
    aggs = []
    for c, t in plan.items():
        aggs += [F.count(F.col(c)).alias(f"{c}__in"),
                 F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}__bad")]
    row = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("target_type"),
                      F.col(f"{c}__in").alias("non_null_values"), F.col(f"{c}__bad").alias("failed_casts"))
             for c, t in plan.items()]
    return row.select(F.inline(F.array(*items)))
