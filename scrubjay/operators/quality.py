"""Missing-value audits and declarative PASS/FAIL validation.

``validate`` compiles every rule on a table into aggregate expressions of ONE
``agg`` (one scan), plus one grouped pass for unique-key rules, then unpivots
the single metrics row into ``(check_name, result, detail)`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubjay.functions.stats import STATS_COL, attach, percent

# --- audits ---------------------------------------------------------------------


def null_audit(df: DataFrame, cols: Sequence[str], digits: int = 2,
               missing_prefix: str = "missing_", pct_prefix: str = "pct_") -> DataFrame:
    """Wide one-row audit: ``total_rows``, then per column a null count and a percent."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{missing_prefix}{c}") for c in cols]
    aggs += [F.round(percent(F.count_if(F.col(c).isNull()), total), digits).alias(f"{pct_prefix}{c}")
             for c in cols]
    return df.agg(*aggs)


def null_audit_long(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Long audit, one row per column: ``column_name, total_rows, missing, pct_missing``."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("total_rows"),
                      F.col(f"_m{i}").alias("missing"),
                      F.round(percent(F.col(f"_m{i}"), F.col("_n")), digits).alias("pct_missing"))
             for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*items)))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column, one row, column names kept."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (cols or df.columns)])


def invalid_values(df: DataFrame, c: str, allowed: Sequence) -> DataFrame:
    """Values outside ``allowed`` with their row counts (null is not judged)."""
    return (df.where(~F.col(c).isin(list(allowed)))
            .groupBy(c).agg(F.count(F.lit(1)).alias("invalid_rows")))


def distinct_values(df: DataFrame, c: str, drop_null: bool = True) -> DataFrame:
    out = df.select(c)
    if drop_null:
        out = out.where(F.col(c).isNotNull())
    return out.distinct().orderBy(F.col(c).asc_nulls_last())


# --- validation rules -------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """A named check.

    ``metrics``: name -> aggregate expression over the table (one scan for all rules).
    ``keys``: if set, the metrics aggregate ``groupBy(keys).count()`` (column ``n``)
    instead - a second, grouped pass, used by unique-key rules.
    ``needs_column``: the check passes only if this column exists (schema check).
    ``passed`` / ``detail``: expressions over the metric columns.
    """

    name: str
    metrics: dict[str, Column]
    passed: Callable[[dict[str, Column]], Column]
    detail: Callable[[dict[str, Column]], Column]
    keys: tuple[str, ...] = field(default=())
    needs_column: str | None = None


def _fmt(fmt: str, *cols: Column) -> Column:
    return F.format_string(fmt, *cols)


def row_count(name: str, minimum: int, strict: bool = True, detail: str = "%d") -> Rule:
    """Row count ``> minimum`` (strict) or ``>= minimum``."""
    def passed(m):
        return m["n"] > minimum if strict else m["n"] >= minimum
    return Rule(name, {"n": F.count(F.lit(1))}, passed, lambda m: _fmt(detail, m["n"]))


def count_rule(name: str, bad: Column, detail: str = "%d") -> Rule:
    """PASS when no row satisfies ``bad`` (a null ``bad`` does not count)."""
    return Rule(name, {"bad": F.count_if(bad)}, lambda m: m["bad"] == 0, lambda m: _fmt(detail, m["bad"]))


def no_nulls(name: str, c: str, detail: str = "%d") -> Rule:
    return count_rule(name, F.col(c).isNull(), detail)


def allowed_values(name: str, c: str, allowed: Sequence, detail: str = "%d invalid rows") -> Rule:
    return count_rule(name, ~F.col(c).isin(list(allowed)), detail)


def positive(name: str, c: str, detail: str = "%d invalid rows") -> Rule:
    return count_rule(name, F.col(c) <= 0, detail)


def non_negative(name: str, c: str, detail: str = "%d invalid rows") -> Rule:
    return count_rule(name, F.col(c) < 0, detail)


def within(name: str, cols: Sequence[str], lo, hi, detail: str = "%d invalid rows") -> Rule:
    """Every listed column within ``[lo, hi]``; counts rows with any value outside."""
    bad = None
    for c in cols:
        b = (F.col(c) < lo) | (F.col(c) > hi)
        bad = b if bad is None else (bad | b)
    return count_rule(name, bad, detail)


def missing_below(name: str, c: str, max_pct: float, detail: str = "%.2f%%") -> Rule:
    """Null percent below ``max_pct``; an empty table gives a null percent -> FAIL."""
    pct = percent(F.count_if(F.col(c).isNull()), F.count(F.lit(1)))
    return Rule(name, {"pct": pct}, lambda m: F.coalesce(m["pct"] < max_pct, F.lit(False)),
                lambda m: _fmt(detail, F.round(m["pct"], 2)))


def unique_key(name: str, keys: Sequence[str], count: str = "groups", detail: str = "%d") -> Rule:
    """No duplicate keys. ``count='groups'``: key groups seen twice or more;
    ``count='rows'``: rows minus distinct keys (null is a key value)."""
    if count == "groups":
        metric = F.count_if(F.col("n") > 1)
    elif count == "rows":
        metric = (F.sum("n") - F.count(F.lit(1))).cast("bigint")
    else:
        raise ValueError("count must be 'groups' or 'rows'")
    return Rule(name, {"dup": F.coalesce(metric, F.lit(0).cast("bigint"))}, lambda m: m["dup"] == 0,
                lambda m: _fmt(detail, m["dup"]), keys=tuple(keys))


def column_exists(name: str, c: str, detail_count: Column | None = None, detail: str = "%d") -> Rule:
    """PASS when column ``c`` is in the schema; the detail may count something about it."""
    metrics = {"cnt": detail_count if detail_count is not None else F.lit(0)}
    return Rule(name, metrics, lambda m: F.lit(True), lambda m: _fmt(detail, m["cnt"]), needs_column=c)


def ordered(name: str, lower: str, upper: str, detail: str = "lower=%.2f, upper=%.2f") -> Rule:
    """Bound columns (constant per table) satisfy ``lower < upper``."""
    return Rule(name, {"lo": F.min(lower).cast("double"), "hi": F.max(upper).cast("double")},
                lambda m: F.coalesce(m["lo"] < m["hi"], F.lit(False)),
                lambda m: _fmt(detail, F.round(m["lo"], 2), F.round(m["hi"], 2)))


def _key_metrics(df: DataFrame, grouped: dict[tuple[str, ...], dict[str, Column]]) -> Column:
    """The metrics of all key sets as one struct, from one pass and one shuffle of the rows.

    Each row yields one small record for each key set, (number of the set, 128-bit digest of the key); records are counted
    together, combined map-side. A lone key set is counted by its own columns.
    """
    if len(grouped) == 1:
        (keys, exprs), = grouped.items()
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return counts.agg(F.struct(*[e.alias(a) for a, e in exprs.items()]).alias("s")).scalar()
    records = []
    for i, keys in enumerate(grouped):
        parts = [x for c in keys for x in (F.col(c).isNull(), F.col(c))]
        records.append(F.struct(F.lit(i).alias("i"), *[F.xxhash64(F.lit(seed), F.lit(i), *parts).alias(f"d{seed}")
                                                       for seed in (1, 2)]))
    counts = df.select(F.inline(F.array(*records))).groupBy("i", "d1", "d2").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("i").agg(*[e.alias(a) for exprs in grouped.values() for a, e in exprs.items()])
    return found.agg(F.struct(*[
        F.coalesce(F.max(F.when(F.col("i") == i, F.col(a))), F.lit(0)).cast("bigint").alias(a)
        for i, exprs in enumerate(grouped.values()) for a in exprs]).alias("s")).scalar()


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate every rule on ``df``: one aggregate pass, and one grouped pass for all unique-key rules together."""
    plain: list[Column] = []
    grouped: dict[tuple[str, ...], dict[str, Column]] = {}
    names: list[dict[str, str]] = []
    for i, r in enumerate(rules):
        mapping = {m: f"_r{i}_{m}" for m in r.metrics}
        names.append(mapping)
        if r.needs_column is not None and r.needs_column not in df.columns:
            # Nothing can be computed from a missing column: its metrics are 0 and the check fails.
            plain += [F.lit(0).cast("bigint").alias(mapping[m]) for m in r.metrics]
            continue
        for m, e in r.metrics.items():
            if r.keys:
                grouped.setdefault(r.keys, {})[mapping[m]] = e
            else:
                plain.append(e.alias(mapping[m]))
    row = df.agg(*plain) if plain else df.sparkSession.range(1).select()
    if grouped:
        row = attach(row, _key_metrics(df, grouped)).withColumns(
            {a: F.col(STATS_COL)[a] for exprs in grouped.values() for a in exprs}).drop(STATS_COL)
    items = []
    for r, mapping in zip(rules, names):
        m = {k: F.col(v) for k, v in mapping.items()}
        ok = r.passed(m)
        if r.needs_column is not None:
            ok = F.lit(r.needs_column in df.columns) & ok
        items.append(F.struct(F.lit(r.name).alias("check_name"),
                              F.when(ok, "PASS").otherwise("FAIL").alias("result"),
                              r.detail(m).alias("detail")))
    return row.select(F.inline(F.array(*items)))


def validate_many(parts: Sequence[tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """Union of per-table reports (one aggregate per table)."""
    out = None
    for df, rules in parts:
        rep = validate(df, rules)
        out = rep if out is None else out.unionByName(rep)
    return out


# Fill strategies of the missing-value decision table.
STRATEGY_NONE = "none needed"
STRATEGY_LEAVE = "leave null or drop column"
STRATEGY_NUMERIC = "fill with median"
STRATEGY_CATEGORY = "fill with mode or Unknown"
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def fill_recommendation(df: DataFrame, cols: Sequence[str] | None = None, max_fill_pct: float = 30.0,
                        digits: int = 2) -> DataFrame:
    """Per column: type, null count and percent, and the fill strategy of the decision table.

    No gaps -> none needed; more than ``max_fill_pct`` percent missing -> leave
    null or drop the column; numeric -> median (robust to skew); other types ->
    mode or an "Unknown" category. One aggregate pass over the table.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    audit = null_audit_long(df, cols, digits)
    kind = F.create_map(*[v for c in cols for v in (F.lit(c), F.lit(types[c]))])
    dtype = kind[F.col("column_name")]
    strategy = (F.when(F.col("missing") == 0, STRATEGY_NONE)
                .when(percent(F.col("missing"), F.col("total_rows")) > max_fill_pct, STRATEGY_LEAVE)
                .when(dtype.isin(list(_NUMERIC)), STRATEGY_NUMERIC)
                .otherwise(STRATEGY_CATEGORY))
    return audit.select("column_name", dtype.alias("data_type"), "missing", "pct_missing",
                        strategy.alias("strategy"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))
