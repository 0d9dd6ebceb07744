"""Exact quantiles by digit-wise selection, without funnelling every distinct value through one task.

Spark's ``percentile`` aggregate keeps a map of every distinct value and merges all of them in a single final task,
which does not survive a high-cardinality column at scale. ``exact_quantiles`` finds the same values (interpolated like
``percentile`` / SQL ``PERCENTILE``) by a radix selection over order-preserving keys:

1. the needed columns alone are written once, each number as a 64-bit integer that sorts as the number does (its IEEE
   bits, negated for negative numbers), so whatever derives the input runs once;
2. each pass is ONE grouped count, combined map-side, of the next 16 bits of all columns and all wanted ranks together.
   A rank's interval shrinks by 16 bits a pass, so four passes settle any double, however many rows, gaps, ties or hot
   values there are. A bucket whose least and greatest key are equal is settled at once, which ends most columns early.

There is no sketch, no sort and no window. At most 65,536 counts a pass and interval reach the driver. NaN sorts above
infinity, as in Spark; -0.0 counts as 0.0.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubjay.session import cut_lineage_observed

#: Bits of a key that one pass settles.
DIGIT = 16
PASSES = 64 // DIGIT


#: Bits of a double's fraction, the bias and the least exponent of a normal number, and the key of NaN: IEEE 754.
FRACTION, BIAS, LEAST = 52, 1023, -1022
NAN_KEY = 0x7FF8 << 48


def order_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns ``k0``, ``k1``, ...: a BIGINT for each of ``cols`` that sorts as the double does; null for null.

    The key of a positive number is its IEEE bit pattern, that of a negative one the negated pattern of its size. Both
    are computed by exact arithmetic (powers of two only), inside whole-stage codegen. -0.0 has the key of 0.0.
    """
    n = range(len(cols))
    x, a, e = ([F.col(f"{name}{i}") for i in n] for name in ("x", "a", "e"))
    two = lambda power: F.pow(F.lit(2.0), power)
    df = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    finite = [F.abs(x[i]) < F.lit(math.inf) for i in n]  # false for NaN, which Spark sorts last
    df = df.select("*", *[F.when(finite[i], F.abs(x[i])).otherwise(F.lit(1.0)).alias(f"a{i}") for i in n])
    # The exponent: a logarithm may be one off beside a power of two.
    df = df.select("*", *[F.greatest(F.floor(F.log2(a[i])), F.lit(LEAST)).alias(f"g{i}") for i in n])
    guess = [F.col(f"g{i}") for i in n]
    df = df.select(*x, *a, *[F.when((two(guess[i]) > a[i]) & (guess[i] > LEAST), guess[i] - 1).when(
        two(guess[i]) * 2 <= a[i], guess[i] + 1).otherwise(guess[i]).alias(f"e{i}") for i in n])
    keys = []
    for i in n:
        fraction = (a[i] / two(e[i]) * F.lit(2.0 ** FRACTION)).cast("bigint")  # has the leading one unless subnormal
        size = (F.when(a[i] == 0, F.lit(0)).when(F.isnan(x[i]), F.lit(NAN_KEY))
                .when(~finite[i], F.lit((2 * BIAS + 1) << FRACTION))
                .otherwise((e[i] + BIAS - 1) * F.lit(1 << FRACTION) + fraction))
        keys.append(F.when(x[i].isNotNull(), F.when(x[i] < 0, -size).otherwise(size)).alias(f"k{i}"))
    return df.select(*keys)


def key_value(key: int) -> float:
    """The double whose order key is ``key``."""
    size = struct.unpack(">d", struct.pack(">q", abs(key)))[0]
    return -size if key < 0 else size


def value_key(value: float) -> int:
    """The order key of a double."""
    size = struct.unpack(">q", struct.pack(">d", abs(value)))[0]
    return -size if value < 0 else size


def key_table(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """The order keys of ``cols``, written once, and how many nulls each column has."""
    cols = list(cols)
    saved, seen = cut_lineage_observed(order_keys(df, cols), {f"k{i}": F.count_if(F.col(f"k{i}").isNull())
                                                             for i in range(len(cols))}, "quantile-keys")
    return saved.toDF(*cols), {c: seen[f"k{i}"] for i, c in enumerate(cols)}


@dataclass
class _Rank:
    """One wanted rank of a column: the interval known to hold it (a key prefix) and the values before that."""

    column: str
    rank: int
    prefix: int | None = None
    below: int = 0
    key: int | None = None


def digit_counts(keys: DataFrame, intervals: Sequence[tuple[str, int | None]], depth: int) -> list[list[tuple]]:
    """For each (column, prefix): (next prefix, values, least key, greatest key), ascending. One pass for all."""
    shift = 64 - DIGIT * (depth + 1)
    found, conditions = [], []
    for i, (c, prefix) in enumerate(intervals):
        inside = F.col(c).isNotNull()
        if prefix is not None:
            inside = inside & (F.shiftright(F.col(c), shift + DIGIT) == F.lit(prefix))
        conditions.append(inside)
        found.append(F.struct(F.lit(i).alias("i"), F.shiftright(F.col(c), shift).alias("p"), F.col(c).alias("k")))
    if len(found) == 1:
        hits = keys.where(conditions[0]).select(found[0].alias("e"))
    else:
        hits = keys.select(F.explode(F.array_compact(F.array(*map(F.when, conditions, found)))).alias("e"))
    counts = hits.select("e.*").groupBy("i", "p").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("least"), F.max("k").alias("most"))
    out: list[list[tuple]] = [[] for _ in intervals]
    table = counts.toArrow()
    for i, *entry in zip(*[table.column(c).to_pylist() for c in ("i", "p", "n", "least", "most")]):
        out[i].append(tuple(entry))
    return [sorted(x) for x in out]


def select_keys(keys: DataFrame, plan: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """``{column: [p, ...]}`` -> ``{column: [value, ...]}`` over the non-null values of a ``key_table``."""
    todo = [_Rank(c, 0) for c in plan]
    ranks: dict[tuple[str, int], _Rank] = {}
    sizes: dict[str, int] = {}
    for depth in range(PASSES):
        if not todo:
            break
        intervals = list(dict.fromkeys((r.column, r.prefix) for r in todo))
        counted = dict(zip(intervals, digit_counts(keys, intervals, depth)))
        if not depth:  # the first pass also tells how many values there are, and so which ranks are wanted
            sizes = {c: sum(n for _, n, _, _ in counted[c, None]) for c in plan}
            for c, ps in plan.items():
                for p in ps if sizes[c] else ():
                    for r in (math.floor(p * (sizes[c] - 1)), math.ceil(p * (sizes[c] - 1))):
                        ranks[c, r] = _Rank(c, r)
            todo = list(ranks.values())
        for r in todo:
            for prefix, n, least, most in counted[r.column, r.prefix]:
                if r.rank < r.below + n:
                    r.prefix, r.key = prefix, least if least == most else None
                    break
                r.below += n
        todo = [r for r in todo if r.key is None]
    out: dict[str, list[float | None]] = {}
    for c, ps in plan.items():
        out[c] = []
        for p in ps:
            if not sizes[c]:
                out[c].append(None)
                continue
            pos = p * (sizes[c] - 1)
            lo, hi = ranks[c, math.floor(pos)], ranks[c, math.ceil(pos)]
            a, b = key_value(lo.key), key_value(hi.key)
            out[c].append(a if lo.key == hi.key else (hi.rank - pos) * a + (pos - lo.rank) * b)
    return out


def exact_quantiles(df: DataFrame, plan: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """``{column: [p, ...]}`` -> ``{column: [value, ...]}`` over the non-null values."""
    return select_keys(key_table(df, list(plan))[0], plan) if plan else {}


def rank_errors(df: DataFrame, values: Mapping[str, Mapping[float, object]]) -> DataFrame:
    """``(column_name, p, rank_error)``: how far each claimed quantile is from rank ``p * n``, as a share of ``n``.

    One aggregate counts, exactly, the values below and up to each claim; an error of 0 means the claim covers the
    rank. ``values``: column -> {p: claimed value}; null values are ignored, as by the quantiles themselves.
    """
    aggs, items = [], []
    for i, (c, claims) in enumerate(values.items()):
        aggs.append(F.count(c).alias(f"n{i}"))
        for j, (p, value) in enumerate(claims.items()):
            aggs += [F.count_if(F.col(c) < F.lit(value)).alias(f"b{i}_{j}"),
                     F.count_if(F.col(c) <= F.lit(value)).alias(f"u{i}_{j}")]
            n = F.col(f"n{i}")
            gap = F.greatest(F.lit(0.0), F.col(f"b{i}_{j}") - n * F.lit(p), n * F.lit(p) - F.col(f"u{i}_{j}"))
            items.append(F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("p"),
                                  F.try_divide(gap, n).alias("rank_error")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))
