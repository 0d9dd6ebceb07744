"""Predicate builders (filters as ``Column`` expressions, never SQL text).

Values are bound as literals through ``F.lit`` / ``isin``, so quoting and
escaping problems of string-built SQL cannot occur.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubjay.functions.stats import col_


def all_of(preds: Iterable[Column | None]) -> Column:
    """AND of the given predicates; ``None`` entries are skipped; empty -> true."""
    kept = [p for p in preds if p is not None]
    return reduce(and_, kept) if kept else F.lit(True)


def in_range(c: str | Column, lo=None, hi=None) -> Column | None:
    """Inclusive range (SQL ``BETWEEN``); a missing bound means no filter."""
    x = col_(c)
    if lo is not None and hi is not None:
        return x.between(F.lit(lo), F.lit(hi))
    if lo is not None:
        return x >= F.lit(lo)
    if hi is not None:
        return x <= F.lit(hi)
    return None


def in_values(c: str | Column, values: Sequence | None, all_label: str | None = None) -> Column | None:
    """``c IN (values)``; an empty list or one holding ``all_label`` means no filter."""
    if values is None:
        return None
    values = list(values)
    if not values or (all_label is not None and all_label in values):
        return None
    return col_(c).isin(values)


def not_null(*cols: str) -> Column:
    return all_of(F.col(c).isNotNull() for c in cols)


def delay_filter(metric: str = "arr_delay", months: tuple[int, int] | None = None,
                 min_delay: float | None = None, carrier=None) -> Column:
    """Flight filter: metric present; a month range, minimum delay or carrier only where given."""
    return all_of([
        F.col(metric).isNotNull(),
        in_range("month", *(months or (None, None))),
        in_range(metric, lo=min_delay),
        F.col("carrier") == F.lit(carrier) if carrier is not None else None,
    ])


def gem_filter(cut: str | None = None) -> Column:
    """Diamond filter: price, carat and cut present, optional cut."""
    return all_of([
        not_null("price", "carat", "cut"),
        F.col("cut") == F.lit(cut) if cut is not None else None,
    ])


def facet_filter(ranges: Mapping[str, tuple] | None = None,
                 facets: Mapping[str, Sequence] | None = None,
                 all_labels: Mapping[str, str] | None = None) -> Column:
    """Multi-facet filter: inclusive numeric ranges plus optional IN lists."""
    preds: list[Column | None] = []
    for c, (lo, hi) in (ranges or {}).items():
        preds.append(in_range(c, lo, hi))
    for c, values in (facets or {}).items():
        preds.append(in_values(c, values, (all_labels or {}).get(c)))
    return all_of(preds)
