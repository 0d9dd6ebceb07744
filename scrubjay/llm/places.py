"""Places of rows in a total order, without one task that sees all rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


def ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned by ``keys`` (nulls first) and sorted within partitions.

    Only rows that are equal in all keys must share a partition, so a hot leading key is split by the later ones.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right`` where ``keys`` agree, null with null."""
    other = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return left.join(other, match, how).drop(*[f"_of_{k}" for k in keys])


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``pos`` (from 0, within its group, under ``order``) and ``n`` (rows of its group).

    ``order`` should end in something that tells equal rows apart, so that copies can be split too. The rows are range
    partitioned by group and order and written once, each with its place in its partition; places of a group's first
    row in each partition (one small row for each) then turn those into places in the group.
    """
    rows = saved(ordered(df, [*group, *order]).withColumn("_at", F.monotonically_increasing_id()), name).withColumn(
        "_part", F.shiftright("_at", 33))
    runs = rows.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", *group, (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0)))
                       .alias("_zero"), F.sum("_rows").over(whole).alias("n"))
    return joined(rows, runs, ["_part", *group]).select(*df.columns, (F.col("_at") - F.col("_zero")).alias("pos"), "n")
