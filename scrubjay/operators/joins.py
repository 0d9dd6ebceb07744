"""Joins of a fact table to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Fact-to-dimension join without a hint.

    The optimiser broadcasts a dimension whose size in bytes (estimated, or
    measured by AQE at run time) is below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles it otherwise, splitting skewed partitions; nothing is counted
    while the plan is built.
    """
    return fact.join(dim, on, how)
