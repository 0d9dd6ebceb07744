"""Derived columns: bands, 0/1 flags, rounded differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubjay.functions.stats import col_

# Weekly GenAI-hours bands, right-closed upper edges and labels.
AI_USAGE_EDGES = (2, 5, 10, 20)
AI_USAGE_LABELS = ("0-2 hours", "2-5 hours", "5-10 hours", "10-20 hours", "20+ hours")


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands: ``x <= edges[0] -> labels[0]``, ..., else ``labels[-1]``.

    A null value gets a null band (it is not put in the last band).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = col_(c)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x <= edge, label)
    return out.otherwise(labels[-1])


def order_key(c: str | Column, labels: Sequence[str]) -> Column:
    """Sort key giving ``labels`` their listed order (unknown values last)."""
    x = col_(c)
    out = None
    for i, label in enumerate(labels, start=1):
        out = F.when(x == label, i) if out is None else out.when(x == label, i)
    return out


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (null counts as 0)."""
    return F.when(cond, 1).otherwise(0)


def rounded_diff(a: str, b: str, digits: int = 3) -> Column:
    return F.round(F.col(a) - F.col(b), digits)


def student_features(df: DataFrame) -> DataFrame:
    """GPA change, usage band and the four threshold flags, in one projection."""
    return df.withColumns({
        "gpa_change": rounded_diff("post_semester_gpa", "pre_semester_gpa", 3),
        "ai_usage_band": band("weekly_genai_hours", AI_USAGE_EDGES, AI_USAGE_LABELS),
        "high_dependency_flag": flag(F.col("perceived_ai_dependency") >= 7),
        "high_anxiety_flag": flag(F.col("anxiety_level_during_exams") >= 7),
        "high_burnout_flag": flag(F.col("burnout_risk_level") == "High"),
        "strong_retention_flag": flag(F.col("skill_retention_score") >= 80),
    })
