"""One table of mergeable states for all student reports.

``report_cube`` reads the cleaned rows once and keeps, for every combination of facets and usage band that occurs, the
row count, each measure's count and sum, and the flags' sums. A report is then a filter and a roll-up of that table,
which has at most as many rows as there are combinations of categories, not students. States add up, so the cube of new rows is
merged into an old one (``merge``) without reading the old rows again.

Sums of doubles are added in another order than over the rows, so unrounded averages may differ in the last bits.
Filters may use any facet and the band; a filter on a measure (a range of hours) needs the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubjay.operators import analysis
from scrubjay.operators.features import AI_USAGE_LABELS, order_key
from scrubjay.plans.reports import STUDENT_FACETS

DIMENSIONS = (*STUDENT_FACETS, "ai_usage_band")
MEASURES = ("weekly_genai_hours", "gpa_change", "post_semester_gpa", "skill_retention_score",
            "anxiety_level_during_exams", "perceived_ai_dependency", "tool_diversity")
FLAGS = ("high_burnout_flag", "high_dependency_flag", "strong_retention_flag")


def report_cube(students: DataFrame) -> DataFrame:
    """The states of the cleaned students by all facets and band; null categories are categories of their own."""
    states = [F.count(F.lit(1)).alias("students")]
    for m in MEASURES:
        states += [F.count(m).alias(f"{m}_count"), F.sum(F.col(m).cast("double")).alias(f"{m}_sum")]
    states += [F.sum(F.col(f).cast("long")).alias(f"{f}_sum") for f in FLAGS]
    return students.groupBy(*DIMENSIONS).agg(*states)


def merge(*cubes: DataFrame) -> DataFrame:
    """The cube of all rows of several cubes, whose rows must not overlap."""
    whole = cubes[0]
    for cube in cubes[1:]:
        whole = whole.unionByName(cube)
    return whole.groupBy(*DIMENSIONS).agg(*[F.sum(c).alias(c) for c in whole.columns if c not in DIMENSIONS])


def students_in() -> Column:
    return F.coalesce(F.sum("students"), F.lit(0)).alias("students")


def average(measure: str, digits: int, name: str) -> Column:
    """The rounded average of a measure over its non-null values; null where there is none."""
    return F.round(F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_count")), digits).alias(name)


def flag_pct(flag: str, name: str) -> Column:
    return F.round(F.try_divide(F.sum(f"{flag}_sum"), F.sum("students")) * F.lit(100.0), 2).alias(name)


def roll_up(cube: DataFrame, by: Sequence[str], states: Sequence[Column], where: Column | None = None) -> DataFrame:
    """The cube's cells that meet ``where``, merged by some of its dimensions (none: one row)."""
    unknown = [c for c in by if c not in DIMENSIONS]
    if unknown:
        raise ValueError(f"the cube has no dimension {unknown}; it has {DIMENSIONS}")
    cells = cube if where is None else cube.where(where)
    return cells.groupBy(*by).agg(*states) if by else cells.agg(*states)


def student_summary(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, [], [
        students_in(), average("weekly_genai_hours", 2, "avg_genai_hours"), average("gpa_change", 3, "avg_gpa_change"),
        average("post_semester_gpa", 3, "avg_post_gpa"), average("skill_retention_score", 2, "avg_retention"),
        average("anxiety_level_during_exams", 2, "avg_anxiety"), flag_pct("high_burnout_flag", "high_burnout_pct")], where)


def outcomes_by_band(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, ["ai_usage_band"], [
        students_in(), average("weekly_genai_hours", 2, "avg_weekly_genai_hours"),
        average("gpa_change", 3, "avg_gpa_change"), average("post_semester_gpa", 3, "avg_post_gpa"),
        average("skill_retention_score", 2, "avg_skill_retention"),
        average("anxiety_level_during_exams", 2, "avg_exam_anxiety"),
        average("perceived_ai_dependency", 2, "avg_ai_dependency"), flag_pct("high_burnout_flag", "high_burnout_pct")],
        where).orderBy(order_key("ai_usage_band", AI_USAGE_LABELS).asc_nulls_last())


def outcomes_by_skill(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, ["prompt_engineering_skill"], [
        students_in(), average("gpa_change", 3, "avg_gpa_change"), average("skill_retention_score", 2, "avg_skill_retention"),
        average("tool_diversity", 2, "avg_tool_diversity"), average("anxiety_level_during_exams", 2, "avg_exam_anxiety"),
        flag_pct("strong_retention_flag", "strong_retention_pct")], where).orderBy(
        F.col("avg_gpa_change").desc_nulls_last(), "prompt_engineering_skill")


def outcomes_by_policy(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, ["institutional_policy"], [
        students_in(), average("gpa_change", 3, "avg_gpa_change"), average("skill_retention_score", 2, "avg_skill_retention"),
        average("anxiety_level_during_exams", 2, "avg_exam_anxiety"), flag_pct("high_burnout_flag", "high_burnout_pct"),
        flag_pct("high_dependency_flag", "high_dependency_pct")], where).orderBy(
        F.col("high_burnout_pct").desc_nulls_last(), "institutional_policy")


def outcomes_by_use_case(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, ["primary_use_case"], [
        students_in(), average("weekly_genai_hours", 2, "avg_weekly_genai_hours"),
        average("gpa_change", 3, "avg_gpa_change"), average("skill_retention_score", 2, "avg_skill_retention"),
        flag_pct("high_burnout_flag", "high_burnout_pct")], where).orderBy(
        F.col("avg_gpa_change").desc_nulls_last(), "primary_use_case")


def rank_bands_in_major(cube: DataFrame, k: int = 3, where: Column | None = None) -> DataFrame:
    stats = roll_up(cube, ["major_category", "ai_usage_band"], [
        students_in(), average("gpa_change", 3, "avg_gpa_change"),
        average("skill_retention_score", 2, "avg_skill_retention")], where)
    ranked = analysis.top_k_per_group(stats, ["major_category"], [F.col("avg_gpa_change").desc_nulls_last()], k,
                                      rank_name="band_rank")
    return ranked.orderBy(F.col("major_category").asc_nulls_last(), "band_rank", "ai_usage_band")


def gpa_pivot(cube: DataFrame, where: Column | None = None) -> DataFrame:
    """Average GPA change per major, a column for each band."""
    cells = roll_up(cube, ["major_category", "ai_usage_band"], [average("gpa_change", 3, "change")], where)
    out = analysis.pivot(cells, ["major_category"], "ai_usage_band", AI_USAGE_LABELS, F.first("change"))
    return out.orderBy(F.col("major_category").asc_nulls_last())


def burnout_by_band(cube: DataFrame, where: Column | None = None) -> DataFrame:
    return roll_up(cube, ["ai_usage_band", "burnout_risk_level"], [students_in()], where).orderBy(
        order_key("ai_usage_band", AI_USAGE_LABELS).asc_nulls_last(), F.col("burnout_risk_level").asc_nulls_last())
