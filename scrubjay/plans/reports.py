"""Report queries: flights, diamonds and student-outcome reports.

Each is ``(frames, filters) -> DataFrame`` built from the operators; filters
are ``Column`` predicates (see ``scrubjay.functions.predicates``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubjay.functions.predicates import delay_filter, gem_filter
from scrubjay.functions.stats import percent_where, rate_pct
from scrubjay.operators import analysis
from scrubjay.operators.features import AI_USAGE_LABELS, order_key
from scrubjay.operators.joins import join_dimension

# --- flights ---------------------------------------------------------------------


def _delay_stats(metric: str, digits: int = 1) -> list[Column]:
    x = F.col(metric)
    return [F.round(F.avg(x), digits).alias("avg_delay"),
            F.round(F.min(x), digits).alias("best_delay"),
            F.round(F.max(x), digits).alias("worst_delay"),
            F.round(percent_where(x <= 0), digits).alias("ontime_pct")]


def delay_summary(flights: DataFrame, metric: str = "arr_delay", where: Column | None = None) -> DataFrame:
    """Count, average, best, worst and on-time percent (``delay <= 0``)."""
    where = where if where is not None else delay_filter(metric)
    return flights.where(where).agg(F.count(F.lit(1)).alias("total_flights"), *_delay_stats(metric))


def delay_by_month(flights: DataFrame, metric: str = "arr_delay", where: Column | None = None) -> DataFrame:
    where = where if where is not None else delay_filter(metric)
    return (flights.where(where).groupBy("month")
            .agg(F.round(F.avg(metric), 2).alias("avg_delay"), F.count(F.lit(1)).alias("flights"))
            .orderBy("month"))


def delay_histogram(flights: DataFrame, metric: str = "arr_delay", where: Column | None = None,
                    lo: float = -60, hi: float = 240, bins: int = 60, keep_empty: bool = False) -> DataFrame:
    where = where if where is not None else delay_filter(metric)
    return analysis.histogram(flights.where(where), metric, lo, hi, bins, "flights", keep_empty).orderBy("bin")


def origin_share(flights: DataFrame, metric: str = "arr_delay", where: Column | None = None) -> DataFrame:
    where = where if where is not None else delay_filter(metric)
    return analysis.share(flights.where(where), "origin", name="flights").orderBy(
        F.col("flights").desc(), F.col("origin"))


def worst_delays(flights: DataFrame, airlines: DataFrame, metric: str = "arr_delay",
                 where: Column | None = None, n: int = 10) -> DataFrame:
    """Top ``n`` delays with the airline name; ties broken by flight key."""
    where = where if where is not None else delay_filter(metric)
    top = analysis.top_n(flights.where(where), n,
                         [F.col(metric).desc_nulls_last(), "carrier", "flight", "line"])
    j = join_dimension(top, airlines.select("carrier", F.col("name").alias("airline")), "carrier", "left")
    return j.select("year", "month", "day", "carrier", "airline", "flight", "origin", "dest",
                    F.col(metric).alias("selected_delay"), "dep_delay", "arr_delay", "air_time")


def carrier_comparison(flights: DataFrame, airlines: DataFrame, metric: str = "arr_delay",
                       months: tuple[int, int] | None = None, min_delay: float | None = None) -> DataFrame:
    """Per-airline delay table; ignores the airline filter on purpose.

    Aggregates by carrier first, then attaches the name: the dimension join
    then touches one row per carrier instead of one per flight.
    """
    per_carrier = (flights.where(delay_filter(metric, months, min_delay))
                   .groupBy("carrier").agg(F.count(F.lit(1)).alias("flights"), *_delay_stats(metric)))
    j = join_dimension(per_carrier, airlines.select("carrier", F.col("name").alias("airline")), "carrier", "left")
    return j.select("airline", "carrier", "flights", "avg_delay", "best_delay", "worst_delay",
                    "ontime_pct").orderBy(F.col("avg_delay").asc_nulls_last(), "carrier")


def airline_options(airlines: DataFrame) -> DataFrame:
    return airlines.select("carrier", "name").orderBy(F.col("name").asc_nulls_last(), "carrier")


# --- diamonds --------------------------------------------------------------------


def price_summary(gems: DataFrame, cut: str | None = None) -> DataFrame:
    return gems.where(gem_filter(cut)).agg(
        F.count(F.lit(1)).alias("total_diamonds"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.round(F.avg("carat"), 2).alias("avg_carat"),
        F.round(F.min("price"), 2).alias("min_price"),
        F.round(F.max("price"), 2).alias("max_price"))


def price_by_cut(gems: DataFrame) -> DataFrame:
    """Per-cut price table; ignores the cut filter on purpose."""
    return (gems.where(gem_filter(None)).groupBy("cut")
            .agg(F.count(F.lit(1)).alias("diamonds"), F.round(F.avg("price"), 2).alias("avg_price"),
                 F.round(F.avg("carat"), 2).alias("avg_carat"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "cut"))


def gem_points(gems: DataFrame, n: int = 3000, cut: str | None = None, seed: int | None = None) -> DataFrame:
    cols = ["gem_id", "carat", "price", "cut", "color", "clarity"]
    return analysis.sample_random(gems.where(gem_filter(cut)).select(*cols), n, seed)


# --- students --------------------------------------------------------------------

# Facet columns of the student table and the detail-export columns.
STUDENT_FACETS = ("major_category", "year_of_study", "primary_use_case", "prompt_engineering_skill",
                  "institutional_policy", "burnout_risk_level")
DETAIL_COLUMNS = ("student_id", "major_category", "year_of_study", "pre_semester_gpa", "post_semester_gpa",
                  "gpa_change", "weekly_genai_hours", "ai_usage_band", "primary_use_case",
                  "prompt_engineering_skill", "tool_diversity", "traditional_study_hours",
                  "perceived_ai_dependency", "anxiety_level_during_exams", "skill_retention_score",
                  "burnout_risk_level", "institutional_policy")
CORRELATION_COLUMNS = ("pre_semester_gpa", "weekly_genai_hours", "tool_diversity", "traditional_study_hours",
                       "perceived_ai_dependency", "anxiety_level_during_exams", "post_semester_gpa",
                       "skill_retention_score", "gpa_change", "high_burnout_flag")


def _avg(c: str, digits: int, name: str) -> Column:
    return F.round(F.avg(c), digits).alias(name)


def _pct(flag: str, name: str) -> Column:
    return F.round(rate_pct(flag), 2).alias(name)


def _students() -> Column:
    return F.count(F.lit(1)).alias("students")


def _filtered(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def student_summary(df: DataFrame, where: Column | None = None) -> DataFrame:
    return _filtered(df, where).agg(
        _students(), _avg("weekly_genai_hours", 2, "avg_genai_hours"), _avg("gpa_change", 3, "avg_gpa_change"),
        _avg("post_semester_gpa", 3, "avg_post_gpa"), _avg("skill_retention_score", 2, "avg_retention"),
        _avg("anxiety_level_during_exams", 2, "avg_anxiety"), _pct("high_burnout_flag", "high_burnout_pct"))


def outcomes_by_band(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("ai_usage_band").agg(
        _students(), _avg("weekly_genai_hours", 2, "avg_weekly_genai_hours"),
        _avg("gpa_change", 3, "avg_gpa_change"), _avg("post_semester_gpa", 3, "avg_post_gpa"),
        _avg("skill_retention_score", 2, "avg_skill_retention"),
        _avg("anxiety_level_during_exams", 2, "avg_exam_anxiety"),
        _avg("perceived_ai_dependency", 2, "avg_ai_dependency"), _pct("high_burnout_flag", "high_burnout_pct"))
        .orderBy(order_key("ai_usage_band", AI_USAGE_LABELS).asc_nulls_last()))


def outcomes_by_skill(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("prompt_engineering_skill").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_skill_retention"),
        _avg("tool_diversity", 2, "avg_tool_diversity"), _avg("anxiety_level_during_exams", 2, "avg_exam_anxiety"),
        _pct("strong_retention_flag", "strong_retention_pct"))
        .orderBy(F.col("avg_gpa_change").desc_nulls_last(), "prompt_engineering_skill"))


def outcomes_by_policy(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("institutional_policy").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_skill_retention"),
        _avg("anxiety_level_during_exams", 2, "avg_exam_anxiety"), _pct("high_burnout_flag", "high_burnout_pct"),
        _pct("high_dependency_flag", "high_dependency_pct"))
        .orderBy(F.col("high_burnout_pct").desc_nulls_last(), "institutional_policy"))


def outcomes_by_use_case(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("primary_use_case").agg(
        _students(), _avg("weekly_genai_hours", 2, "avg_weekly_genai_hours"),
        _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_skill_retention"),
        _pct("high_burnout_flag", "high_burnout_pct"))
        .orderBy(F.col("avg_gpa_change").desc_nulls_last(), "primary_use_case"))


def band_summary(df: DataFrame) -> DataFrame:
    """Per-band summary with every metric rounded to 2 places and the rate x 100."""
    return df.groupBy("ai_usage_band").agg(
        F.count("student_id").alias("students"),
        F.round(F.avg("gpa_change"), 2).alias("avg_gpa_change"),
        F.round(F.avg("skill_retention_score"), 2).alias("avg_retention"),
        F.round(F.avg("anxiety_level_during_exams"), 2).alias("avg_anxiety"),
        F.round(rate_pct("high_burnout_flag"), 2).alias("high_burnout_pct"))


def rank_bands_in_major(df: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` usage bands per major by the rounded average GPA change (ties share a rank)."""
    stats = df.groupBy("major_category", "ai_usage_band").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_skill_retention"))
    ranked = analysis.top_k_per_group(stats, ["major_category"], [F.col("avg_gpa_change").desc_nulls_last()], k,
                                      rank_name="band_rank")
    return ranked.orderBy(F.col("major_category").asc_nulls_last(), "band_rank", "ai_usage_band")


def gpa_pivot(df: DataFrame) -> DataFrame:
    out = analysis.pivot(df, ["major_category"], "ai_usage_band", AI_USAGE_LABELS,
                         F.round(F.avg("gpa_change"), 3))
    return out.orderBy(F.col("major_category").asc_nulls_last())


def burnout_by_band(df: DataFrame, where: Column | None = None) -> DataFrame:
    out = analysis.two_way_counts(_filtered(df, where), "ai_usage_band", "burnout_risk_level", name="students")
    return out.orderBy(order_key("ai_usage_band", AI_USAGE_LABELS).asc_nulls_last(),
                       F.col("burnout_risk_level").asc_nulls_last())


def outcome_correlations(df: DataFrame, cols: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    return analysis.correlation_matrix(df, cols, 3)


def scatter_sample(df: DataFrame, n: int = 5000, seed: int = 42, where: Column | None = None) -> DataFrame:
    cols = ["student_id", "weekly_genai_hours", "skill_retention_score", "gpa_change", "major_category",
            "year_of_study", "burnout_risk_level", "prompt_engineering_skill"]
    return analysis.sample_repeatable(_filtered(df, where).select(*cols), n, ["student_id"], seed)


def filtered_detail(df: DataFrame, where: Column | None = None, n: int = 1000) -> DataFrame:
    """Top ``n`` students by GPA change (ties by id), export columns only."""
    return analysis.top_n(_filtered(df, where).select(*DETAIL_COLUMNS), n,
                          [F.col("gpa_change").desc_nulls_last(), "student_id"])


def student_facets(df: DataFrame) -> DataFrame:
    return analysis.facet_values(df, STUDENT_FACETS)


# --- dashboard variants (filtered, with the dashboard's column names) ---------------

def band_overview(df: DataFrame, where: Column | None = None) -> DataFrame:
    """GPA change, retention and burnout by usage band, in band order (dashboard/chart form)."""
    return (_filtered(df, where).groupBy("ai_usage_band").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_retention"),
        _pct("high_burnout_flag", "high_burnout_pct"))
        .orderBy(order_key("ai_usage_band", AI_USAGE_LABELS).asc_nulls_last()))


def skill_comparison(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("prompt_engineering_skill").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_retention"),
        _avg("tool_diversity", 2, "avg_tool_diversity"), _pct("strong_retention_flag", "strong_retention_pct"))
        .orderBy(F.col("avg_gpa_change").desc_nulls_last(), "prompt_engineering_skill"))


def policy_outcomes(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (_filtered(df, where).groupBy("institutional_policy").agg(
        _students(), _avg("gpa_change", 3, "avg_gpa_change"), _avg("skill_retention_score", 2, "avg_retention"),
        _avg("anxiety_level_during_exams", 2, "avg_anxiety"), _pct("high_burnout_flag", "high_burnout_pct"),
        _pct("high_dependency_flag", "high_dependency_pct"))
        .orderBy(F.col("high_burnout_pct").desc_nulls_last(), "institutional_policy"))
