"""The registered queries: one callable ``(spark, data_dir) -> DataFrame`` per operator.

Every query reads the given tables (or frames Spark derives from them) in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubjay.functions import text
from scrubjay.functions.predicates import delay_filter, facet_filter
from scrubjay.functions.inference import infer_types
from scrubjay.functions.quantiles import rank_errors
from scrubjay.operators import analysis, clean, outliers, quality
from scrubjay.operators.features import student_features
from scrubjay.plans import cube, pipelines, reports
from scrubjay.session import cut_lineage, scratch_path
from scrubjay.sources import files, fixtures, versions
from scrubjay.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]

# The cut domain checked in the diamonds validation (PROMO is left off on purpose).
VALID_CUTS = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
DELAY_COLUMNS = ("dep_delay", "arr_delay", "air_time")
# Airline picked in the filtered flight reports.
CARRIER = 7
# Facet selection used by the filtered student reports.
STUDENT_FILTER = dict(ranges={"weekly_genai_hours": (0.0, 40.0)},
                      facets={"major_category": ["A", "R"], "institutional_policy": ["Allowed", "Restricted"],
                              "year_of_study": ["All Years"]},
                      all_labels={"year_of_study": "All Years"})


# The number columns that each group of student reports reads.
GPA = ("pre_semester_gpa", "post_semester_gpa")
HOURS, RETENTION, ANXIETY = "weekly_genai_hours", "skill_retention_score", "anxiety_level_during_exams"
DEPENDENCY, DIVERSITY = "perceived_ai_dependency", "tool_diversity"


def students(spark: SparkSession, d: str, *reads: str) -> DataFrame:
    """The cleaned student rows derived from the outcomes stand-in, for a report that reads the numbers ``reads``."""
    return pipelines.student_rows(fixtures.outcomes(spark, d), reads)


# --- flights -------------------------------------------------------------------------

def q_carrier_comparison(spark, d):
    return reports.carrier_comparison(fixtures.shipments(spark, d), fixtures.airlines(spark, d))


def q_delay_summary(spark, d):
    return reports.delay_summary(fixtures.shipments(spark, d), "arr_delay")


def q_delay_summary_departure(spark, d):
    return reports.delay_summary(fixtures.shipments(spark, d), "dep_delay")


def q_delay_by_month(spark, d):
    return reports.delay_by_month(fixtures.shipments(spark, d))


def q_carrier_delay_summary(spark, d):
    """Departure-delay summary for one airline, only delays of at least 15 days, months 3-9."""
    where = delay_filter("dep_delay", (3, 9), 15, carrier=CARRIER)
    return reports.delay_summary(fixtures.shipments(spark, d), "dep_delay", where)


def q_carrier_delay_by_month(spark, d):
    where = delay_filter("arr_delay", (3, 9), 15, carrier=CARRIER)
    return reports.delay_by_month(fixtures.shipments(spark, d), "arr_delay", where)


def q_worst_delays(spark, d):
    return reports.worst_delays(fixtures.shipments(spark, d), fixtures.airlines(spark, d))


def q_delay_histogram(spark, d):
    return reports.delay_histogram(fixtures.shipments(spark, d))


def q_delay_histogram_all_bins(spark, d):
    """The departure delays in all 60 bins of the chart, those without flights, too."""
    return reports.delay_histogram(fixtures.shipments(spark, d), "dep_delay", keep_empty=True)


def q_origin_share(spark, d):
    return reports.origin_share(fixtures.shipments(spark, d))


def q_airline_options(spark, d):
    return reports.airline_options(fixtures.airlines(spark, d))


# --- duplicates ----------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def q_find_duplicates(spark, d):
    return clean.find_duplicates(load(spark, d, "lineitem"), LINE_KEY, 10)


def q_dedup_keep_first(spark, d):
    return clean.dedup_keep_first(load(spark, d, "lineitem"), LINE_KEY, LINE_ORDER)


def q_duplicate_summary(spark, d):
    return clean.duplicate_summary(load(spark, d, "lineitem"), LINE_KEY)


def q_dedup_full_row(spark, d):
    """Whole line items, of which some stand there twice and some many times."""
    return clean.dedup_rows(fixtures.lineitem_repeated(spark, d))


def q_dedup_any_survivor(spark, d):
    """One whole row for each order and return flag, and whether that very row is one of the table's."""
    li = fixtures.lineitem_repeated(spark, d)
    kept = cut_lineage(clean.dedup_any(li, ["l_orderkey", "l_returnflag"]), "survivors")
    found = li.select(*[F.col(c).alias(f"of_{c}") for c in li.columns]).distinct().withColumn("member", F.lit(True))
    same = F.lit(True)
    for c in li.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return kept.join(found, same, "left").select("l_orderkey", "l_returnflag", F.coalesce("member", F.lit(False)).alias("member"))


def q_key_report(spark, d):
    """Three unique-key checks of the line items, counted together."""
    return quality.validate(fixtures.lineitem_repeated(spark, d), [
        quality.unique_key("One row per order line", LINE_KEY, "rows", "%d repeated rows"),
        quality.unique_key("One line per order and part", ["l_orderkey", "l_partkey"], "groups", "%d repeated keys"),
        quality.unique_key("One line per part, supplier and day", ["l_partkey", "l_suppkey", "l_shipdate"], "rows",
                           "%d repeated rows"),
        quality.row_count("Rows", 1, strict=False, detail="%d rows")])


# --- missing values ------------------------------------------------------------------

def q_null_audit(spark, d):
    return quality.null_audit(fixtures.shipments(spark, d), DELAY_COLUMNS)


def q_null_audit_long(spark, d):
    return quality.null_audit_long(fixtures.shipments(spark, d), DELAY_COLUMNS)


def q_null_audit_all(spark, d):
    return quality.null_counts(fixtures.documents_labeled(spark, d))


def q_fill_recommendation(spark, d):
    return quality.fill_recommendation(fixtures.documents_labeled(spark, d))


def q_table_shape(spark, d):
    return quality.table_shape(load(spark, d, "lineitem"))


def q_drop_missing(spark, d):
    return clean.drop_missing(fixtures.shipments(spark, d), ["arr_delay"])


def q_fill_mean(spark, d):
    out = clean.fill_mean(fixtures.shipments(spark, d), ["arr_delay"])
    return out.select("carrier", "flight", "line", "arr_delay")


def q_fill_median(spark, d):
    out = clean.fill_median(fixtures.shipments(spark, d), ["arr_delay"], suffix="_filled")
    return out.select("carrier", "flight", "line", "arr_delay", "arr_delay_filled")


SKETCH_ACCURACY = 10_000


def q_fill_median_approx(spark, d):
    """Per filled column: rows, gaps before and after, and whether the sketched median's rank is within its bound.

    The columns are written once, so the join that they come from runs once and not in each of the passes over them.
    """
    flights = cut_lineage(fixtures.shipments(spark, d).select(*DELAY_COLUMNS), "delays")
    medians = flights.agg(*[F.percentile_approx(c, 0.5, SKETCH_ACCURACY).alias(c) for c in DELAY_COLUMNS]).first()
    filled = clean.fill_median(flights, DELAY_COLUMNS, method="approx", accuracy=SKETCH_ACCURACY, suffix="_filled")
    counts = filled.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(x).isNull()).alias(x) for c in DELAY_COLUMNS
                                                        for x in (c, f"{c}_filled")])
    rows = counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("n").alias("total_rows"), F.col(c).alias("nulls_before"),
        F.col(f"{c}_filled").alias("nulls_after")) for c in DELAY_COLUMNS])))
    errors = rank_errors(flights, {c: {0.5: medians[c]} for c in DELAY_COLUMNS})
    return rows.join(errors, "column_name").select(
        "column_name", "total_rows", "nulls_before", "nulls_after",
        (F.col("rank_error") <= 1 / SKETCH_ACCURACY).alias("within_bound"))


def q_mean_vs_median(spark, d):
    """The mean, and whether the sketched median's rank is within its bound, over the delays written once."""
    flights = cut_lineage(fixtures.shipments(spark, d).select("arr_delay"), "delays")
    both = clean.mean_vs_median(flights, "arr_delay", accuracy=SKETCH_ACCURACY).first()
    errors = rank_errors(flights, {"arr_delay": {0.5: both["median_arr_delay"]}})
    return errors.select(F.lit(both["mean_arr_delay"]).alias("mean_arr_delay"),
                         (F.col("rank_error") <= 1 / SKETCH_ACCURACY).alias("within_bound"))


def q_fill_unknown(spark, d):
    out = clean.fill_constant(fixtures.documents_labeled(spark, d), {"quality_label": "Unknown"})
    return out.select("doc_id", "lang", "quality_label")


def q_fill_mode(spark, d):
    return clean.fill_mode(fixtures.documents_labeled(spark, d), ["quality", "toxic"]).select(
        "doc_id", "quality", "toxic")


def q_missing_indicator(spark, d):
    return clean.missing_indicator(fixtures.documents_labeled(spark, d), ["quality", "toxic"]).select(
        "doc_id", "quality_missing", "toxic_missing")


def q_approx_quantiles(spark, d):
    """Per probability, whether the sketched quantile's rank is within the sketch's bound."""
    li = load(spark, d, "lineitem")
    found = outliers.quantiles(li, "l_extendedprice", QUARTILES, method="approx", accuracy=SKETCH_ACCURACY).first()
    errors = rank_errors(li, {"l_extendedprice": dict(zip(QUARTILES, found))})
    return errors.select("p", (F.col("rank_error") <= 1 / SKETCH_ACCURACY).alias("within_bound"))


QUARTILES = (0.25, 0.5, 0.75)


# --- text and types ------------------------------------------------------------------

def q_clean_names(spark, d):
    """Every step of the name clean-up on names with outer spaces, runs of spaces and mixed case."""
    c = fixtures.customer_messy(spark, d)
    return c.select("c_custkey", "name", F.trim("name").alias("without_outer_spaces"),
                    F.upper(F.trim("name")).alias("upper"), F.lower(F.trim("name")).alias("lower"),
                    text.squish("name").alias("single_spaced"), text.proper("name").alias("proper"),
                    text.clean_email("segment").alias("segment_key"))


def q_strip_suffix(spark, d):
    c = fixtures.customer_messy(spark, d)
    return c.select("c_custkey", "company", text.strip_suffixes("company").alias("stripped"))


def q_collapse_whitespace(spark, d):
    docs = fixtures.documents_spaced(spark, d)
    return docs.select("doc_id", text.squish("text").alias("clean_text"))


def q_standardise_category(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", text.category_token("o_orderpriority").alias("o_orderpriority"),
                    text.category_token("o_orderstatus").alias("o_orderstatus"))


def q_string_functions(spark, d):
    c = load(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.ltrim(F.concat(F.lit("  "), "c_name")).alias("ltrimmed"),
        F.rtrim(F.concat("c_name", F.lit("  "))).alias("rtrimmed"),
        F.substring("c_name", 10, 9).alias("name_number"),
        F.length("c_name").alias("name_length"),
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("label"),
        F.format_string("%s has balance %.2f", "c_name", "c_acctbal").alias("balance_text"),
        F.format_string("%,.2f", "c_acctbal").alias("balance_grouped"),
    )


CUSTOMER_PLAN = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_member": "boolean"}


def q_cast_columns(spark, d):
    return clean.cast_columns(fixtures.customer_as_strings(spark, d), CUSTOMER_PLAN)


def q_cast_failures(spark, d):
    return clean.cast_failures(fixtures.customer_as_strings(spark, d), CUSTOMER_PLAN)


def q_schema_report(spark, d):
    return files.schema_report(load(spark, d, "lineitem"))


def q_snake_case_columns(spark, d):
    o = fixtures.outcomes(spark, d)
    return files.snake_case_columns(o.toDF(*pipelines.raw_headers(o.columns)))


# --- outliers and validation ---------------------------------------------------------

def q_iqr_report(spark, d):
    return outliers.iqr_report(load(spark, d, "events"), "value")


def q_iqr_flag(spark, d):
    out = outliers.iqr_flag(load(spark, d, "events"), "value", flag="value_outlier", bounds_prefix="")
    return out.select("event_id", "value", "value_outlier", F.round("lower_bound", 4).alias("lower_bound"),
                      F.round("upper_bound", 4).alias("upper_bound"))


def q_zscore_outliers(spark, d):
    return outliers.zscore(load(spark, d, "events"), "value", 3.0).select("event_id", "value", "z_score")


def q_domain_values(spark, d):
    return quality.distinct_values(fixtures.gems(spark, d), "cut")


def q_invalid_values(spark, d):
    return quality.invalid_values(fixtures.gems(spark, d), "cut", VALID_CUTS)


def q_validation_report(spark, d):
    flights, gems = fixtures.shipments(spark, d), fixtures.gems(spark, d)
    # Check names and detail formats of the flights/diamonds report.
    return quality.validate_many([
        (flights, [quality.row_count("Row count > 300000", 300000, strict=True, detail="%d"),
                   quality.no_nulls("No NULL carrier", "carrier", "%d"),
                   quality.missing_below("arr_delay missing < 5%", "arr_delay", 5.0, "%.2f%%")]),
        (gems, [quality.allowed_values("All diamond cuts valid", "cut", VALID_CUTS, "%d invalid rows"),
                quality.positive("Diamond price > 0", "price", "%d invalid rows")]),
    ])


# --- students ------------------------------------------------------------------------

def q_bands_and_flags(spark, d):
    out = student_features(fixtures.outcomes(spark, d))
    return out.select("student_id", "tie_part", "tie_supp", "gpa_change", "ai_usage_band", "high_dependency_flag",
                      "high_anxiety_flag", "high_burnout_flag", "strong_retention_flag")


def q_outcomes_by_band(spark, d):
    return reports.outcomes_by_band(students(spark, d, *GPA, HOURS, RETENTION, ANXIETY, DEPENDENCY))


def q_outcomes_by_skill(spark, d):
    return reports.outcomes_by_skill(students(spark, d, *GPA, RETENTION, DIVERSITY, ANXIETY))


def q_outcomes_by_policy(spark, d):
    return reports.outcomes_by_policy(students(spark, d, *GPA, RETENTION, ANXIETY, DEPENDENCY))


def q_outcomes_by_use_case(spark, d):
    return reports.outcomes_by_use_case(students(spark, d, *GPA, HOURS, RETENTION))


def q_band_summary(spark, d):
    return reports.band_summary(students(spark, d, *GPA, HOURS, RETENTION, ANXIETY))


def q_rank_bands_in_group(spark, d):
    return reports.rank_bands_in_major(students(spark, d, *GPA, HOURS, RETENTION))


def q_pivot_group_by_band(spark, d):
    return reports.gpa_pivot(students(spark, d, *GPA, HOURS))


def q_band_level_counts(spark, d):
    return reports.burnout_by_band(students(spark, d, HOURS))


def q_correlation_matrix(spark, d):
    return reports.outcome_correlations(students(spark, d, *pipelines.STUDENT_NUMBERS))


def q_describe_numeric(spark, d):
    out = analysis.describe(students(spark, d, *pipelines.STUDENT_NUMBERS), reports.CORRELATION_COLUMNS)
    return out.select("column_name", "stat", F.col("number").alias("value"))


def q_describe_table(spark, d):
    """All columns of ``documents`` but the text itself, strings included; texts keep their type's digits."""
    out = analysis.describe(load(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"))
    return out.where(F.col("stat").isin("count", "min", "max"))


def q_facet_options(spark, d):
    cuts = quality.distinct_values(fixtures.gems(spark, d), "cut").select(
        F.lit("cut").alias("facet"), F.col("cut").alias("value"))
    return cuts.unionByName(reports.student_facets(students(spark, d)))


def q_filtered_summary(spark, d):
    return reports.student_summary(students(spark, d, *GPA, HOURS, RETENTION, ANXIETY), facet_filter(**STUDENT_FILTER))


def q_filtered_detail(spark, d):
    return reports.filtered_detail(students(spark, d, *pipelines.STUDENT_NUMBERS), facet_filter(**STUDENT_FILTER))


def q_sample_repeatable(spark, d):
    return reports.scatter_sample(students(spark, d, *GPA, HOURS, RETENTION), 5000, 42)


def q_filtered_band_overview(spark, d):
    return reports.band_overview(students(spark, d, *GPA, HOURS, RETENTION), facet_filter(**STUDENT_FILTER))


def q_filtered_skill_comparison(spark, d):
    return reports.skill_comparison(students(spark, d, *GPA, HOURS, RETENTION, DIVERSITY), facet_filter(**STUDENT_FILTER))


def q_filtered_policy_outcomes(spark, d):
    return reports.policy_outcomes(students(spark, d, *GPA, HOURS, RETENTION, ANXIETY, DEPENDENCY), facet_filter(**STUDENT_FILTER))


def q_filtered_band_level_counts(spark, d):
    return reports.burnout_by_band(students(spark, d, HOURS), facet_filter(**STUDENT_FILTER))


def q_filtered_scatter_sample(spark, d):
    return reports.scatter_sample(students(spark, d, *GPA, HOURS, RETENTION), 5000, 42, facet_filter(**STUDENT_FILTER))


def q_report_cube(spark, d):
    """Eight reports of the dashboard from one stored cube, in long form: report, its key, students and two figures.

    The cube is built from the line items of odd and even orders apart, merged, saved and read back.
    """
    rows = students(spark, d, *GPA, HOURS, RETENTION, ANXIETY, DEPENDENCY, DIVERSITY)
    odd = F.expr("COALESCE(student_id DIV 10 % 2 = 1, false)")
    table = files.save_table(cube.merge(cube.report_cube(rows.where(odd)), cube.report_cube(rows.where(~odd))),
                             path=scratch_path(spark, "report-cube"))
    facets = facet_filter(facets=STUDENT_FILTER["facets"], all_labels=STUDENT_FILTER["all_labels"])

    def part(name, df, key, first, second):
        return df.select(F.lit(name).alias("report"), key.alias("key"), "students", F.col(first).alias("first_figure"),
                         F.col(second).alias("second_figure"))

    parts = [
        part("summary", cube.student_summary(table, facets), F.lit("all"), "avg_genai_hours", "avg_anxiety"),
        part("band", cube.outcomes_by_band(table), F.col("ai_usage_band"), "avg_gpa_change", "avg_ai_dependency"),
        part("band filtered", cube.outcomes_by_band(table, facets), F.col("ai_usage_band"), "avg_skill_retention",
             "high_burnout_pct"),
        part("skill", cube.outcomes_by_skill(table), F.col("prompt_engineering_skill"), "avg_tool_diversity",
             "strong_retention_pct"),
        part("policy", cube.outcomes_by_policy(table), F.col("institutional_policy"), "high_burnout_pct",
             "high_dependency_pct"),
        part("use case", cube.outcomes_by_use_case(table), F.col("primary_use_case"), "avg_weekly_genai_hours",
             "avg_skill_retention"),
        part("rank", cube.rank_bands_in_major(table).withColumn("place", F.col("band_rank").cast("double")),
             F.concat_ws("|", "major_category", "ai_usage_band"), "avg_gpa_change", "place"),
        part("burnout", cube.burnout_by_band(table).withColumn("none", F.lit(None).cast("double")),
             F.concat_ws("|", "ai_usage_band", "burnout_risk_level"), "none", "none"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def q_ordered_export(spark, d):
    """The whole filtered detail, best change first, exported as one ordered CSV file and read back."""
    detail = students(spark, d, *pipelines.STUDENT_NUMBERS).where(facet_filter(**STUDENT_FILTER)).select(
        *reports.DETAIL_COLUMNS)
    path = files.write_csv(detail, scratch_path(spark, "detail") + ".csv", single_file=True,
                           order=[F.col("gpa_change").desc_nulls_last(), "student_id"])
    return files.read_csv(spark, path, schema=detail.schema, multi_line=False)


# --- diamonds ------------------------------------------------------------------------

def q_price_summary(spark, d):
    return reports.price_summary(fixtures.gems(spark, d))


def q_price_summary_cut(spark, d):
    return reports.price_summary(fixtures.gems(spark, d), cut="MEDIUM")


def q_price_by_cut(spark, d):
    return reports.price_by_cut(fixtures.gems(spark, d))


def q_sample_random(spark, d):
    """Size, distinct rows and members of a random sample smaller than the table."""
    gems = fixtures.gems(spark, d)
    sample = cut_lineage(reports.gem_points(gems, 500), "sample")
    known = gems.select("gem_id").join(sample.select("gem_id"), "gem_id", "left_semi")
    return sample.agg(F.count(F.lit(1)).alias("sampled"), F.count_distinct("gem_id").alias("different"),
                      known.agg(F.count(F.lit(1))).scalar().alias("members"))


#: Rows drawn, and how many standard deviations of their expected number a stratum's share may be off.
STRATA_SAMPLE, DEVIATIONS = 2000, 6


def q_sample_strata(spark, d):
    """A random sample of events without their ids (rows that repeat), held against the strata it was drawn from."""
    events = load(spark, d, "events").select("event_type", F.col("value").isNull().alias("no_value"))
    drawn = analysis.sample_random(events, STRATA_SAMPLE).groupBy("event_type", "no_value").agg(
        F.count(F.lit(1)).alias("drawn"))
    strata = events.groupBy("event_type", "no_value").agg(F.count(F.lit(1)).alias("total_rows"))
    total = strata.agg(F.sum("total_rows")).scalar()
    both = strata.join(drawn, ["event_type", "no_value"], "left").withColumn("all", total)
    size, p = F.least(F.lit(STRATA_SAMPLE), "all"), F.col("total_rows") / F.col("all")
    spread = F.sqrt(size * p * (1 - p) * (F.col("all") - size) / F.greatest(F.col("all") - 1, F.lit(1)))
    off = F.abs(F.coalesce("drawn", F.lit(0)) - size * p)
    return both.select("event_type", "no_value", "total_rows",
                       (off <= F.lit(DEVIATIONS) * spread + F.lit(0.5)).alias("as_expected"))


# --- pipelines and sinks -------------------------------------------------------------

def q_cleaning_pipeline(spark, d):
    return pipelines.clean_flights(fixtures.shipments(spark, d))


def _view(df: DataFrame, name: str) -> str:
    """``df`` registered as a temporary view under a name that no other view of the session has."""
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def q_cleaning_pipeline_sql(spark, d):
    return pipelines.cleaning_sql(spark, _view(fixtures.shipments(spark, d), "shipments"), pipelines.FLIGHT_KEY, pipelines.FLIGHT_ORDER, "dep_delay",
                                  "arr_delay")


def q_temp_view_from_query(spark, d):
    """A composed query registered as a view and read by another statement."""
    shipments = _view(fixtures.shipments(spark, d), "shipments")
    late = _view(spark.sql(f"SELECT carrier, origin, arr_delay FROM {shipments} WHERE arr_delay > 0"), "late_shipments")
    return spark.sql(f"SELECT origin, COUNT(*) AS late, MAX(arr_delay) AS worst FROM {late} GROUP BY origin")


def q_cleaning_pipeline_report(spark, d):
    return pipelines.flights_cleaning_report(pipelines.clean_flights(fixtures.shipments(spark, d)))


def _ingest(spark, d, infer=False) -> pipelines.Ingest:
    csv_path = pipelines.write_raw_csv(fixtures.outcomes_raw(spark, d), scratch_path(spark, "students-csv"))
    return pipelines.ingest_students(spark, csv_path, scratch_path(spark, "students"), infer)


def q_ingest_pipeline(spark, d):
    return _ingest(spark, d).table


def q_ingest_rejects(spark, d):
    return _ingest(spark, d).rejects.select("student_id", "tie_part", "tie_supp", "reject_reason")


def q_ingest_audit(spark, d):
    return _ingest(spark, d).audit


def q_ingest_types(spark, d):
    """Per column of the spoilt export the type inferred in the ingest's own pass, beside that of its cast plan."""
    found = _ingest(spark, d, infer=True).types
    rows = [(c, t, pipelines.STUDENT_CAST_PLAN.get(c, "string")) for c, t in found.items()]
    return spark.createDataFrame(rows, "column_name string, inferred_type string, planned_type string")


def q_infer_types(spark, d):
    """The types inferred from whole tables exported as CSV text: every column of orders, events and customers."""
    rows = []
    for name in ("orders", "events", "customer"):
        path = files.write_csv(load(spark, d, name), scratch_path(spark, f"{name}-csv"))
        types = infer_types(files.read_csv(spark, path, multi_line=False))
        rows += [(name, c, t) for c, t in types.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, inferred_type string")


def q_ingest_validation(spark, d):
    return pipelines.student_validation(_ingest(spark, d).table)


def q_cleaned_row_count(spark, d):
    """Rows that the cleaning keeps: one for each id, counted without building them."""
    ids = fixtures.outcomes(spark, d).groupBy(pipelines.STUDENT_KEY).agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(F.count(F.lit(1)).alias("cleaned_rows"))


def q_table_overwrite(spark, d):
    """A saved table replaced by one of another schema, read back."""
    path = scratch_path(spark, "gems-table")
    gems = fixtures.gems(spark, d)
    files.save_table(gems, path=path)
    new = files.save_table(gems.select("gem_id", "cut", F.coalesce("price", F.lit(0.0)).alias("price_or_zero")), path=path)
    return new.select("*")


def q_table_self_overwrite(spark, d):
    """A saved table overwritten from itself, twice; all three versions are read back and counted."""
    path = scratch_path(spark, "orders-table")
    versions.publish(load(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lit(0).alias("raised")), path, expect=0)
    for number in (1, 2):
        old = versions.read_table(spark, path)
        versions.publish(old.where(F.col("o_orderkey") % 7 != number).withColumn("raised", F.col("raised") + 1), path,
                         expect=number)
    kept = [versions.read_table(spark, path, n).select(F.lit(n).alias("version"), "o_orderkey", "o_totalprice", "raised")
            for n in versions.versions(spark, path)]
    return kept[0].unionAll(kept[1]).unionAll(kept[2])


def q_csv_round_trip(spark, d):
    gems = fixtures.gems(spark, d)
    path = files.write_csv(gems, scratch_path(spark, "gems-csv"))
    return files.read_csv(spark, path, schema=gems.schema)


def q_csv_text_round_trip(spark, d):
    """Whole texts with quotes, line feeds, outer spaces, empty texts and nulls, through a CSV file."""
    docs = fixtures.documents_spaced(spark, d)
    path = files.write_csv(docs, scratch_path(spark, "documents-csv"))
    return files.read_csv(spark, path, schema=docs.schema)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
