"""End-to-end cleaning pipelines, each a chain of operators.

* ``clean_flights`` / ``cleaning_sql``: dedup by key, median fill of the
  departure delay, IQR flag on the arrival delay (DataFrame and SQL forms).
* ``clean_students`` / ``student_rows`` / ``ingest_students``: the CSV ingest of student records: rename, cast,
  reject, dedup, fill, standardise, features, outlier flag, save, audit, validate.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scrubjay.functions.inference import narrowest, type_bits_array
from scrubjay.functions.quantiles import exact_quantiles, key_table, select_keys, value_key
from scrubjay.functions.text import category_token
from scrubjay.operators import clean, outliers, quality
from scrubjay.operators.features import student_features
from scrubjay.session import cut_lineage, cut_lineage_observed
from scrubjay.sources import files

# --- flights -----------------------------------------------------------------------

FLIGHT_KEY = ("carrier", "flight")
FLIGHT_ORDER = ("year", "month", "day", "line", "part")


def clean_flights(flights: DataFrame, key: Sequence[str] = FLIGHT_KEY, order: Sequence[str] = FLIGHT_ORDER,
                  fill_col: str = "dep_delay", outlier_col: str = "arr_delay", method: str = "exact") -> DataFrame:
    """Dedup (keep first) -> median fill beside the original -> IQR flag with its fences.

    The deduplicated rows feed the statistics and the output, so they are
    written once instead of being shuffled and sorted again per job. The fill
    writes a new column, so the quartiles of ``outlier_col`` do not depend on
    it and all three exact quantiles come from one selection run.
    """
    deduped = cut_lineage(clean.dedup_keep_first(flights, key, order), "flights-dedup")
    if method != "exact" or fill_col == outlier_col:
        filled = clean.fill_median(deduped, [fill_col], method=method, suffix="_filled")
        return outliers.iqr_flag(filled, outlier_col, flag=f"{outlier_col}_outlier", method=method,
                                 bounds_prefix=f"{outlier_col}_iqr_")
    q = exact_quantiles(deduped, {fill_col: [0.5], outlier_col: [0.25, 0.75]})
    filled = deduped.withColumn(f"{fill_col}_filled", F.coalesce(F.col(fill_col), F.lit(q[fill_col][0]).cast("double")))
    return outliers.iqr_flag(filled, outlier_col, flag=f"{outlier_col}_outlier", bounds_prefix=f"{outlier_col}_iqr_",
                             bounds=outliers.fences(*q[outlier_col]))


def cleaning_sql(spark: SparkSession, view: str, key: Sequence[str], order: Sequence[str], fill_col: str,
                 outlier_col: str, k: float = 1.5) -> DataFrame:
    """``clean_flights`` for SQL users: dedup, median fill and IQR flag of any view, with names as parameters.

    The deduplicated rows are a composed query whose result is written once and registered as a view of its own; the
    statistics come from the bounded quantile selection and enter the last statement as bound arguments.
    """
    name = lambda c: "`" + c.replace("`", "``") + "`"
    first = spark.sql(f"""
        SELECT * EXCEPT (place_in_key) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(map(name, key))}
                                         ORDER BY {', '.join(map(name, order))}) AS place_in_key
            FROM {name(view)})
        WHERE place_in_key = 1
    """)
    deduped = f"{view}_deduped"
    cut_lineage(first, "sql-dedup").createOrReplaceTempView(deduped)
    q = exact_quantiles(spark.table(deduped), {fill_col: [0.5], outlier_col: [0.25, 0.75]})
    fences = outliers.fence_values(*q[outlier_col], k)
    x = name(outlier_col)
    return spark.sql(f"""
        SELECT *, COALESCE(CAST({name(fill_col)} AS DOUBLE), CAST(:median AS DOUBLE)) AS {name(fill_col + '_filled')},
               COALESCE({x} NOT BETWEEN :low AND :high, false) AS {name(outlier_col + '_outlier')},
               CAST(:low AS DOUBLE) AS {name(outlier_col + '_iqr_lower_bound')},
               CAST(:high AS DOUBLE) AS {name(outlier_col + '_iqr_upper_bound')}
        FROM {name(deduped)}
    """, args={"median": q[fill_col][0], "low": fences["lower_bound"], "high": fences["upper_bound"]})


def flights_cleaning_report(cleaned: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """Six checks on the cleaned flights, one aggregate pass plus one grouped pass."""
    # Check names and detail formats of the flights cleaning report.
    rules = [
        quality.row_count("Cleaned row count is positive", 0, strict=True, detail="%d cleaned rows"),
        quality.unique_key("No duplicate records by " + "/".join(key), key, "groups", "%d duplicate key groups"),
        quality.no_nulls("Missing dep_delay filled with median", "dep_delay_filled", "%d missing dep_delay values"),
        quality.no_nulls("No NULL carrier values", "carrier", "%d missing carrier values"),
        quality.column_exists("arr_delay outlier flag created", "arr_delay_outlier",
                              F.count_if(F.col("arr_delay_outlier")), "%d rows flagged as outliers"),
        quality.ordered("IQR bounds are valid", "arr_delay_iqr_lower_bound", "arr_delay_iqr_upper_bound"),
    ]
    return quality.validate(cleaned, rules)


# --- students ----------------------------------------------------------------------

STUDENT_KEY = "student_id"
STUDENT_ORDER = ("tie_part", "tie_supp", "weekly_genai_hours", "skill_retention_score")
STUDENT_DOUBLES = ("pre_semester_gpa", "weekly_genai_hours", "traditional_study_hours", "post_semester_gpa",
                   "skill_retention_score")
STUDENT_INTS = ("tool_diversity", "perceived_ai_dependency", "anxiety_level_during_exams")
STUDENT_CATEGORIES = ("major_category", "year_of_study", "primary_use_case", "prompt_engineering_skill",
                      "institutional_policy", "burnout_risk_level")
STUDENT_NUMBERS = STUDENT_DOUBLES + STUDENT_INTS
STUDENT_FLAGS = ("paid_subscription",)
STUDENT_CAST_PLAN = {STUDENT_KEY: "bigint", "tie_part": "bigint", "tie_supp": "bigint",
                     **{c: "double" for c in STUDENT_DOUBLES}, **{c: "int" for c in STUDENT_INTS},
                     **{c: "boolean" for c in STUDENT_FLAGS}}


def _finish(deduped: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Fill -> standardise -> features, all narrow; the key is never imputed."""
    types = dict(deduped.dtypes)
    out = deduped.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(types[c])) for c, m in medians.items()})
    out = out.withColumns({c: F.coalesce(category_token(c), F.lit("Unknown")) for c in STUDENT_CATEGORIES})
    return student_features(out)


def student_rows(df: DataFrame, reads: Sequence[str] = STUDENT_NUMBERS) -> DataFrame:
    """The cleaned student rows as a lazy view for a report that reads the number columns ``reads``.

    Dedup by id under a declared total order, so Catalyst prunes the shuffle to the key, the order and what the report
    reads, and the report's filters and projections meet in one plan. Only if a column in ``reads`` has gaps is a
    median needed; then the gappy columns alone are written once.
    """
    deduped = clean.dedup_keep_first(df, [STUDENT_KEY], STUDENT_ORDER, total_order=True)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in reads]).first() if reads else {}
    gappy = [c for c in reads if nulls[c]]
    medians = {}
    if gappy:
        found = exact_quantiles(deduped, {c: [0.5] for c in gappy})
        medians = {c: v[0] for c, v in found.items()}
    return _finish(deduped, medians)


def clean_students(df: DataFrame) -> DataFrame:
    """The whole cleaned table: dedup by id (keep first) -> fill -> standardise -> features -> IQR flag.

    The deduplicated rows feed the statistics and the output, so they are written once below the checkpoint folder, and
    their gaps are counted on the way. The order keys of the hours and of the numbers with gaps are written once too; all
    medians come from them, and then the quartiles of the filled hours, whose gaps count as their median.
    """
    hours = "weekly_genai_hours"
    deduped, nulls = cut_lineage_observed(
        clean.dedup_keep_first(df, [STUDENT_KEY], STUDENT_ORDER, total_order=True),
        {c: F.count_if(F.col(c).isNull()) for c in STUDENT_NUMBERS}, "students-dedup")
    gappy = [c for c in STUDENT_NUMBERS if nulls[c]]
    keys, _ = key_table(deduped, list(dict.fromkeys([hours, *gappy])))
    found = select_keys(keys, {c: [0.5] for c in gappy})
    medians = {c: v[0] for c, v in found.items()}
    if medians.get(hours) is not None:
        keys = keys.select(F.coalesce(hours, F.lit(value_key(medians[hours]))).alias(hours))
    fences = outliers.fences(*select_keys(keys, {hours: [0.25, 0.75]})[hours])
    return outliers.iqr_flag(_finish(deduped, medians), hours, flag="genai_hours_outlier_flag", as_int=True, bounds=fences)


def raw_headers(columns: Sequence[str]) -> list[str]:
    """Mixed-case headers with spaces, as a spreadsheet export would have them."""
    return [" ".join(w.capitalize() for w in c.split("_")) for c in columns]


def write_raw_csv(df: DataFrame, path: str) -> str:
    """Export a frame as CSV under mixed-case headers (the raw input of the ingest)."""
    return files.write_csv(df.toDF(*raw_headers(df.columns)), path)


class Ingest(NamedTuple):
    """What an ingest wrote: the cleaned table, the rows it refused, the audit, and (if asked for) the columns' types."""

    table: DataFrame
    rejects: DataFrame
    audit: DataFrame
    types: dict[str, str]


def ingest_students(spark: SparkSession, csv_path: str, path: str, infer: bool = False) -> Ingest:
    """CSV -> snake_case -> cast -> reject -> clean -> save, below ``path``.

    Every column is read as text (no inference pass), once: one job casts, routes and writes all rows, refused ones as
    the text they were with a reason, the others in their types, and observes the audit's numbers on the way. A row whose
    id is missing or no number is refused; it never meets the dedup. What the saved table holds is observed during its own
    write. The audit is long, ``(item, column_name, rows)``: input, rejected, duplicate and kept rows, which add up; per
    column the nulls of the input, the values that failed their cast, and the nulls that are left in the saved table
    because no fill covers the column. With ``infer`` the same pass finds each column's narrowest type that no value
    fails, to hold against the cast plan. Both tables are versioned, so a failed ingest leaves the former ones.
    """
    text = files.snake_case_columns(files.read_csv(spark, csv_path, multi_line=False))
    cols = text.columns
    cast = {c: F.col(f"cast_{c}") for c in STUDENT_CAST_PLAN}
    refused = cast[STUDENT_KEY].isNull()
    reason = F.when(F.col(STUDENT_KEY).isNull() | (F.trim(STUDENT_KEY) == ""), "id missing").otherwise("id not a number")
    seen, left = Observation(), Observation()
    # The casts and the types are columns before they are observed: an observation only counts, each cast runs once. A
    # failed cast is a value without a cast one.
    counted = text.select(
        *cols, *[F.trim(c).try_cast(t).alias(f"cast_{c}") for c, t in STUDENT_CAST_PLAN.items()],
        *([type_bits_array(cols).alias("type_bits")] if infer else [])).observe(
        seen, F.count(F.lit(1)).alias("input"), *[F.count(c).alias(f"texts_{c}") for c in cols],
        *[F.bit_and(F.col("type_bits")[i]).alias(f"bits_{c}") for i, c in enumerate(cols) if infer],
        *[F.count(cast[c]).alias(f"casts_{c}") for c in STUDENT_CAST_PLAN])
    routed = cut_lineage(counted.select(
        F.when(refused, "rejects").otherwise("rows").alias("route"), F.when(refused, reason).alias("reject_reason"),
        F.when(refused, F.array(*cols)).alias("refused_texts"),
        *[F.when(~refused, cast.get(c, F.col(c))).alias(c) for c in cols]), "students-routed", partition_by=["route"])
    rejects = files.save_table(routed.where("route = 'rejects'").select(
        *[F.col("refused_texts")[i].alias(c) for i, c in enumerate(cols)], "reject_reason"), path=f"{path}/rejects")
    cleaned = clean_students(routed.where("route = 'rows'").select(*cols))
    table = files.save_table(cleaned.observe(left, F.count(F.lit(1)).alias("kept"), *[
        F.count(c).alias(f"values_{c}") for c in cols]), path=f"{path}/table")
    before, after = seen.get, left.get
    with_id = before[f"casts_{STUDENT_KEY}"]
    rows = [("input rows", None, before["input"]), ("rejected rows", None, before["input"] - with_id),
            ("kept rows", None, after["kept"]), ("duplicate rows", None, with_id - after["kept"])]
    rows += [("input nulls", c, before["input"] - before[f"texts_{c}"]) for c in cols]
    rows += [("failed casts", c, before[f"texts_{c}"] - before[f"casts_{c}"]) for c in STUDENT_CAST_PLAN]
    rows += [("nulls left", c, after["kept"] - after[f"values_{c}"]) for c in cols]
    return Ingest(table, rejects, spark.createDataFrame(rows, "item string, column_name string, rows bigint"),
                  {c: narrowest(before[f"bits_{c}"]) for c in cols if infer})


def student_validation(df: DataFrame) -> DataFrame:
    """Six checks on the saved student table."""
    # Check names and detail formats of the student validation report.
    rules = [
        quality.row_count("Row count >= 1,000", 1000, strict=False, detail="%,d rows"),
        quality.unique_key("No duplicate student IDs", [STUDENT_KEY], "rows", "%,d duplicate IDs"),
        quality.no_nulls("No NULL student IDs", STUDENT_KEY, "%,d null IDs"),
        quality.within("GPA values between 0 and 4", ["pre_semester_gpa", "post_semester_gpa"], 0, 4,
                       "%,d invalid GPA rows"),
        quality.within("Skill retention between 0 and 100", ["skill_retention_score"], 0, 100,
                       "%,d invalid retention rows"),
        quality.non_negative("Weekly GenAI hours non-negative", "weekly_genai_hours", "%,d invalid hour rows"),
    ]
    return quality.validate(df, rules)
