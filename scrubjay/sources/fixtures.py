"""Stand-in tables derived by Spark from the test tables.

The reference works on flight, airline, diamond and student tables. These
views rebuild the same shapes from the TPC-H-like tables, so each query's work
grows with the input. Nulls are injected by a deterministic rule on the keys;
no row is ever dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubjay.sources.tables import load


def _null_when(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def shipments(spark: SparkSession, data_dir: str) -> DataFrame:
    """Flights stand-in: one row per line item with its order's dates and priority."""
    li = load(spark, data_dir, "lineitem")
    od = load(spark, data_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lag = F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.year("l_shipdate").cast("int").alias("year"),
        F.month("l_shipdate").cast("int").alias("month"),
        F.dayofmonth("l_shipdate").cast("int").alias("day"),
        F.col("l_suppkey").alias("carrier"),
        F.col("l_orderkey").alias("flight"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_returnflag").alias("origin"),
        F.col("o_orderpriority").alias("dest"),
        _null_when((F.col("l_orderkey") + F.col("l_partkey")) % 37 == 0, lag.cast("int")).alias("arr_delay"),
        _null_when((F.col("l_orderkey") + F.col("l_suppkey")) % 41 == 0, (lag % 90).cast("int")).alias("dep_delay"),
        _null_when(F.col("l_partkey") % 53 == 0, F.col("l_quantity")).alias("air_time"),
    )


def airlines(spark: SparkSession, data_dir: str) -> DataFrame:
    """Airline dimension: carrier code and name."""
    return load(spark, data_dir, "supplier").select(
        F.col("s_suppkey").alias("carrier"), F.col("s_name").alias("name"))


def gems(spark: SparkSession, data_dir: str) -> DataFrame:
    """Diamonds stand-in built from ``part``."""
    return load(spark, data_dir, "part").select(
        F.col("p_partkey").alias("gem_id"),
        (F.col("p_size") / F.lit(10.0)).alias("carat"),
        _null_when(F.col("p_partkey") % 29 == 0, F.col("p_retailprice")).alias("price"),
        F.col("p_type").alias("cut"),
        F.col("p_brand").alias("color"),
        F.col("p_name").alias("clarity"),
    )


# Student-table category labels assigned from key residues.
USE_CASES = ("Debugging", "Drafting", "Summarizing", "Direct Answer")
SKILLS = ("Beginner", "Intermediate", "Advanced")
POLICIES = ("Allowed", "Restricted", "Banned")
BURNOUT_LEVELS = ("Low", "Medium", "High")


def _pick(expr, labels):
    out = None
    for i, label in enumerate(labels):
        cond = expr == i
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def outcomes(spark: SparkSession, data_dir: str) -> DataFrame:
    """Student-records stand-in (raw, before cleaning): one row per line item."""
    li = load(spark, data_dir, "lineitem")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("student_id"),
        F.col("l_returnflag").alias("major_category"),
        F.col("l_linestatus").alias("year_of_study"),
        pk.alias("tie_part"),
        sk.alias("tie_supp"),
        _pick(pk % 4, USE_CASES).alias("primary_use_case"),
        _pick(pk % 3, SKILLS).alias("prompt_engineering_skill"),
        _pick(sk % 3, POLICIES).alias("institutional_policy"),
        _pick(sk % 7 % 3, BURNOUT_LEVELS).alias("burnout_risk_level"),
        F.col("l_quantity").alias("weekly_genai_hours"),
        (F.lit(1) + sk % 5).cast("int").alias("tool_diversity"),
        (pk % 40).cast("double").alias("traditional_study_hours"),
        (F.lit(1) + pk % 10).cast("int").alias("perceived_ai_dependency"),
        (F.lit(1) + sk % 10).cast("int").alias("anxiety_level_during_exams"),
        (F.lit(2) + F.col("l_discount") * 10).alias("pre_semester_gpa"),
        (F.lit(2) + F.col("l_tax") * 10).alias("post_semester_gpa"),
        (F.col("l_extendedprice") / 1050).alias("skill_retention_score"),
        (sk % 2 == 0).alias("paid_subscription"),
    )


def outcomes_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """The student records as an export would hold them: all text, with gaps, bad values and outer spaces.

    Every table row is kept; the keys' residues decide which values are spoilt.
    """
    o = outcomes(spark, data_dir)
    pk, sk = F.col("tie_part"), F.col("tie_supp")
    dirty = {
        "student_id": F.when(pk % 101 == 0, F.lit(None)).when(pk % 97 == 0, F.concat(F.lit("S-"), F.col("student_id")))
        .otherwise(F.col("student_id").cast("string")),
        "weekly_genai_hours": F.when(sk % 13 == 0, "n/a").when(sk % 17 == 0, F.lit(None))
        .otherwise(F.col("weekly_genai_hours").cast("string")),
        "perceived_ai_dependency": _null_when(pk % 19 == 0, F.col("perceived_ai_dependency").cast("string")),
        "major_category": F.when(pk % 5 == 0, F.concat(F.lit("  "), "major_category", F.lit(" ")))
        .otherwise(F.col("major_category")),
        "institutional_policy": _null_when(sk % 23 == 0, F.col("institutional_policy")),
        "paid_subscription": F.when(sk % 29 == 0, "maybe").otherwise(F.col("paid_subscription").cast("string")),
    }
    return o.select(*[dirty.get(c, F.col(c).cast("string")).alias(c) for c in o.columns])


def documents_labeled(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents left-joined to their (partial) quality labels."""
    docs = load(spark, data_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = load(spark, data_dir, "labels")
    return docs.join(labels, "doc_id", "left").withColumn(
        "quality_label",
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"))


def customer_as_strings(spark: SparkSession, data_dir: str) -> DataFrame:
    """The customer table as text with bad numbers (input of cast plans) and a text flag."""
    c = load(spark, data_dir, "customer")
    key = F.col("c_custkey")
    dirty = {
        "c_acctbal": F.when(key % 11 == 0, "n/a").when(key % 7 == 0, F.lit(None))
        .otherwise(F.col("c_acctbal").cast("string")),
        "c_nationkey": F.when(key % 13 == 0, F.concat(F.lit("#"), F.col("c_nationkey").cast("string")))
        .otherwise(F.col("c_nationkey").cast("string")),
    }
    flag = F.when(key % 17 == 0, "maybe").when(key % 2 == 0, "true").otherwise("false")
    return c.select(*[dirty.get(n, F.col(n).cast("string")).alias(n) for n in c.columns], flag.alias("c_member"))


def customer_messy(spark: SparkSession, data_dir: str) -> DataFrame:
    """The customer table with names as people type them: outer spaces, runs of spaces, mixed case, company suffixes."""
    c = load(spark, data_dir, "customer")
    key = F.col("c_custkey")
    name = F.regexp_replace("c_name", "#", F.lit("  "))
    name = F.when(key % 3 == 0, F.concat(F.lit("  "), F.lower(name), F.lit(" "))).when(key % 3 == 1, F.upper(name)).otherwise(name)
    company = F.concat("c_name", F.when(key % 4 == 0, " Inc.").when(key % 4 == 1, " Corporation")
                       .when(key % 4 == 2, " Air Lines Co.").otherwise(""))
    return c.select("c_custkey", name.alias("name"), company.alias("company"),
                    F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("segment"))


def documents_spaced(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents whose sentences stand two spaces apart, with outer white space and, for some, no or an empty text."""
    d = load(spark, data_dir, "documents")
    text = F.concat(F.lit("  "), F.replace("text", F.lit(". "), F.lit(".  \t")), F.lit(' "\n'))
    return d.select("doc_id", F.when(F.col("doc_id") % 19 == 0, F.lit(None)).when(F.col("doc_id") % 23 == 0, "")
                    .otherwise(text).alias("text"))


def lineitem_repeated(spark: SparkSession, data_dir: str) -> DataFrame:
    """The line items as repeated loads would leave them: those of every tenth part twice, of one supplier many times."""
    li = load(spark, data_dir, "lineitem")
    copies = F.when(F.col("l_suppkey") == 3, 40).when(F.col("l_partkey") % 10 == 0, 2).otherwise(1)
    return li.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
