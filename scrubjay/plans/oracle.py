"""DuckDB SQL equal to each registered query, for side-by-side checking.

Dialect notes (where DuckDB differs from Spark): ``regexp_replace`` needs the
``'g'`` flag to replace every match; there is no ``initcap``; integer sums are
HUGEINT and ranks BIGINT, so both are cast; percentages are DOUBLE on both
sides; ``quantile_cont`` equals Spark ``percentile`` (and our exact
selection); a sketched quantile is checked by its exact rank error, which must
be within the sketch's bound. ``date_diff('day', a, b)`` equals Spark
``datediff(b, a)``.
"""

from __future__ import annotations

SHIPMENTS = """shipments AS (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
           CAST(day(l_shipdate) AS INTEGER) AS day,
           l_suppkey AS carrier, l_orderkey AS flight, l_linenumber AS line, l_partkey AS part,
           l_returnflag AS origin, o_orderpriority AS dest,
           CASE WHEN (l_orderkey + l_partkey) % 37 = 0 THEN NULL
                ELSE CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) END AS arr_delay,
           CASE WHEN (l_orderkey + l_suppkey) % 41 = 0 THEN NULL
                ELSE CAST(date_diff('day', o_orderdate, l_shipdate) % 90 AS INTEGER) END AS dep_delay,
           CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_quantity END AS air_time
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

AIRLINES = "airlines AS (SELECT s_suppkey AS carrier, s_name AS name FROM supplier)"

GEMS = """gems AS (
    SELECT p_partkey AS gem_id, p_size / 10.0::DOUBLE AS carat,
           CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_retailprice END AS price,
           p_type AS cut, p_brand AS color, p_name AS clarity
    FROM part)"""

OUTCOMES = """outcomes AS (
    SELECT l_orderkey * 10 + l_linenumber AS student_id, l_returnflag AS major_category,
           l_linestatus AS year_of_study, l_partkey AS tie_part, l_suppkey AS tie_supp,
           CASE l_partkey % 4 WHEN 0 THEN 'Debugging' WHEN 1 THEN 'Drafting' WHEN 2 THEN 'Summarizing'
                ELSE 'Direct Answer' END AS primary_use_case,
           CASE l_partkey % 3 WHEN 0 THEN 'Beginner' WHEN 1 THEN 'Intermediate' ELSE 'Advanced' END
               AS prompt_engineering_skill,
           CASE l_suppkey % 3 WHEN 0 THEN 'Allowed' WHEN 1 THEN 'Restricted' ELSE 'Banned' END
               AS institutional_policy,
           CASE l_suppkey % 7 % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS burnout_risk_level,
           l_quantity AS weekly_genai_hours, CAST(1 + l_suppkey % 5 AS INTEGER) AS tool_diversity,
           CAST(l_partkey % 40 AS DOUBLE) AS traditional_study_hours,
           CAST(1 + l_partkey % 10 AS INTEGER) AS perceived_ai_dependency,
           CAST(1 + l_suppkey % 10 AS INTEGER) AS anxiety_level_during_exams,
           2 + l_discount * 10 AS pre_semester_gpa, 2 + l_tax * 10 AS post_semester_gpa,
           l_extendedprice / 1050 AS skill_retention_score, l_suppkey % 2 = 0 AS paid_subscription
    FROM lineitem)"""


def _features(src: str) -> str:
    return f"""SELECT *, ROUND(post_semester_gpa - pre_semester_gpa, 3) AS gpa_change,
           CASE WHEN weekly_genai_hours IS NULL THEN NULL
                WHEN weekly_genai_hours <= 2 THEN '0-2 hours' WHEN weekly_genai_hours <= 5 THEN '2-5 hours'
                WHEN weekly_genai_hours <= 10 THEN '5-10 hours' WHEN weekly_genai_hours <= 20 THEN '10-20 hours'
                ELSE '20+ hours' END AS ai_usage_band,
           CASE WHEN perceived_ai_dependency >= 7 THEN 1 ELSE 0 END AS high_dependency_flag,
           CASE WHEN anxiety_level_during_exams >= 7 THEN 1 ELSE 0 END AS high_anxiety_flag,
           CASE WHEN burnout_risk_level = 'High' THEN 1 ELSE 0 END AS high_burnout_flag,
           CASE WHEN skill_retention_score >= 80 THEN 1 ELSE 0 END AS strong_retention_flag
    FROM {src}"""


_CATS = ("major_category", "year_of_study", "primary_use_case", "prompt_engineering_skill",
         "institutional_policy", "burnout_risk_level")
_STD = ", ".join(f"regexp_replace(trim({c}), '\\s+', '_', 'g') AS {c}" for c in _CATS)

STUDENTS = f"""{OUTCOMES},
std AS (SELECT * REPLACE ({_STD}) FROM outcomes),
deduped AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY student_id
                                     ORDER BY tie_part, tie_supp, weekly_genai_hours, skill_retention_score) AS rn
        FROM std) WHERE rn = 1),
feat AS ({_features('deduped')}),
hb AS (SELECT quantile_cont(weekly_genai_hours, 0.25) AS q1, quantile_cont(weekly_genai_hours, 0.75) AS q3 FROM feat),
students AS (
    SELECT feat.*, CASE WHEN weekly_genai_hours < q1 - 1.5 * (q3 - q1) OR weekly_genai_hours > q3 + 1.5 * (q3 - q1)
                        THEN 1 ELSE 0 END AS genai_hours_outlier_flag
    FROM feat, hb)"""

# What the ingest can read of the spoilt export; null where a value is missing or cannot be cast.
TYPED = f"""{OUTCOMES},
typed AS (SELECT * REPLACE (
    CASE WHEN tie_part % 101 = 0 OR tie_part % 97 = 0 THEN NULL ELSE student_id END AS student_id,
    CASE WHEN tie_supp % 13 = 0 OR tie_supp % 17 = 0 THEN NULL ELSE weekly_genai_hours END AS weekly_genai_hours,
    CASE WHEN tie_part % 19 = 0 THEN NULL ELSE perceived_ai_dependency END AS perceived_ai_dependency,
    CASE WHEN tie_supp % 23 = 0 THEN NULL ELSE institutional_policy END AS institutional_policy,
    CASE WHEN tie_supp % 29 = 0 THEN NULL ELSE paid_subscription END AS paid_subscription) FROM outcomes)"""

INGEST = f"""{TYPED},
kept AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY student_id
                                     ORDER BY tie_part, tie_supp, weekly_genai_hours, skill_retention_score) AS rn
        FROM typed WHERE student_id IS NOT NULL) WHERE rn = 1),
med AS (SELECT quantile_cont(weekly_genai_hours, 0.5) AS mh, quantile_cont(perceived_ai_dependency, 0.5) AS md FROM kept),
filled AS (SELECT kept.* REPLACE ({_STD}) FROM kept),
whole AS (SELECT filled.* REPLACE (COALESCE(weekly_genai_hours, mh) AS weekly_genai_hours,
                                   COALESCE(perceived_ai_dependency, CAST(trunc(md) AS INTEGER)) AS perceived_ai_dependency,
                                   COALESCE(institutional_policy, 'Unknown') AS institutional_policy)
          FROM filled, med),
feat AS ({_features('whole')}),
hb AS (SELECT quantile_cont(weekly_genai_hours, 0.25) AS q1, quantile_cont(weekly_genai_hours, 0.75) AS q3 FROM feat),
students AS (
    SELECT feat.*, CASE WHEN weekly_genai_hours < q1 - 1.5 * (q3 - q1) OR weekly_genai_hours > q3 + 1.5 * (q3 - q1)
                        THEN 1 ELSE 0 END AS genai_hours_outlier_flag
    FROM feat, hb)"""

# Names as customer_messy spoils them.
MESSY = """messy AS (
    SELECT c_custkey, c_name AS plain, replace(c_name, '#', '  ') AS spaced,
           c_name || CASE c_custkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' Corporation' WHEN 2 THEN ' Air Lines Co.'
                                        ELSE '' END AS company,
           ' ' || c_mktsegment || ' ' AS segment FROM customer),
named AS (SELECT *, CASE c_custkey % 3 WHEN 0 THEN '  ' || lower(spaced) || ' ' WHEN 1 THEN upper(spaced)
                                       ELSE spaced END AS name FROM messy)"""

SPACED_DOCS = """spaced AS (
    SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN ''
                        ELSE '  ' || replace(text, '. ', '.  ' || chr(9)) || ' "' || chr(10) END AS text FROM documents)"""

DOCS_LABELED = """dl AS (
    SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
           CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END AS quality_label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def initcap(x: str) -> str:
    """Spark ``initcap``: lower-case, then upper-case the first letter after each space."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _pct(cond: str) -> str:
    return f"ROUND(100.0 * count_if({cond}) / COUNT(*), 1)"


def _delay_where(metric: str) -> str:
    return f"{metric} IS NOT NULL"


def _delay_summary(metric: str) -> str:
    return f"""WITH {SHIPMENTS}
SELECT COUNT(*) AS total_flights, ROUND(AVG({metric}), 1) AS avg_delay, ROUND(MIN({metric}), 1) AS best_delay,
       ROUND(MAX({metric}), 1) AS worst_delay, {_pct(f'{metric} <= 0')}::DOUBLE AS ontime_pct
FROM shipments WHERE {_delay_where(metric)}"""


def _long_from_row(items: list[tuple[str, ...]], fields: tuple[str, ...], src: str) -> str:
    """Unpivot one aggregate row into rows of ``fields`` (expressions refer to the row)."""
    structs = ", ".join("{" + ", ".join(f"'{f}': {v}" for f, v in zip(fields, it)) + "}" for it in items)
    return f"SELECT unnest([{structs}], recursive := true) FROM {src}"


CORR_COLUMNS = ("pre_semester_gpa", "weekly_genai_hours", "tool_diversity", "traditional_study_hours",
                "perceived_ai_dependency", "anxiety_level_during_exams", "post_semester_gpa",
                "skill_retention_score", "gpa_change", "high_burnout_flag")


def _corr_sql() -> str:
    cols = CORR_COLUMNS
    aggs = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(f"corr({cols[i]}, {cols[j]}) AS c_{i}_{j}")
    items = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            # + 0.0 turns DuckDB's -0.0 into 0.0, as Spark's ROUND returns
            v = f"ROUND(CASE WHEN isnan(c_{lo}_{hi}) THEN NULL ELSE c_{lo}_{hi} END, 3) + 0.0"
            items.append((f"'{a}'", f"'{b}'", v))
    return f"""WITH {STUDENTS}, agg AS (SELECT {', '.join(aggs)} FROM students)
{_long_from_row(items, ('col_x', 'col_y', 'corr'), 'agg')}"""


def _describe_sql() -> str:
    aggs = []
    items = []
    for i, c in enumerate(CORR_COLUMNS):
        x = f"CAST({c} AS DOUBLE)"
        aggs += [f"CAST(count({x}) AS DOUBLE) AS c{i}_count", f"avg({x}) AS c{i}_mean",
                 f"stddev_samp({x}) AS c{i}_stddev", f"min({x}) AS c{i}_min", f"max({x}) AS c{i}_max"]
        for s in ("count", "mean", "stddev", "min", "max"):
            items.append((f"'{c}'", f"'{s}'", f"ROUND(c{i}_{s}, 6)"))
    return f"""WITH {STUDENTS}, agg AS (SELECT {', '.join(aggs)} FROM students)
{_long_from_row(items, ('column_name', 'stat', 'value'), 'agg')}"""


_STUDENT_WHERE = ("weekly_genai_hours BETWEEN 0.0 AND 40.0 AND major_category IN ('A', 'R') "
                  "AND institutional_policy IN ('Allowed', 'Restricted')")
_DETAIL = ("student_id, major_category, year_of_study, pre_semester_gpa, post_semester_gpa, gpa_change, "
           "weekly_genai_hours, ai_usage_band, primary_use_case, prompt_engineering_skill, tool_diversity, "
           "traditional_study_hours, perceived_ai_dependency, anxiety_level_during_exams, skill_retention_score, "
           "burnout_risk_level, institutional_policy")
_FACETS = ("major_category", "year_of_study", "primary_use_case", "prompt_engineering_skill",
           "institutional_policy", "burnout_risk_level")

_CLEAN_FLIGHTS = f"""WITH {SHIPMENTS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY carrier, flight ORDER BY year, month, day, line, part) AS rn
             FROM shipments),
deduped AS (SELECT * EXCLUDE (rn) FROM numbered WHERE rn = 1),
med AS (SELECT quantile_cont(dep_delay, 0.5) AS m FROM deduped),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont(arr_delay, 0.25) AS q1, quantile_cont(arr_delay, 0.75) AS q3 FROM deduped)),
cleaned AS (
    SELECT deduped.*, COALESCE(dep_delay, m) AS dep_delay_filled,
           COALESCE(arr_delay IS NOT NULL AND (arr_delay < lo OR arr_delay > hi), false) AS arr_delay_outlier,
           lo AS arr_delay_iqr_lower_bound, hi AS arr_delay_iqr_upper_bound
    FROM deduped, med, b)"""


def _student_validation() -> str:
    return f"""WITH {INGEST}, m AS (
    SELECT COUNT(*) AS n, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT student_id FROM students)) AS dup,
           count_if(student_id IS NULL) AS nul,
           count_if(pre_semester_gpa < 0 OR pre_semester_gpa > 4 OR post_semester_gpa < 0 OR post_semester_gpa > 4)
               AS gpa,
           count_if(skill_retention_score < 0 OR skill_retention_score > 100) AS ret,
           count_if(weekly_genai_hours < 0) AS hrs
    FROM students)
SELECT 'Row count >= 1,000' AS check_name, CASE WHEN n >= 1000 THEN 'PASS' ELSE 'FAIL' END AS result,
       format('{{:,}} rows', n) AS detail FROM m
UNION ALL SELECT 'No duplicate student IDs', CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END,
       format('{{:,}} duplicate IDs', dup) FROM m
UNION ALL SELECT 'No NULL student IDs', CASE WHEN nul = 0 THEN 'PASS' ELSE 'FAIL' END,
       format('{{:,}} null IDs', nul) FROM m
UNION ALL SELECT 'GPA values between 0 and 4', CASE WHEN gpa = 0 THEN 'PASS' ELSE 'FAIL' END,
       format('{{:,}} invalid GPA rows', gpa) FROM m
UNION ALL SELECT 'Skill retention between 0 and 100', CASE WHEN ret = 0 THEN 'PASS' ELSE 'FAIL' END,
       format('{{:,}} invalid retention rows', ret) FROM m
UNION ALL SELECT 'Weekly GenAI hours non-negative', CASE WHEN hrs = 0 THEN 'PASS' ELSE 'FAIL' END,
       format('{{:,}} invalid hour rows', hrs) FROM m"""


def _cast_failures() -> str:
    key = "c_custkey"
    bad = {"c_custkey": "false", "c_nationkey": f"{key} % 13 = 0", "c_acctbal": f"{key} % 11 = 0",
           "c_member": f"{key} % 17 = 0"}
    absent = {"c_acctbal": f"{key} % 11 <> 0 AND {key} % 7 = 0"}
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_member": "boolean"}
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS target_type, count_if(NOT ({absent.get(c, 'false')})) AS non_null_values, "
        f"count_if({bad[c]}) AS failed_casts FROM customer" for c, t in types.items())


_RAW_COLUMNS = ("student_id", "major_category", "year_of_study", "tie_part", "tie_supp", "primary_use_case",
                "prompt_engineering_skill", "institutional_policy", "burnout_risk_level", "weekly_genai_hours",
                "tool_diversity", "traditional_study_hours", "perceived_ai_dependency", "anxiety_level_during_exams",
                "pre_semester_gpa", "post_semester_gpa", "skill_retention_score", "paid_subscription")
_CAST_COLUMNS = tuple(c for c in _RAW_COLUMNS if c not in _CATS)
_RAW_NULL = {"student_id": "tie_part % 101 = 0", "weekly_genai_hours": "tie_supp % 13 <> 0 AND tie_supp % 17 = 0",
             "perceived_ai_dependency": "tie_part % 19 = 0", "institutional_policy": "tie_supp % 23 = 0"}
_RAW_BAD = {"student_id": "tie_part % 101 <> 0 AND tie_part % 97 = 0", "weekly_genai_hours": "tie_supp % 13 = 0",
            "paid_subscription": "tie_supp % 29 = 0"}


def _ingest_audit() -> str:
    refused = "(SELECT count_if(student_id IS NULL) FROM typed)"
    parts = ["SELECT 'input rows' AS item, CAST(NULL AS VARCHAR) AS column_name, COUNT(*) AS rows FROM outcomes",
             f"SELECT 'rejected rows', NULL, {refused}", "SELECT 'kept rows', NULL, COUNT(*) FROM students",
             f"SELECT 'duplicate rows', NULL, (SELECT COUNT(*) FROM outcomes) - {refused} - (SELECT COUNT(*) FROM students)"]
    parts += [f"SELECT 'input nulls', '{c}', count_if({_RAW_NULL.get(c, 'false')}) FROM outcomes" for c in _RAW_COLUMNS]
    parts += [f"SELECT 'failed casts', '{c}', count_if({_RAW_BAD.get(c, 'false')}) FROM outcomes" for c in _CAST_COLUMNS]
    parts += [f"SELECT 'nulls left', '{c}', count_if({c} IS NULL) FROM students" for c in _RAW_COLUMNS]
    return f"WITH {INGEST}\n" + "\nUNION ALL ".join(parts)


def _describe_table_sql() -> str:
    parts = []
    for c in ("doc_id", "lang", "source", "n_chars"):
        for stat, fn in (("count", "count"), ("min", "min"), ("max", "max")):
            number = f"CAST({fn}({c}) AS DOUBLE)" if c in ("doc_id", "n_chars") or stat == "count" else "CAST(NULL AS DOUBLE)"
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS stat, CAST({fn}({c}) AS VARCHAR) AS value, "
                         f"{number} AS number FROM documents")
    return "\nUNION ALL ".join(parts)


def _null_audit_long() -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, count_if({c} IS NULL) AS missing, "
             f"ROUND(100.0 * count_if({c} IS NULL) / COUNT(*), 2)::DOUBLE AS pct_missing FROM shipments"
             for c in ("dep_delay", "arr_delay", "air_time")]
    return f"WITH {SHIPMENTS}\n" + "\nUNION ALL ".join(parts)


def _whole_type(x: str) -> str:
    return (f"CASE WHEN COUNT({x}) = 0 THEN 'string' WHEN MIN({x}) >= -2147483648 AND MAX({x}) <= 2147483647 THEN 'int' "
            f"ELSE 'bigint' END")


def _filled_type(x: str, kind: str) -> str:
    return f"CASE WHEN COUNT({x}) = 0 THEN 'string' ELSE '{kind}' END"


def _text_type(x: str) -> str:
    """The type of a text column; its values may read as numbers, truth values or days."""
    t = f"trim({x})"
    number = "[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"""CASE WHEN COUNT(CASE WHEN {t} <> '' THEN 1 END) = 0 THEN 'string'
        WHEN bool_and(lower({t}) IN ('true', 'false')) FILTER ({t} <> '') THEN 'boolean'
        WHEN bool_and(regexp_full_match({t}, '[+-]?(0|[1-9][0-9]*)') AND TRY_CAST({t} AS INTEGER) IS NOT NULL)
             FILTER ({t} <> '') THEN 'int'
        WHEN bool_and(regexp_full_match({t}, '[+-]?(0|[1-9][0-9]*)') AND TRY_CAST({t} AS BIGINT) IS NOT NULL)
             FILTER ({t} <> '') THEN 'bigint'
        WHEN bool_and(regexp_full_match({t}, '{number}')) FILTER ({t} <> '') THEN 'double'
        WHEN bool_and(regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({t} AS DATE) IS NOT NULL)
             FILTER ({t} <> '') THEN 'date' ELSE 'string' END"""


def _infer_types() -> str:
    kinds = {
        "orders": {"o_orderkey": "whole", "o_custkey": "whole", "o_orderstatus": "text", "o_totalprice": "double",
                   "o_orderdate": "timestamp", "o_orderpriority": "text"},
        "events": {"event_id": "whole", "ts": "timestamp", "user_id": "whole", "event_type": "text", "value": "double",
                   "props": "text"},
        "customer": {"c_custkey": "whole", "c_name": "text", "c_nationkey": "whole", "c_acctbal": "double",
                     "c_mktsegment": "text"}}
    found = {"whole": _whole_type, "text": _text_type}
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
        f"{found[k](c) if k in found else _filled_type(c, k)} AS inferred_type FROM {t}"
        for t, cols in kinds.items() for c, k in cols.items())


def _ingest_types() -> str:
    """A column that holds a value spoilt beyond its type is text; gaps do not matter."""
    spoilt = {"student_id": "tie_part % 101 <> 0 AND tie_part % 97 = 0", "weekly_genai_hours": "tie_supp % 13 = 0",
              "paid_subscription": "tie_supp % 29 = 0"}
    plan = {"student_id": "bigint", "tie_part": "bigint", "tie_supp": "bigint", "pre_semester_gpa": "double",
            "weekly_genai_hours": "double", "traditional_study_hours": "double", "post_semester_gpa": "double",
            "skill_retention_score": "double", "tool_diversity": "int", "perceived_ai_dependency": "int",
            "anxiety_level_during_exams": "int", "paid_subscription": "boolean", **{c: "string" for c in _CATS}}
    rows = []
    for c, t in plan.items():
        kind = _whole_type(c) if t in ("int", "bigint") else _filled_type(c, t)
        if c in spoilt:
            kind = f"CASE WHEN count_if({spoilt[c]}) > 0 THEN 'string' ELSE {kind} END"
        rows.append(f"SELECT '{c}' AS column_name, {kind} AS inferred_type, '{t}' AS planned_type FROM typed")
    return f"WITH {TYPED}\n" + "\nUNION ALL ".join(rows)


def _report_cube() -> str:
    facets = "major_category IN ('A', 'R') AND institutional_policy IN ('Allowed', 'Restricted')"

    def part(name: str, key: str, first: str, second: str, where: str = "true") -> str:
        group = f"GROUP BY {key}" if not key.startswith("'") else ""
        return (f"SELECT '{name}' AS report, {key} AS key, COUNT(*) AS students, {first} AS first_figure, "
                f"{second} AS second_figure FROM students WHERE {where} {group}")

    def avg(c: str, digits: int) -> str:
        return f"ROUND(AVG({c}), {digits})"

    def pct(c: str) -> str:
        return f"ROUND(100.0 * AVG({c}), 2)"

    parts = [
        part("summary", "'all'", avg("weekly_genai_hours", 2), avg("anxiety_level_during_exams", 2), facets),
        part("band", "ai_usage_band", avg("gpa_change", 3), avg("perceived_ai_dependency", 2)),
        part("band filtered", "ai_usage_band", avg("skill_retention_score", 2), pct("high_burnout_flag"), facets),
        part("skill", "prompt_engineering_skill", avg("tool_diversity", 2), pct("strong_retention_flag")),
        part("policy", "institutional_policy", pct("high_burnout_flag"), pct("high_dependency_flag")),
        part("use case", "primary_use_case", avg("weekly_genai_hours", 2), avg("skill_retention_score", 2)),
        "SELECT 'rank', major_category || '|' || ai_usage_band, students, change, CAST(place AS DOUBLE) FROM ranked "
        "WHERE place <= 3",
        part("burnout", "ai_usage_band || '|' || burnout_risk_level", "NULL::DOUBLE", "NULL::DOUBLE"),
    ]
    return f"""WITH {STUDENTS}, bands AS (
    SELECT major_category, ai_usage_band, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS change
    FROM students GROUP BY major_category, ai_usage_band),
ranked AS (SELECT *, RANK() OVER (PARTITION BY major_category ORDER BY change DESC) AS place FROM bands)
""" + "\nUNION ALL ".join(parts)


ORACLE_SQL: dict[str, str] = {
    # flights ------------------------------------------------------------------------
    "carrier_comparison": f"""WITH {SHIPMENTS}, {AIRLINES}
SELECT a.name AS airline, f.carrier, COUNT(*) AS flights, ROUND(AVG(f.arr_delay), 1) AS avg_delay,
       ROUND(MIN(f.arr_delay), 1) AS best_delay, ROUND(MAX(f.arr_delay), 1) AS worst_delay,
       {_pct('f.arr_delay <= 0')}::DOUBLE AS ontime_pct
FROM shipments f LEFT JOIN airlines a ON f.carrier = a.carrier
WHERE {_delay_where('f.arr_delay')}
GROUP BY a.name, f.carrier ORDER BY avg_delay, f.carrier""",
    "delay_summary": _delay_summary("arr_delay"),
    "delay_summary_departure": _delay_summary("dep_delay"),
    "carrier_delay_summary": f"""WITH {SHIPMENTS}
SELECT COUNT(*) AS total_flights, ROUND(AVG(dep_delay), 1) AS avg_delay, ROUND(MIN(dep_delay), 1) AS best_delay,
       ROUND(MAX(dep_delay), 1) AS worst_delay, {_pct('dep_delay <= 0')}::DOUBLE AS ontime_pct
FROM shipments WHERE dep_delay IS NOT NULL AND month BETWEEN 3 AND 9 AND dep_delay >= 15 AND carrier = 7""",
    "carrier_delay_by_month": f"""WITH {SHIPMENTS}
SELECT month, ROUND(AVG(arr_delay), 2) AS avg_delay, COUNT(*) AS flights FROM shipments
WHERE arr_delay IS NOT NULL AND month BETWEEN 3 AND 9 AND arr_delay >= 15 AND carrier = 7
GROUP BY month ORDER BY month""",
    "delay_by_month": f"""WITH {SHIPMENTS}
SELECT month, ROUND(AVG(arr_delay), 2) AS avg_delay, COUNT(*) AS flights FROM shipments
WHERE {_delay_where('arr_delay')} GROUP BY month ORDER BY month""",
    "worst_delays": f"""WITH {SHIPMENTS}, {AIRLINES}
SELECT f.year, f.month, f.day, f.carrier, a.name AS airline, f.flight, f.origin, f.dest,
       f.arr_delay AS selected_delay, f.dep_delay, f.arr_delay, f.air_time
FROM shipments f LEFT JOIN airlines a ON f.carrier = a.carrier
WHERE {_delay_where('f.arr_delay')}
ORDER BY f.arr_delay DESC NULLS LAST, f.carrier, f.flight, f.line LIMIT 10""",
    "delay_histogram": f"""WITH {SHIPMENTS}, binned AS (
    SELECT CAST(LEAST(FLOOR((arr_delay - (-60)) / 5.0), 59) AS INTEGER) AS bin FROM shipments
    WHERE {_delay_where('arr_delay')} AND arr_delay BETWEEN -60 AND 240)
SELECT bin, CAST(-60 + bin * 5.0 AS DOUBLE) AS bin_lo, CAST(-60 + (bin + 1) * 5.0 AS DOUBLE) AS bin_hi,
       COUNT(*) AS flights
FROM binned GROUP BY bin ORDER BY bin""",
    "delay_histogram_all_bins": f"""WITH {SHIPMENTS}, binned AS (
    SELECT CAST(LEAST(FLOOR((dep_delay - (-60)) / 5.0), 59) AS INTEGER) AS bin FROM shipments
    WHERE {_delay_where('dep_delay')} AND dep_delay BETWEEN -60 AND 240),
axis AS (SELECT CAST(range AS INTEGER) AS bin FROM range(60))
SELECT axis.bin, CAST(-60 + axis.bin * 5.0 AS DOUBLE) AS bin_lo, CAST(-60 + (axis.bin + 1) * 5.0 AS DOUBLE) AS bin_hi,
       COUNT(binned.bin) AS flights
FROM axis LEFT JOIN binned ON axis.bin = binned.bin GROUP BY axis.bin ORDER BY axis.bin""",
    "origin_share": f"""WITH {SHIPMENTS}, f AS (SELECT * FROM shipments WHERE {_delay_where('arr_delay')})
SELECT origin, COUNT(*) AS flights, ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM f), 2)::DOUBLE AS share_pct
FROM f GROUP BY origin ORDER BY flights DESC, origin""",
    "airline_options": f"WITH {AIRLINES} SELECT carrier, name FROM airlines ORDER BY name, carrier",
    # duplicates ---------------------------------------------------------------------
    "find_duplicates": """SELECT l_orderkey, l_linenumber, COUNT(*) AS num_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
ORDER BY num_records DESC, l_orderkey, l_linenumber LIMIT 10""",
    "dedup_keep_first": """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1""",
    "duplicate_summary": """SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys,
       CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows, count_if(n > 1) AS duplicate_keys
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "dedup_full_row": "SELECT DISTINCT * FROM lineitem",
    "dedup_any_survivor": "SELECT DISTINCT l_orderkey, l_returnflag, TRUE AS member FROM lineitem",
    "key_report": """WITH r AS (SELECT *, CASE WHEN l_suppkey = 3 THEN 40 WHEN l_partkey % 10 = 0 THEN 2 ELSE 1 END AS copies
  FROM lineitem),
n AS (SELECT CAST(SUM(copies) AS BIGINT) AS rows FROM r),
k AS (SELECT (SELECT rows FROM n) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM r)) AS a,
  (SELECT COUNT(*) FROM (SELECT 1 FROM r GROUP BY l_orderkey, l_partkey HAVING SUM(copies) > 1)) AS b,
  (SELECT rows FROM n) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_shipdate FROM r)) AS c)
SELECT 'One row per order line' AS check_name, CASE WHEN a = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  a || ' repeated rows' AS detail FROM k
UNION ALL SELECT 'One line per order and part', CASE WHEN b = 0 THEN 'PASS' ELSE 'FAIL' END, b || ' repeated keys' FROM k
UNION ALL SELECT 'One line per part, supplier and day', CASE WHEN c = 0 THEN 'PASS' ELSE 'FAIL' END, c || ' repeated rows' FROM k
UNION ALL SELECT 'Rows', CASE WHEN rows >= 1 THEN 'PASS' ELSE 'FAIL' END, rows || ' rows' FROM n""",
    # missing values -----------------------------------------------------------------
    "null_audit": f"""WITH {SHIPMENTS}
SELECT COUNT(*) AS total_rows, count_if(dep_delay IS NULL) AS missing_dep_delay,
       count_if(arr_delay IS NULL) AS missing_arr_delay, count_if(air_time IS NULL) AS missing_air_time,
       ROUND(100.0 * count_if(dep_delay IS NULL) / COUNT(*), 2)::DOUBLE AS pct_dep_delay,
       ROUND(100.0 * count_if(arr_delay IS NULL) / COUNT(*), 2)::DOUBLE AS pct_arr_delay,
       ROUND(100.0 * count_if(air_time IS NULL) / COUNT(*), 2)::DOUBLE AS pct_air_time
FROM shipments""",
    "null_audit_long": _null_audit_long(),
    "null_audit_all": f"""WITH {DOCS_LABELED}
SELECT count_if(doc_id IS NULL) AS doc_id, count_if(lang IS NULL) AS lang, count_if(source IS NULL) AS source,
       count_if(n_chars IS NULL) AS n_chars, count_if(quality IS NULL) AS quality, count_if(toxic IS NULL) AS toxic,
       count_if(quality_label IS NULL) AS quality_label
FROM dl""",
    "fill_recommendation": f"""WITH {DOCS_LABELED}, a AS (
    SELECT COUNT(*) AS n, count_if(doc_id IS NULL) AS doc_id, count_if(lang IS NULL) AS lang,
           count_if(source IS NULL) AS source, count_if(n_chars IS NULL) AS n_chars,
           count_if(quality IS NULL) AS quality, count_if(toxic IS NULL) AS toxic,
           count_if(quality_label IS NULL) AS quality_label FROM dl),
l AS (SELECT * FROM (VALUES ('doc_id', 'bigint'), ('lang', 'string'), ('source', 'string'), ('n_chars', 'bigint'),
                            ('quality', 'int'), ('toxic', 'int'), ('quality_label', 'string')) t(column_name, data_type)),
m AS (SELECT l.column_name, l.data_type,
             CASE l.column_name WHEN 'doc_id' THEN a.doc_id WHEN 'lang' THEN a.lang WHEN 'source' THEN a.source
                  WHEN 'n_chars' THEN a.n_chars WHEN 'quality' THEN a.quality WHEN 'toxic' THEN a.toxic
                  ELSE a.quality_label END AS missing, a.n
      FROM l, a)
SELECT column_name, data_type, missing, ROUND(100.0 * missing / n, 2)::DOUBLE AS pct_missing,
       CASE WHEN missing = 0 THEN 'none needed'
            WHEN 100.0 * missing / n > 30.0 THEN 'leave null or drop column'
            WHEN data_type IN ('tinyint', 'smallint', 'int', 'bigint', 'float', 'double') THEN 'fill with median'
            ELSE 'fill with mode or Unknown' END AS strategy
FROM m""",
    "table_shape": """SELECT COUNT(*) AS row_count,
       (SELECT CAST(COUNT(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS column_count
FROM lineitem""",
    "drop_missing": f"WITH {SHIPMENTS} SELECT * FROM shipments WHERE arr_delay IS NOT NULL",
    "fill_mean": f"""WITH {SHIPMENTS}
SELECT carrier, flight, line, COALESCE(arr_delay, (SELECT AVG(arr_delay) FROM shipments)) AS arr_delay
FROM shipments""",
    "fill_median": f"""WITH {SHIPMENTS}
SELECT carrier, flight, line, arr_delay,
       COALESCE(arr_delay, (SELECT quantile_cont(arr_delay, 0.5) FROM shipments)) AS arr_delay_filled
FROM shipments""",
    "fill_median_approx": f"WITH {SHIPMENTS}\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, count_if({c} IS NULL) AS nulls_before, "
        f"CAST(0 AS BIGINT) AS nulls_after, true AS within_bound FROM shipments"
        for c in ("dep_delay", "arr_delay", "air_time")),
    "mean_vs_median": f"""WITH {SHIPMENTS}
SELECT ROUND(AVG(arr_delay), 2) AS mean_arr_delay, true AS within_bound FROM shipments WHERE arr_delay IS NOT NULL""",
    "fill_unknown": f"WITH {DOCS_LABELED} SELECT doc_id, lang, COALESCE(quality_label, 'Unknown') AS quality_label FROM dl",
    "fill_mode": f"""WITH {DOCS_LABELED}
SELECT doc_id,
       COALESCE(quality, (SELECT quality FROM dl WHERE quality IS NOT NULL GROUP BY quality
                          ORDER BY COUNT(*) DESC, quality LIMIT 1)) AS quality,
       COALESCE(toxic, (SELECT toxic FROM dl WHERE toxic IS NOT NULL GROUP BY toxic
                        ORDER BY COUNT(*) DESC, toxic LIMIT 1)) AS toxic
FROM dl""",
    "missing_indicator": f"""WITH {DOCS_LABELED}
SELECT doc_id, CAST(quality IS NULL AS INTEGER) AS quality_missing, CAST(toxic IS NULL AS INTEGER) AS toxic_missing
FROM dl""",
    "approx_quantiles": "SELECT CAST(p AS DOUBLE) AS p, true AS within_bound FROM (VALUES (0.25), (0.5), (0.75)) t(p)",
    # text and types -----------------------------------------------------------------
    "clean_names": f"""WITH {MESSY}, t AS (
    SELECT *, trim(name) AS without, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS single FROM named)
SELECT c_custkey, name, without AS without_outer_spaces, upper(without) AS upper, lower(without) AS lower,
       single AS single_spaced, {initcap('single')} AS proper, lower(trim(segment)) AS segment_key
FROM t""",
    "strip_suffix": rf"""WITH {MESSY}
SELECT c_custkey, company, trim(regexp_replace(company, ' (Inc\.|Co\.|Corporation|Airlines|Air Lines)', '', 'g')) AS stripped
FROM named""",
    "collapse_whitespace": rf"""WITH {SPACED_DOCS}
SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean_text FROM spaced""",
    "standardise_category": r"""SELECT o_orderkey, regexp_replace(trim(o_orderpriority), '\s+', '_', 'g') AS o_orderpriority,
       regexp_replace(trim(o_orderstatus), '\s+', '_', 'g') AS o_orderstatus FROM orders""",
    "string_functions": """SELECT c_custkey, ltrim('  ' || c_name) AS ltrimmed, rtrim(c_name || '  ') AS rtrimmed,
       substring(c_name, 10, 9) AS name_number, CAST(length(c_name) AS INTEGER) AS name_length,
       concat(c_name, ' (', c_mktsegment, ')') AS label,
       printf('%s has balance %.2f', c_name, c_acctbal) AS balance_text,
       format('{:,.2f}', c_acctbal) AS balance_grouped
FROM customer""",
    "cast_columns": """SELECT * REPLACE (CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
                 CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal),
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS c_member FROM customer""",
    "cast_failures": _cast_failures(),
    "schema_report": """SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal_position, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type,
       "null" = 'YES' AS is_nullable
FROM (DESCRIBE lineitem)""",
    "snake_case_columns": f"WITH {OUTCOMES} SELECT * FROM outcomes",
    # outliers and validation ----------------------------------------------------------
    "iqr_report": """WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT COUNT(*) AS total, count_if(value < q1 - 1.5 * (q3 - q1)) AS low_outliers,
       count_if(value > q3 + 1.5 * (q3 - q1)) AS high_outliers,
       ROUND(q1 - 1.5 * (q3 - q1), 2) AS lower_bound, ROUND(q3 + 1.5 * (q3 - q1), 2) AS upper_bound
FROM events, b GROUP BY q1, q3""",
    "iqr_flag": """WITH b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
           FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
SELECT event_id, value, COALESCE(value IS NOT NULL AND (value < lo OR value > hi), false) AS value_outlier,
       ROUND(lo, 4) AS lower_bound, ROUND(hi, 4) AS upper_bound
FROM events, b""",
    "zscore_outliers": """WITH s AS (SELECT AVG(value) AS mu, STDDEV_SAMP(value) AS sd FROM events)
SELECT event_id, value, ROUND((value - mu) / sd, 2) AS z_score FROM events, s
WHERE value IS NOT NULL AND ABS((value - mu) / sd) > 3""",
    "domain_values": f"WITH {GEMS} SELECT DISTINCT cut FROM gems WHERE cut IS NOT NULL ORDER BY cut",
    "invalid_values": f"""WITH {GEMS}
SELECT cut, COUNT(*) AS invalid_rows FROM gems
WHERE cut NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD') GROUP BY cut""",
    "validation_report": f"""WITH {SHIPMENTS}, {GEMS}
SELECT 'Row count > 300000' AS check_name, CASE WHEN COUNT(*) > 300000 THEN 'PASS' ELSE 'FAIL' END AS result,
       CAST(COUNT(*) AS VARCHAR) AS detail FROM shipments
UNION ALL
SELECT 'No NULL carrier', CASE WHEN count_if(carrier IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END,
       CAST(count_if(carrier IS NULL) AS VARCHAR) FROM shipments
UNION ALL
SELECT 'arr_delay missing < 5%',
       CASE WHEN 100.0 * count_if(arr_delay IS NULL) / COUNT(*) < 5 THEN 'PASS' ELSE 'FAIL' END,
       printf('%.2f%%', ROUND(100.0 * count_if(arr_delay IS NULL) / COUNT(*), 2)) FROM shipments
UNION ALL
SELECT 'All diamond cuts valid',
       CASE WHEN count_if(cut NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')) = 0 THEN 'PASS' ELSE 'FAIL' END,
       count_if(cut NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')) || ' invalid rows' FROM gems
UNION ALL
SELECT 'Diamond price > 0', CASE WHEN count_if(price <= 0) = 0 THEN 'PASS' ELSE 'FAIL' END,
       count_if(price <= 0) || ' invalid rows' FROM gems""",
    # students -----------------------------------------------------------------------
    "bands_and_flags": f"""WITH {OUTCOMES}, f AS ({_features('outcomes')})
SELECT student_id, tie_part, tie_supp, gpa_change, ai_usage_band, high_dependency_flag, high_anxiety_flag,
       high_burnout_flag, strong_retention_flag FROM f""",
    "outcomes_by_band": f"""WITH {STUDENTS}
SELECT ai_usage_band, COUNT(*) AS students, ROUND(AVG(weekly_genai_hours), 2) AS avg_weekly_genai_hours,
       ROUND(AVG(gpa_change), 3) AS avg_gpa_change, ROUND(AVG(post_semester_gpa), 3) AS avg_post_gpa,
       ROUND(AVG(skill_retention_score), 2) AS avg_skill_retention,
       ROUND(AVG(anxiety_level_during_exams), 2) AS avg_exam_anxiety,
       ROUND(AVG(perceived_ai_dependency), 2) AS avg_ai_dependency,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct
FROM students GROUP BY ai_usage_band""",
    "outcomes_by_skill": f"""WITH {STUDENTS}
SELECT prompt_engineering_skill, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_skill_retention, ROUND(AVG(tool_diversity), 2) AS avg_tool_diversity,
       ROUND(AVG(anxiety_level_during_exams), 2) AS avg_exam_anxiety,
       ROUND(100.0 * AVG(strong_retention_flag), 2) AS strong_retention_pct
FROM students GROUP BY prompt_engineering_skill ORDER BY avg_gpa_change DESC""",
    "outcomes_by_policy": f"""WITH {STUDENTS}
SELECT institutional_policy, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_skill_retention,
       ROUND(AVG(anxiety_level_during_exams), 2) AS avg_exam_anxiety,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct,
       ROUND(100.0 * AVG(high_dependency_flag), 2) AS high_dependency_pct
FROM students GROUP BY institutional_policy ORDER BY high_burnout_pct DESC""",
    "outcomes_by_use_case": f"""WITH {STUDENTS}
SELECT primary_use_case, COUNT(*) AS students, ROUND(AVG(weekly_genai_hours), 2) AS avg_weekly_genai_hours,
       ROUND(AVG(gpa_change), 3) AS avg_gpa_change, ROUND(AVG(skill_retention_score), 2) AS avg_skill_retention,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct
FROM students GROUP BY primary_use_case ORDER BY avg_gpa_change DESC""",
    "band_summary": f"""WITH {STUDENTS}
SELECT ai_usage_band, COUNT(student_id) AS students, ROUND(AVG(gpa_change), 2) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_retention, ROUND(AVG(anxiety_level_during_exams), 2) AS avg_anxiety,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct
FROM students GROUP BY ai_usage_band""",
    "rank_bands_in_group": f"""WITH {STUDENTS}, band_stats AS (
    SELECT major_category, ai_usage_band, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
           ROUND(AVG(skill_retention_score), 2) AS avg_skill_retention
    FROM students GROUP BY major_category, ai_usage_band),
ranked AS (SELECT *, CAST(RANK() OVER (PARTITION BY major_category ORDER BY avg_gpa_change DESC) AS INTEGER)
                  AS band_rank FROM band_stats)
SELECT * FROM ranked WHERE band_rank <= 3 ORDER BY major_category, band_rank, ai_usage_band""",
    "pivot_group_by_band": f"""WITH {STUDENTS}
SELECT major_category,
       ROUND(AVG(CASE WHEN ai_usage_band = '0-2 hours' THEN gpa_change END), 3) AS "0-2 hours",
       ROUND(AVG(CASE WHEN ai_usage_band = '2-5 hours' THEN gpa_change END), 3) AS "2-5 hours",
       ROUND(AVG(CASE WHEN ai_usage_band = '5-10 hours' THEN gpa_change END), 3) AS "5-10 hours",
       ROUND(AVG(CASE WHEN ai_usage_band = '10-20 hours' THEN gpa_change END), 3) AS "10-20 hours",
       ROUND(AVG(CASE WHEN ai_usage_band = '20+ hours' THEN gpa_change END), 3) AS "20+ hours"
FROM students GROUP BY major_category ORDER BY major_category""",
    "band_level_counts": f"""WITH {STUDENTS}
SELECT ai_usage_band, burnout_risk_level, COUNT(*) AS students FROM students
GROUP BY ai_usage_band, burnout_risk_level""",
    "correlation_matrix": _corr_sql(),
    "describe_numeric": _describe_sql(),
    "describe_table": _describe_table_sql(),
    "facet_options": f"""WITH {GEMS}, {STUDENTS}
SELECT DISTINCT 'cut' AS facet, cut AS value FROM gems WHERE cut IS NOT NULL
UNION ALL
SELECT DISTINCT facet, value FROM (
    {' UNION ALL '.join(f"SELECT '{c}' AS facet, CAST({c} AS VARCHAR) AS value FROM students" for c in _FACETS)}
) WHERE value IS NOT NULL""",
    "filtered_summary": f"""WITH {STUDENTS}
SELECT COUNT(*) AS students, ROUND(AVG(weekly_genai_hours), 2) AS avg_genai_hours,
       ROUND(AVG(gpa_change), 3) AS avg_gpa_change, ROUND(AVG(post_semester_gpa), 3) AS avg_post_gpa,
       ROUND(AVG(skill_retention_score), 2) AS avg_retention, ROUND(AVG(anxiety_level_during_exams), 2) AS avg_anxiety,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct
FROM students WHERE {_STUDENT_WHERE}""",
    "filtered_detail": f"""WITH {STUDENTS}
SELECT {_DETAIL} FROM students WHERE {_STUDENT_WHERE}
ORDER BY gpa_change DESC NULLS LAST, student_id LIMIT 1000""",
    "filtered_band_overview": f"""WITH {STUDENTS}
SELECT ai_usage_band, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_retention, ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct
FROM students WHERE {_STUDENT_WHERE} GROUP BY ai_usage_band""",
    "filtered_skill_comparison": f"""WITH {STUDENTS}
SELECT prompt_engineering_skill, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_retention, ROUND(AVG(tool_diversity), 2) AS avg_tool_diversity,
       ROUND(100.0 * AVG(strong_retention_flag), 2) AS strong_retention_pct
FROM students WHERE {_STUDENT_WHERE} GROUP BY prompt_engineering_skill""",
    "filtered_policy_outcomes": f"""WITH {STUDENTS}
SELECT institutional_policy, COUNT(*) AS students, ROUND(AVG(gpa_change), 3) AS avg_gpa_change,
       ROUND(AVG(skill_retention_score), 2) AS avg_retention, ROUND(AVG(anxiety_level_during_exams), 2) AS avg_anxiety,
       ROUND(100.0 * AVG(high_burnout_flag), 2) AS high_burnout_pct,
       ROUND(100.0 * AVG(high_dependency_flag), 2) AS high_dependency_pct
FROM students WHERE {_STUDENT_WHERE} GROUP BY institutional_policy""",
    "filtered_band_level_counts": f"""WITH {STUDENTS}
SELECT ai_usage_band, burnout_risk_level, COUNT(*) AS students FROM students WHERE {_STUDENT_WHERE}
GROUP BY ai_usage_band, burnout_risk_level""",
    "filtered_scatter_sample": f"""WITH {STUDENTS}
SELECT student_id, weekly_genai_hours, skill_retention_score, gpa_change, major_category, year_of_study,
       burnout_risk_level, prompt_engineering_skill
FROM students WHERE {_STUDENT_WHERE}
ORDER BY substr(md5(length(CAST(student_id AS VARCHAR)) || ':' || student_id || '#42'), 1, 13), student_id
LIMIT 5000""",
    "sample_repeatable": f"""WITH {STUDENTS}
SELECT student_id, weekly_genai_hours, skill_retention_score, gpa_change, major_category, year_of_study,
       burnout_risk_level, prompt_engineering_skill
FROM students ORDER BY substr(md5(length(CAST(student_id AS VARCHAR)) || ':' || student_id || '#42'), 1, 13), student_id
LIMIT 5000""",
    # diamonds -----------------------------------------------------------------------
    "price_summary": f"""WITH {GEMS}
SELECT COUNT(*) AS total_diamonds, ROUND(AVG(price), 2) AS avg_price, ROUND(AVG(carat), 2) AS avg_carat,
       ROUND(MIN(price), 2) AS min_price, ROUND(MAX(price), 2) AS max_price
FROM gems WHERE price IS NOT NULL AND carat IS NOT NULL AND cut IS NOT NULL""",
    "price_summary_cut": f"""WITH {GEMS}
SELECT COUNT(*) AS total_diamonds, ROUND(AVG(price), 2) AS avg_price, ROUND(AVG(carat), 2) AS avg_carat,
       ROUND(MIN(price), 2) AS min_price, ROUND(MAX(price), 2) AS max_price
FROM gems WHERE price IS NOT NULL AND carat IS NOT NULL AND cut IS NOT NULL AND cut = 'MEDIUM'""",
    "price_by_cut": f"""WITH {GEMS}
SELECT cut, COUNT(*) AS diamonds, ROUND(AVG(price), 2) AS avg_price, ROUND(AVG(carat), 2) AS avg_carat
FROM gems WHERE price IS NOT NULL AND carat IS NOT NULL AND cut IS NOT NULL
GROUP BY cut ORDER BY avg_price DESC""",
    "sample_random": f"""WITH {GEMS}, f AS (SELECT * FROM gems WHERE price IS NOT NULL AND carat IS NOT NULL
                                                      AND cut IS NOT NULL)
SELECT least(500, COUNT(*)) AS sampled, least(500, COUNT(*)) AS different, least(500, COUNT(*)) AS members FROM f""",
    "sample_strata": """SELECT event_type, value IS NULL AS no_value, COUNT(*) AS total_rows, TRUE AS as_expected
FROM events GROUP BY event_type, value IS NULL""",
    # pipelines and sinks ------------------------------------------------------------
    "cleaning_pipeline": f"{_CLEAN_FLIGHTS}\nSELECT * FROM cleaned",
    "cleaning_pipeline_sql": f"{_CLEAN_FLIGHTS}\nSELECT * FROM cleaned",
    "cleaning_pipeline_report": f"""{_CLEAN_FLIGHTS},
m AS (SELECT COUNT(*) AS n, count_if(dep_delay_filled IS NULL) AS fill_missing,
             count_if(carrier IS NULL) AS carrier_missing, count_if(arr_delay_outlier) AS outliers,
             MIN(arr_delay_iqr_lower_bound) AS lo, MAX(arr_delay_iqr_upper_bound) AS hi,
             (SELECT count_if(k > 1) FROM (SELECT COUNT(*) AS k FROM cleaned GROUP BY carrier, flight)) AS dup
      FROM cleaned)
SELECT 'Cleaned row count is positive' AS check_name, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS result,
       n || ' cleaned rows' AS detail FROM m
UNION ALL SELECT 'No duplicate records by carrier/flight', CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END,
       dup || ' duplicate key groups' FROM m
UNION ALL SELECT 'Missing dep_delay filled with median', CASE WHEN fill_missing = 0 THEN 'PASS' ELSE 'FAIL' END,
       fill_missing || ' missing dep_delay values' FROM m
UNION ALL SELECT 'No NULL carrier values', CASE WHEN carrier_missing = 0 THEN 'PASS' ELSE 'FAIL' END,
       carrier_missing || ' missing carrier values' FROM m
UNION ALL SELECT 'arr_delay outlier flag created', 'PASS', outliers || ' rows flagged as outliers' FROM m
UNION ALL SELECT 'IQR bounds are valid', CASE WHEN lo < hi THEN 'PASS' ELSE 'FAIL' END,
       printf('lower=%.2f, upper=%.2f', ROUND(lo, 2), ROUND(hi, 2)) FROM m""",
    "ingest_pipeline": f"WITH {INGEST} SELECT * FROM students",
    "ingest_rejects": f"""WITH {OUTCOMES}
SELECT CASE WHEN tie_part % 101 = 0 THEN NULL ELSE 'S-' || student_id END AS student_id,
       CAST(tie_part AS VARCHAR) AS tie_part, CAST(tie_supp AS VARCHAR) AS tie_supp,
       CASE WHEN tie_part % 101 = 0 THEN 'id missing' ELSE 'id not a number' END AS reject_reason
FROM outcomes WHERE tie_part % 101 = 0 OR tie_part % 97 = 0""",
    "ingest_audit": _ingest_audit(),
    "temp_view_from_query": f"""WITH {SHIPMENTS}
SELECT origin, COUNT(*) AS late, MAX(arr_delay) AS worst FROM shipments WHERE arr_delay > 0 GROUP BY origin""",
    "table_overwrite": f"WITH {GEMS} SELECT gem_id, cut, COALESCE(price, 0.0) AS price_or_zero FROM gems",
    "table_self_overwrite": "SELECT v.version, o_orderkey, o_totalprice, v.version - 1 AS raised FROM orders, "
                            "(VALUES (1), (2), (3)) v(version) "
                            "WHERE NOT (v.version >= 2 AND o_orderkey % 7 = 1) AND NOT (v.version = 3 AND o_orderkey % 7 = 2)",
    "csv_text_round_trip": f"WITH {SPACED_DOCS} SELECT doc_id, text FROM spaced",
    "ingest_validation": _student_validation(),
    "ingest_types": _ingest_types(),
    "infer_types": _infer_types(),
    "report_cube": _report_cube(),
    "ordered_export": f"WITH {STUDENTS} SELECT {_DETAIL} FROM students WHERE {_STUDENT_WHERE}",
    "cleaned_row_count": f"WITH {STUDENTS} SELECT COUNT(*) AS cleaned_rows FROM students",
    "csv_round_trip": f"WITH {GEMS} SELECT * FROM gems",
}


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``: DuckDB returns HUGEINT, Spark BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST(count_if({_bigint_counts(sql[j + len(key):k - 1])}) AS BIGINT)")
        i = k


ORACLE_SQL = {name: _bigint_counts(sql) for name, sql in ORACLE_SQL.items()}
