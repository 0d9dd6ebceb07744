import pytest
from pyspark.sql import functions as F

from scrubjay.plans import pipelines
from scrubjay.session import cut_lineage, drop_scratch, ensure_checkpoint_dir, scratch_path
from scrubjay.sources import files, fixtures
from scrubjay.sources.tables import load

from .conftest import SF_SMALL


def test_snake_case_rejects_collisions_and_empty(spark):
    df = spark.createDataFrame([(1, 2)], "`Student ID` int, `student_id` int")
    with pytest.raises(ValueError, match="collide"):
        files.snake_case_columns(df)
    with pytest.raises(ValueError, match="empty"):
        files.snake_case_columns(spark.createDataFrame([(1,)], "`--` int"))


def test_schema_report_with_expected(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    exp = spark.createDataFrame([], "id bigint, s string").schema
    rows = {r.column_name: (r.data_type, r.type_matches) for r in files.schema_report(df, exp).collect()}
    assert rows == {"id": ("int", False), "s": ("string", True)}


def test_csv_round_trip_and_table_overwrite(spark):
    gems = fixtures.gems(spark, SF_SMALL)
    path = files.write_csv(gems, scratch_path(spark, "t-gems"))
    back = files.read_csv(spark, path, schema=gems.schema)
    assert back.exceptAll(gems).count() == 0 and gems.exceptAll(back).count() == 0
    target = scratch_path(spark, "t-table")
    files.save_table(gems.select("gem_id"), path=target)
    saved = files.save_table(gems.select("gem_id", "cut"), path=target)  # overwrite with a new schema
    assert saved.columns == ["gem_id", "cut"] and saved.count() == gems.count()


def test_checkpoint_dir_comes_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and scratch_path(spark, "x").startswith(d.rstrip("/"))
    df = cut_lineage(spark.range(10))
    assert df.count() == 10


def test_csv_keeps_every_text(spark):
    rows = [(1, "  pad "), (2, "a\nb"), (3, ""), (4, None), (5, 'say "hi", then \\'), (6, "x\r\ny"), (7, ",,"), (8, '"')]
    df = spark.createDataFrame(rows, "id int, s string")
    back = files.read_csv(spark, files.write_csv(df, scratch_path(spark, "t-text")), schema=df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_no_machine_local_scratch_on_a_cluster(spark):
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, master):
            self.conf = Conf({"spark.master": master})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session("local-cluster[2,1,1024]"))
    assert ensure_checkpoint_dir(Session("local[4]"))


def test_scratch_can_be_dropped(spark):
    path = scratch_path(spark, "t-drop")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError):
        drop_scratch(spark, "/root/testdata")


def test_ingest_loses_no_row(spark):
    raw = fixtures.outcomes_raw(spark, SF_SMALL)
    csv = pipelines.write_raw_csv(raw, scratch_path(spark, "t-raw"))
    header = files.read_csv(spark, csv).columns
    assert "Student Id" in header and "Weekly Genai Hours" in header
    done = pipelines.ingest_students(spark, csv, scratch_path(spark, "t-clean"))
    audit = {(r["item"], r["column_name"]): r["rows"] for r in done.audit.collect()}
    parts = [audit[(k, None)] for k in ("rejected rows", "kept rows", "duplicate rows")]
    assert sum(parts) == audit[("input rows", None)] == raw.count() and parts[0] > 0
    assert audit[("failed casts", "weekly_genai_hours")] > 0 and audit[("nulls left", "paid_subscription")] > 0
    assert {r.reject_reason for r in done.rejects.collect()} == {"id missing", "id not a number"}
    rep = {r.check_name: r.result for r in pipelines.student_validation(done.table).collect()}
    assert rep["No duplicate student IDs"] == "PASS" and rep["No NULL student IDs"] == "PASS"
    assert set(done.table.columns) >= {"gpa_change", "ai_usage_band", "genai_hours_outlier_flag"}
    assert done.table.where("weekly_genai_hours IS NULL").count() == 0


def test_ingest_reads_its_csv_once(spark, monkeypatch):
    csv = pipelines.write_raw_csv(fixtures.outcomes_raw(spark, SF_SMALL), scratch_path(spark, "t-once"))
    read, lines = files.read_csv, spark.sparkContext.accumulator(0)

    def watched(session, path, **kw):
        df = read(session, path, **kw)

        def look(batches):
            for batch in batches:
                lines.add(batch.num_rows)
                yield batch
        return df.mapInArrow(look, df.schema)
    monkeypatch.setattr(files, "read_csv", watched)
    done = pipelines.ingest_students(spark, csv, scratch_path(spark, "t-once-clean"))
    audit = {(r["item"], r["column_name"]): r["rows"] for r in done.audit.collect()}
    done.table.count()
    assert lines.value == audit["input rows", None] > 0


@pytest.mark.parametrize("keep", ["1 = 0", "student_id IS NULL", "student_id = '5'"])
def test_ingest_of_no_or_only_refused_rows(spark, keep):
    raw = fixtures.outcomes_raw(spark, SF_SMALL).where(keep)
    csv = pipelines.write_raw_csv(raw, scratch_path(spark, "t-few"))
    done = pipelines.ingest_students(spark, csv, scratch_path(spark, "t-few-clean"))
    audit = {r["item"]: r["rows"] for r in done.audit.where("column_name IS NULL").collect()}
    assert audit["input rows"] == raw.count() == done.rejects.count() + audit["duplicate rows"] + done.table.count()


def test_report_rows_are_pruned_and_nothing_is_written(spark, monkeypatch):
    from scrubjay.plans import catalog
    monkeypatch.setattr(pipelines, "cut_lineage", lambda *a: pytest.fail("a report wrote a table"))
    df = catalog.q_outcomes_by_use_case(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [s.split(">")[0] for s in plan.split("ReadSchema: struct<")[1:]]
    assert len(schemas) == 1 and "l_linestatus" not in schemas[0] and "l_returnflag" not in schemas[0]


def test_table_overwrite_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS t_overwritten")
    files.save_table(spark.range(3), table="t_overwritten")
    new = files.save_table(spark.range(2).selectExpr("id", "id * 2 AS twice"), table="t_overwritten")
    assert new.columns == ["id", "twice"] and new.count() == 2
    spark.sql("DROP TABLE t_overwritten")


def test_fixture_shapes(spark):
    s = fixtures.shipments(spark, SF_SMALL)
    assert s.count() == load(spark, SF_SMALL, "lineitem").count()
    assert dict(s.dtypes)["arr_delay"] == "int"
    assert fixtures.gems(spark, SF_SMALL).where(F.col("price").isNull()).count() > 0


def test_cut_lineage_observed_metrics(spark):
    from scrubjay.session import cut_lineage_observed
    df = spark.range(100).select(F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id")).alias("x"))
    out, m = cut_lineage_observed(df, {"rows": F.count(F.lit(1)), "nulls": F.count_if(F.col("x").isNull())}, "t-obs")
    assert m == {"rows": 100, "nulls": 25}
    assert out.count() == 100


def test_ingest_observes_columns_only(spark, monkeypatch):
    """Casts and types are computed before they are observed; the texts of a refused row are one column."""
    csv = pipelines.write_raw_csv(fixtures.outcomes_raw(spark, SF_SMALL), scratch_path(spark, "t-observed"))
    routed, cut = [], pipelines.cut_lineage
    monkeypatch.setattr(pipelines, "cut_lineage", lambda df, *a, **kw: (routed.append(df), cut(df, *a, **kw))[1])
    monkeypatch.setattr(files, "save_table", lambda df, path: (routed.append(df), df)[1] if path.endswith("rejects")
                        else pytest.fail("far enough"))
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        with pytest.raises(pytest.fail.Exception, match="far enough"):
            pipelines.ingest_students(spark, csv, scratch_path(spark, "t-observed-clean"), infer=True)
        plan = routed[0]._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    observed, = [line.lower() for line in plan.splitlines() if "CollectMetrics" in line]
    assert observed.count("bit_and") == 18 and "rlike" not in observed and "cast(" not in observed
    assert len(routed[0].columns) == 21


def test_order_keys_only_of_numbers_with_gaps_and_of_the_hours(spark, monkeypatch):
    rows = fixtures.outcomes(spark, SF_SMALL)
    asked, table = [], pipelines.key_table
    monkeypatch.setattr(pipelines, "key_table", lambda df, cols: (asked.append(list(cols)), table(df, cols))[1])
    hours = "weekly_genai_hours"
    whole = pipelines.clean_students(rows)
    gap = F.when(F.col("student_id") % 3 != 0, F.col("post_semester_gpa")).alias("post_semester_gpa")
    some = pipelines.clean_students(rows.select(*[gap if c == "post_semester_gpa" else c for c in rows.columns]))
    median = whole.where("student_id % 3 <> 0").agg(F.percentile("post_semester_gpa", F.lit(0.5))).first()[0]
    filled = some.where("student_id % 3 = 0").select("post_semester_gpa").distinct().collect()
    assert asked == [[hours], [hours, "post_semester_gpa"]]
    assert [r[0] for r in filled] == [pytest.approx(median)]
    assert some.agg(F.sum("genai_hours_outlier_flag")).first() == whole.agg(F.sum("genai_hours_outlier_flag")).first()


@pytest.mark.parametrize("query", ["fill_median_approx", "mean_vs_median"])
def test_delays_are_joined_once(spark, monkeypatch, query):
    from scrubjay.plans import catalog
    made, rows = fixtures.shipments, spark.sparkContext.accumulator(0)

    def watched(session, d):
        df = made(session, d)

        def look(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch
        return df.mapInArrow(look, df.schema)
    monkeypatch.setattr(fixtures, "shipments", watched)
    out = catalog.QUERIES[query](spark, SF_SMALL).collect()
    assert all(r.within_bound for r in out) and rows.value == made(spark, SF_SMALL).count() > 0
