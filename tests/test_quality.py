from pyspark.sql import functions as F

from scrubjay.operators import quality as q


def _report(df, rules):
    return {r.check_name: (r.result, r.detail) for r in q.validate(df, rules).collect()}


def test_null_audit_wide_and_long(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1), (4, 2)], "a int, b int")
    w = q.null_audit(df, ["a", "b"]).first()
    assert (w.total_rows, w.missing_a, w.missing_b, w.pct_a, w.pct_b) == (4, 1, 2, 25.0, 50.0)
    long = {r.column_name: (r.missing, r.pct_missing) for r in q.null_audit_long(df).collect()}
    assert long == {"a": (1, 25.0), "b": (2, 50.0)}
    assert q.null_counts(df).first().asDict() == {"a": 1, "b": 2}


def test_null_audit_empty_table_gives_null_percent(spark):
    df = spark.createDataFrame([], "a int")
    w = q.null_audit(df, ["a"]).first()
    assert (w.total_rows, w.missing_a, w.pct_a) == (0, 0, None)


def test_validation_on_empty_table(spark):
    df = spark.createDataFrame([], "c string")
    rep = _report(df, [q.no_nulls("no null", "c"), q.missing_below("missing < 5%", "c", 5.0),
                       q.row_count("rows > 0", 0)])
    assert rep["no null"] == ("PASS", "0")
    assert rep["missing < 5%"][0] == "FAIL"
    assert rep["rows > 0"] == ("FAIL", "0")


def test_unique_key_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (1,), (2,)], "k int")
    rep = _report(df, [q.unique_key("groups", ["k"], "groups"), q.unique_key("rows", ["k"], "rows")])
    assert rep["groups"] == ("FAIL", "2")
    assert rep["rows"] == ("FAIL", "2")
    ok = _report(spark.createDataFrame([(1,), (None,)], "k int"), [q.unique_key("u", ["k"], "rows")])
    assert ok["u"] == ("PASS", "0")


def test_domain_null_is_not_judged(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "c string")
    rep = _report(df, [q.allowed_values("dom", "c", ["a", "b"])])
    assert rep["dom"] == ("FAIL", "1 invalid rows")
    assert [(r.c, r.invalid_rows) for r in q.invalid_values(df, "c", ["a", "b"]).collect()] == [("z", 1)]


def test_range_exists_ordered_and_formats(spark):
    df = spark.createDataFrame([(1.0, 5.0, -1.0, 2.0), (5.0, 1.0, -1.0, 2.0)], "g double, h double, lo double, hi double")
    rules = [q.within("gpa", ["g", "h"], 0, 4, "%,d bad"),
             q.non_negative("nonneg", "g"),
             q.column_exists("has g", "g", F.count("g"), "%d values"),
             q.column_exists("has z", "z", F.count_if(F.col("z") > 0), "%d above 0"),
             q.ordered("bounds", "lo", "hi"),
             q.row_count("at least 1,000", 1000, strict=False, detail="%,d rows")]
    rep = _report(df, rules)
    assert rep["gpa"] == ("FAIL", "2 bad")
    assert rep["nonneg"] == ("PASS", "0 invalid rows")
    assert rep["has g"] == ("PASS", "2 values")
    assert rep["has z"] == ("FAIL", "0 above 0")  # a missing column fails the check, not the report
    assert rep["bounds"] == ("PASS", "lower=-1.00, upper=2.00")
    assert rep["at least 1,000"] == ("FAIL", "2 rows")


def test_validation_is_one_aggregate_scan(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    rules = [q.no_nulls("a", "v"), q.positive("b", "v"), q.row_count("c", 10), q.unique_key("d", ["k"])]
    plan = q.validate(df, rules)._jdf.queryExecution().executedPlan().toString()
    # main aggregate + one grouped pass for the unique-key rule, nothing per rule
    assert plan.count("Range (") <= 2


def test_distinct_values_sorted_without_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    assert [r.c for r in q.distinct_values(df, "c").collect()] == ["a", "b"]


def test_fill_recommendation_follows_decision_table(spark):
    rows = [(1, None, "a", None), (2, 5.0, None, None), (3, 6.0, "b", None), (4, 7.0, "c", 1.0)]
    df = spark.createDataFrame(rows, "id int, x double, s string, mostly_null double")
    got = {r.column_name: (r.data_type, r.missing, r.strategy) for r in q.fill_recommendation(df).collect()}
    assert got == {"id": ("int", 0, q.STRATEGY_NONE), "x": ("double", 1, q.STRATEGY_NUMERIC),
                   "s": ("string", 1, q.STRATEGY_CATEGORY), "mostly_null": ("double", 3, q.STRATEGY_LEAVE)}


def test_table_shape(spark):
    r = q.table_shape(spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string")).first()
    assert (r.row_count, r.column_count) == (2, 2)


def test_three_key_rules_share_one_scan_and_one_shuffle_of_the_rows(spark, tmp_path):
    rows = [(1, "a", 1), (1, "a", 2), (2, None, 3), (2, None, 3), (None, None, 4), (3, "", 5), (3, None, 5)]
    spark.createDataFrame(rows, "x int, y string, z int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [q.unique_key("x", ["x"], "rows"), q.unique_key("xy", ["x", "y"], "groups"),
             q.unique_key("xyz", ["x", "y", "z"], "rows"), q.unique_key("z", ["z"], "groups")]
    rep = q.validate(df, rules)
    assert {r.check_name: r.detail for r in rep.collect()} == {"x": "3", "xy": "2", "xyz": "1", "z": "2"}
    alone = {r.check_name: r.detail for rule in rules for r in q.validate(df, [rule]).collect()}
    assert alone == {"x": "3", "xy": "2", "xyz": "1", "z": "2"}
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    empty = q.validate(df.where("x = 99"), rules).collect()
    assert all((r.result, r.detail) == ("PASS", "0") for r in empty)
