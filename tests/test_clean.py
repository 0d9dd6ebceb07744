import pytest
from pyspark.sql import functions as F

from scrubjay.operators import clean


def test_dedup_keep_first_is_deterministic_and_total(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, 1, "q"), (None, 1, "n1"), (None, 0, "n0")],
        "k int, o int, v string")
    out = clean.dedup_keep_first(df, ["k"], ["o"]).orderBy(F.col("k").asc_nulls_last()).collect()
    assert [(r.k, r.o, r.v) for r in out] == [(1, 3, "z"), (2, 1, "q"), (None, 0, "n0")]
    # A tie on the given order is broken by the remaining columns, so the survivor is fixed.
    tie = clean.dedup_keep_first(df.where("k = 1 AND o = 5"), ["k"], ["o"]).collect()
    assert [r.v for r in tie] == ["a"]


def test_dedup_keep_first_plans_partial_limit_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = clean.dedup_keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_find_duplicates_and_summary_count_null_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    dups = clean.find_duplicates(df, ["k"], None).collect()
    assert sorted((r.k is None, r.num_records) for r in dups) == [(False, 2), (True, 2)]
    s = clean.duplicate_summary(df, ["k"]).first()
    assert (s.total_rows, s.unique_keys, s.duplicate_rows, s.duplicate_keys) == (5, 3, 2, 2)


def test_duplicate_summary_empty(spark):
    df = spark.createDataFrame([], "k int")
    s = clean.duplicate_summary(df, ["k"]).first()
    assert s.unique_keys == 0 and s.duplicate_keys == 0


def test_fill_mean_sql_vs_fillna_types(spark):
    df = spark.createDataFrame([(1,), (2,), (6,), (None,)], "x int")
    sql_like = clean.fill_mean(df, ["x"])
    assert dict(sql_like.dtypes)["x"] == "double"
    assert sorted(r.x for r in sql_like.collect()) == [1.0, 2.0, 3.0, 6.0]
    typed = clean.fill_mean(spark.createDataFrame([(1,), (2,), (None,)], "x int"), ["x"], keep_type=True)
    assert dict(typed.dtypes)["x"] == "int"
    assert sorted(r.x for r in typed.collect()) == [1, 1, 2]  # mean 1.5 cast to int, as fillna does


def test_fill_median_exact_and_suffix(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    out = clean.fill_median(df, ["x"], suffix="_filled").collect()
    assert sorted(r.x_filled for r in out) == [1.0, 2.0, 2.0, 10.0]
    assert sum(r.x is None for r in out) == 1


def test_fill_median_all_null_column_is_noop(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r.x for r in clean.fill_median(df, ["x"]).collect()] == [None, None]
    assert [r.x for r in clean.fill_median(df, ["x"], method="approx").collect()] == [None, None]


@pytest.mark.parametrize("method", ["exact", "approx"])
@pytest.mark.parametrize("rows", [[(1,), (4,)], [(1,), (4,), (None,)]])
def test_fill_median_type_follows_the_parameters_only(spark, method, rows):
    df = spark.createDataFrame(rows, "x int")
    assert dict(clean.fill_median(df, ["x"], method=method).dtypes)["x"] == "double"
    assert dict(clean.fill_median(df, ["x"], method=method, keep_type=True).dtypes)["x"] == "int"


def test_fill_mode_reads_its_input_once_for_all_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (None, "a"), (2, "a")], "x int, s string")
    got = sorted((r.x, r.s) for r in clean.fill_mode(df, ["x", "s"]).collect())
    assert got == [(1, "a"), (1, "a"), (1, "b"), (2, "a")]
    empty = spark.createDataFrame([(None, None)], "x int, s string")
    assert clean.fill_mode(empty, ["x", "s"]).first() == (None, None)


def test_fill_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([(2,), (2,), (1,), (1,), (None,)], "x int")
    assert sorted(r.x for r in clean.fill_mode(df, ["x"]).collect()) == [1, 1, 1, 2, 2]


def test_fill_constant_and_indicator(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert sorted(r.c for r in clean.fill_constant(df, {"c": "Unknown"}).collect()) == ["Unknown", "a"]
    ind = clean.missing_indicator(df, ["c"]).collect()
    assert sorted(r.c_missing for r in ind) == [0, 1]


def test_cast_columns_counts_failures(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x1", "3"), ("", None)], "a string, b string")
    plan = {"a": "int", "b": "double"}
    out = clean.cast_columns(df, plan).collect()
    assert [r.a for r in out] == [1, None, None]
    rep = {r.column_name: (r.non_null_values, r.failed_casts) for r in clean.cast_failures(df, plan).collect()}
    assert rep == {"a": (3, 2), "b": (2, 0)}


def test_cast_unsafe_raises_under_ansi(spark):
    df = spark.createDataFrame([("abc",)], "a string")
    with pytest.raises(Exception):
        clean.cast_columns(df, {"a": "int"}, safe=False).collect()


def test_mean_vs_median(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (100,), (None,)], "d int")
    r = clean.mean_vs_median(df, "d").first()
    assert r.mean_d == 26.5 and r.median_d == 2


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               (F.lit(n) - F.col("id")).alias("o"), F.col("id").alias("v"))
    kept = clean.dedup_keep_first(df.repartition(8), ["k"], ["o"])
    hot = kept.where("k = 0").collect()
    assert len(hot) == 1 and hot[0].v == max(i for i in range(n) if i % 3 == 0)  # smallest o = largest id
    assert kept.count() == 1 + (n - n // 3)
    s = clean.duplicate_summary(df, ["k"]).first()
    assert (s.total_rows, s.unique_keys, s.duplicate_keys) == (n, 1 + (n - n // 3), 1)


def test_whole_row_dedup_compares_values_not_digests(spark, monkeypatch):
    nan = float("nan")
    rows = [(None, "a", 1.0), (None, "a", 1.0), ("a", None, 1.0), ("a", None, nan), ("a", None, nan), ("x", "y", 0.0),
            ("x", "y", -0.0), ("only", "one", 2.0)] + [("hot", "row", 3.0)] * 50
    df = spark.createDataFrame(rows, "p string, q string, v double").repartition(5)
    want = sorted(map(str, df.distinct().collect()))
    assert sorted(map(str, clean.dedup_rows(df).collect())) == want and len(want) == 6
    monkeypatch.setattr(clean, "_digest", lambda cols: [F.lit(0).alias("__d1"), F.lit(0).alias("__d2")])  # all clash
    assert sorted(map(str, clean.dedup_rows(df).collect())) == want
    assert clean.dedup_rows(df.limit(0)).count() == 0


def test_rows_without_a_double_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    plan = clean.dedup_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    some = df.unionAll(df.where("id = 5"))
    out = clean.dedup_rows(some)
    out.collect()
    assert out.count() == 1000 and "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_any_survivor_is_a_whole_row_of_its_group(spark):
    df = spark.range(600).selectExpr("IF(id % 3 = 0, NULL, id % 50) AS k", "id AS a", "id * 2 AS b").repartition(4)
    got = clean.dedup_any(df, ["k"]).collect()
    assert len(got) == len({r.k for r in got}) == 51
    assert all(r.b == 2 * r.a and r.k == (None if r.a % 3 == 0 else r.a % 50) for r in got)
