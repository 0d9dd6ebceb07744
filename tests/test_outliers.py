from scrubjay.operators import outliers as o


def test_iqr_report_and_flag(spark):
    vals = [(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,)]
    df = spark.createDataFrame(vals, "x double")
    r = o.iqr_report(df, "x").first()
    assert (r.total, r.low_outliers, r.high_outliers, r.lower_bound, r.upper_bound) == (10, 0, 1, -3.0, 13.0)
    flagged = o.iqr_flag(df, "x", bounds_prefix="").collect()
    assert sum(1 for f in flagged if f.x_outlier) == 1
    assert all(f.x_outlier is False for f in flagged if f.x is None)  # null is not an outlier
    assert {f.lower_bound for f in flagged} == {-3.0}


def test_iqr_flag_as_int_and_approx(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(1000.0,)], "x double")
    out = o.iqr_flag(df, "x", flag="f", as_int=True, method="approx").collect()
    assert sum(r.f for r in out) == 1


def test_quantiles_exact_and_all_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = o.quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 3.25)
    nul = spark.createDataFrame([(None,)], "x double")
    assert o.quantiles(nul, "x", [0.5]).first().q50 is None


def test_zscore_threshold_on_raw_value_and_zero_variance(spark):
    df = spark.createDataFrame([(float(v),) for v in [0] * 20 + [10]], "x double")
    out = o.zscore(df, "x", 3.0).collect()
    assert len(out) == 1 and out[0].x == 10.0 and out[0].z_score > 3
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    z = o.zscore(const, "x", None).collect()
    assert [r.z_score for r in z] == [None, None]  # no DIVIDE_BY_ZERO under ANSI
