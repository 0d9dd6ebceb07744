import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scrubjay.functions import comoments
from scrubjay.operators import analysis as a
from scrubjay.operators.features import AI_USAGE_EDGES, AI_USAGE_LABELS, band, flag, order_key


def test_correlation_matches_pandas_pairwise_and_constant_is_null(spark):
    rows = [(1.0, 2.0, 5.0, 1.0), (2.0, 1.0, 5.0, None), (3.0, 4.0, 5.0, 2.0), (4.0, 3.0, 5.0, 5.0), (None, 9.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.col_x, r.col_y): r.corr for r in a.correlation_matrix(df, ["a", "b", "c", "d"], 6).collect()}
    assert len(got) == 16
    want = pd.DataFrame(rows, columns=list("abcd")).corr()
    for x in "abd":
        for y in "abd":
            assert math.isclose(got[(x, y)], round(want.loc[x, y], 6), abs_tol=1e-6)
    assert got[("a", "c")] is None and got[("c", "c")] is None  # zero variance: null, no error


def test_comoments_merge_in_any_order_and_split():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) * [1, 1e-3, 50, 1] + [1e9, 0, -7, 3]
    x[:, 3] = x[:, 0] * 2 - 5
    known = rng.random(x.shape) > [0, .1, .5, .02]
    whole = comoments.CoMoments(4).fill(x, known)
    parts = [comoments.CoMoments(4).fill(x[a:b], known[a:b]) for a, b in ((0, 1), (1, 7), (7, 400), (400, 400), (400, 500))
             if b > a]
    for order in (range(4), (3, 1, 0, 2)):
        got = comoments.CoMoments(4)
        for i in order:
            got = got.merge(comoments.CoMoments.unpack(parts[i].pack(), 4))
        assert np.allclose(got.correlations(), whole.correlations(), atol=1e-9)
    want = pd.DataFrame(np.where(known, x, np.nan)).corr().to_numpy()
    assert np.allclose(whole.correlations(), want, atol=1e-6)


def test_correlation_repeats_no_row_and_keeps_spark_semantics(spark, monkeypatch):
    df = spark.range(3000).selectExpr("CAST(id AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, SQRT(id)) AS b", "id % 7 AS c",
                                      "IF(id = 5, DOUBLE('NaN'), id) AS n", "CAST(NULL AS DOUBLE) AS z").repartition(9)
    plans = []
    monkeypatch.setattr(comoments, "ship_package", lambda s: plans.append(s))
    got = {(r.col_x, r.col_y): r.corr for r in a.correlation_matrix(df, ["a", "b", "c", "n", "z"], 6).collect()}
    want = df.agg(*[F.corr(x, y).alias(f"{x}{y}") for x in "abcn" for y in "abcn"]).first()
    for x in "abc":
        for y in "abc":
            assert math.isclose(got[x, y], want[f"{x}{y}"], abs_tol=2e-6)
        assert math.isnan(got[x, "n"]) and math.isnan(want[f"{x}n"]) and got[x, "z"] is None
    states = df.select("a", "b").mapInArrow(comoments._fill(2), "state binary")
    assert "Generate" not in states._jdf.queryExecution().executedPlan().toString()
    assert a.correlation_matrix(df.limit(0), ["a", "b"]).where("corr IS NOT NULL").count() == 0


def test_describe_keeps_types_and_strings(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(1, 2.0, "b", big), (3, None, "a", big)], "i int, d double, s string, id bigint")
    got = {(r.column_name, r.stat): (r.value, r.number) for r in a.describe(df).collect()}
    assert got[("i", "count")] == ("2", 2.0) and got[("i", "mean")] == (None, 2.0) and got[("d", "count")] == ("1", 1.0)
    assert got[("d", "stddev")] == (None, None) and got[("i", "max")] == ("3", 3.0)
    assert got[("id", "min")][0] == str(big)  # a double would lose the last digit
    assert got[("s", "min")] == ("a", None) and got[("s", "max")] == ("b", None) and ("s", "mean") not in got


def test_share_reads_its_input_once(spark):
    from scrubjay.sources.tables import load
    df = a.share(load(spark, "/root/testdata/sf0.001", "lineitem"), "l_returnflag")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and "ReusedExchange" in final or final.count("FileScan parquet") == 1


def test_histogram_top_edge_in_last_bin_and_range(spark):
    df = spark.createDataFrame([(-60.0,), (0.0,), (239.9,), (240.0,), (241.0,), (-61.0,)], "x double")
    got = {r.bin: r.rows for r in a.histogram(df, "x", -60, 240, 60).collect()}
    assert got == {0: 1, 12: 1, 59: 2}


def test_share_sums_to_100(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    got = {r.k: (r.rows, r.share_pct) for r in a.share(df, "k").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0), "c": (1, 25.0)}


def test_top_k_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("m", "x", 3), ("m", "y", 3), ("m", "z", 1), ("n", "x", 2)], "g string, b string, v int")
    out = a.top_k_per_group(df, ["g"], [F.col("v").desc()], 1, "r").collect()
    assert sorted((r.g, r.b, r.r) for r in out) == [("m", "x", 1), ("m", "y", 1), ("n", "x", 1)]


def test_top_n_tie_break(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4)], "id int, v int")
    assert [r.id for r in a.top_n(df, 2, [F.col("v").desc(), "id"]).collect()] == [1, 2]


def test_pivot_fixed_values(spark):
    df = spark.createDataFrame([("A", "p", 1.0), ("A", "q", 3.0), ("B", "p", 2.0)], "r string, c string, v double")
    out = {r.r: (r.p, r.q, r.z) for r in a.pivot(df, ["r"], "c", ["p", "q", "z"], F.avg("v")).collect()}
    assert out == {"A": (1.0, 3.0, None), "B": (2.0, None, None)}


def test_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s1 = [r.k for r in a.sample_repeatable(df, 10, ["k"], 42).collect()]
    s2 = [r.k for r in a.sample_repeatable(df.repartition(7), 10, ["k"], 42).collect()]
    assert s1 == s2 and len(set(s1)) == 10
    assert a.sample_random(df, 50, seed=1).count() == 50
    assert a.sample_random(df, 5000).count() == 1000
    picks = [frozenset(r.k for r in a.sample_random(df, 50).collect()) for _ in range(3)]
    assert len(set(picks)) > 1 and all(len(p) == 50 for p in picks)


def test_sample_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "b|c"), ("a|b", "c"), ("a", None), (None, "a")], "x string, y string")
    scores = [r.s for r in df.select(a._hash_score(["x", "y"], 1).alias("s")).collect()]
    assert len(set(scores)) == 4 and all(0 <= s < 1 for s in scores)


def test_threshold_sample_raises_a_threshold_that_finds_too_few(spark):
    df = spark.range(2000).withColumn("s", F.lit(0.999))
    out = a._threshold_sample(df, 10, F.col("s"), [F.col("id")])
    assert [r.id for r in out.collect()] == list(range(10))


def test_equal_rows_have_an_equal_chance_each(spark):
    """A third of 10,000 rows are equal: 300 rows hold about 100 of them, for every seed and layout."""
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    drawn = [a.sample_random(df.repartition(parts), 300, seed) for seed, parts in enumerate((1, 3, 8, 5, 2, 7))]
    copies = [s.where("v = -1").count() for s in drawn]
    assert all(s.count() == 300 for s in drawn)
    spread = (300 * (1 / 3) * (2 / 3)) ** 0.5
    assert all(abs(c - 100) < 5 * spread for c in copies) and abs(sum(copies) / 6 - 100) < 5 * spread / 6 ** 0.5
    one = spark.range(500).select(F.lit("same").alias("v"))
    assert a.sample_random(one, 40).count() == 40 and a.sample_random(one, 900).count() == 500
    assert a.sample_random(one.limit(0), 10).count() == 0


def test_places_are_drawn_alike(spark):
    """Over many draws every row comes up about as often as any other."""
    df = spark.range(0, 60, numPartitions=4)
    times = dict.fromkeys(range(60), 0)
    for seed in range(40):
        for r in a.sample_random(df, 15, seed).collect():
            times[r.id] += 1
    assert sum(times.values()) == 600 and max(times.values()) < 24 and min(times.values()) > 0


def test_a_sample_builds_its_input_once(spark, monkeypatch):
    built = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch
    df = spark.range(4000).mapInArrow(look, "id long")
    out = a.sample_random(df, 50)
    assert out.count() == 50 and out.collect() == out.collect() and built.value == 4000
    monkeypatch.setattr(a, "_guessed_rows", lambda _: 10 ** 15)  # a bad guess costs one more pass, not rows
    assert a.sample_random(df, 50).count() == 50 and built.value == 12_000


def test_facet_values_one_pass(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("a", "y")], "f string, g string")
    got = [(r.facet, r.value) for r in a.facet_values(df, ["f", "g"]).collect()]
    assert got == [("f", "a"), ("f", "b"), ("g", "x"), ("g", "y")]


def test_band_edges_null_and_order(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,), (2.5,), (20.0,), (20.5,)], "h double")
    out = df.select(band("h", AI_USAGE_EDGES, AI_USAGE_LABELS).alias("b"), flag(F.col("h") >= 20).alias("f"),
                    order_key(band("h", AI_USAGE_EDGES, AI_USAGE_LABELS), AI_USAGE_LABELS).alias("o")).collect()
    assert [r.b for r in out] == [None, "0-2 hours", "0-2 hours", "2-5 hours", "10-20 hours", "20+ hours"]
    assert [r.f for r in out] == [0, 0, 0, 0, 1, 1]
    assert [r.o for r in out] == [None, 1, 1, 2, 4, 5]
