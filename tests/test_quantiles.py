import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from scrubjay.functions import quantiles
from scrubjay.functions.quantiles import exact_quantiles, rank_errors
from scrubjay.sources.tables import load

from .conftest import SF_CHECK

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _spark_percentile(df, c):
    return list(df.agg(F.percentile(c, F.array(*[F.lit(p) for p in PS]))).first()[0])


def test_values_match_spark_percentile_on_real_data(spark):
    li = load(spark, SF_CHECK, "lineitem")
    got = exact_quantiles(li, {"l_extendedprice": PS, "l_quantity": PS})
    assert got["l_extendedprice"] == _spark_percentile(li, "l_extendedprice")
    assert got["l_quantity"] == _spark_percentile(li, "l_quantity")


def test_nulls_ignored_and_empty(spark):
    df = spark.createDataFrame([(None,), (1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, {}) == {}
    assert exact_quantiles(df, {"x": [0.5]})["x"] == [2.0]
    assert exact_quantiles(df.where("x > 10"), {"x": [0.5]})["x"] == [None]


CASES = {
    "no nulls": "CAST(id AS DOUBLE)",
    "3% nulls": "IF(id % 33 = 0, NULL, CAST(id AS DOUBLE))",
    "30% nulls": "IF(id % 10 < 3, NULL, CAST(id AS DOUBLE))",
    "hot value": "IF(id % 3 = 0, 7D, CAST(id AS DOUBLE))",
    "two hot neighbours": "CASE WHEN id % 5 < 2 THEN 11D WHEN id % 5 < 4 THEN 12D ELSE CAST(id AS DOUBLE) END",
    "ties": "CAST(FLOOR(id / 400) AS DOUBLE)",
    "one value": "3D",
    "wide gaps": "CASE WHEN id % 2 = 0 THEN id * 1e-300 WHEN id % 3 = 0 THEN id * 1e300 ELSE -id * 1.5 END",
    "close values": "1D + id * 2.220446049250313e-16",
    "negative": "-CAST(id AS DOUBLE) / 7",
    "infinities and NaN": "CASE id % 7 WHEN 0 THEN DOUBLE('-Infinity') WHEN 1 THEN DOUBLE('Infinity') WHEN 2 THEN "
                          "DOUBLE('NaN') ELSE id / 3D END",
}


@pytest.mark.parametrize("case", CASES)
def test_four_passes_settle_any_column(spark, monkeypatch, case):
    df = spark.range(20_000).selectExpr(f"{CASES[case]} AS x")
    passes, count = [], quantiles.digit_counts

    def counting(keys, intervals, depth):
        out = count(keys, intervals, depth)
        passes.append(max(len(x) for x in out))
        return out
    monkeypatch.setattr(quantiles, "digit_counts", counting)
    got = exact_quantiles(df, {"x": PS})["x"]
    assert [str(v) for v in got] == [str(v + 0.0) for v in _spark_percentile(df, "x")]
    assert len(passes) <= quantiles.PASSES and max(passes) <= 1 << quantiles.DIGIT


def test_keys_sort_as_doubles(spark):
    edges = [v for e in (*range(-1074, -1018), *range(-60, 70), *range(1000, 1024)) for p in (2.0 ** e,)
             for v in (math.nextafter(p, 0), p, math.nextafter(p, math.inf)) if v > 0]
    rng = random.Random(3)
    edges += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    values = sorted({abs(v) for v in edges if math.isfinite(v)})
    values = [-math.inf, *[-v for v in reversed(values)], -0.0, 0.0, *values, math.inf, math.nan, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").coalesce(1)
    keys = [r.k0 for r in quantiles.order_keys(df.sort("i"), ["x"]).collect()]
    assert keys[-1] is None and keys[:-1] == sorted(keys[:-1]) and len(set(keys)) == len({v for v in values if v == v}) + 1
    assert all(str(quantiles.key_value(k)) == str(v + 0.0) for k, v in zip(keys[:-1], values))


def test_the_input_is_built_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(5000).selectExpr("CAST(id * id AS DOUBLE) AS x").mapInArrow(look, "x double")
    assert exact_quantiles(df, {"x": [0.5]})["x"] == _spark_percentile_of(spark, 5000)
    assert seen.value == 5000


def _spark_percentile_of(spark, n):
    return [spark.range(n).selectExpr("percentile(CAST(id * id AS DOUBLE), 0.5) AS p").first().p]


def test_rank_errors(spark):
    df = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))  # 1..99 and a null
    got = {r.p: r.rank_error for r in rank_errors(df, {"x": {0.5: 50, 0.25: 40, 1.0: 99}}).collect()}
    assert got[0.5] == 0 and got[1.0] == 0 and abs(got[0.25] - (39 - 24.75) / 99) < 1e-12
