import csv
import os

from pyspark.sql import functions as F

from scrubjay.operators import analysis
from scrubjay.sources import files


def table(spark, n=5000):
    return spark.range(0, n, 1, 8).select(
        F.col("id"), (F.hash("id") % 1000).alias("score"),
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, 'a "b", c').otherwise("x").alias("t x"))


def test_one_ordered_file(spark, tmp_path):
    df = table(spark)
    path = files.write_csv(df, str(tmp_path / "out.csv"), single_file=True, order=[F.col("score").desc(), "id"])
    assert os.path.isfile(path)
    assert os.listdir(tmp_path) and not [n for n in os.listdir(tmp_path) if "parts-" in n or "whole-" in n]
    with open(path, newline="") as f:
        rows = list(csv.reader(f))
    want = [(str(r["id"]), str(r["score"]), r["t x"] or "") for r in df.orderBy(F.col("score").desc(), "id").collect()]
    assert rows[0] == df.columns
    assert [tuple(r) for r in rows[1:]] == want
    back = files.read_csv(spark, path, schema=df.schema, multi_line=False)
    assert sorted(back.collect()) == sorted(df.collect())


def test_one_file_replaces_and_keeps_width(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    files.write_csv(table(spark, 10), path, single_file=True)
    df = table(spark, 4000).withColumn("task", F.spark_partition_id())
    files.write_csv(df, path, single_file=True)
    back = files.read_csv(spark, path, schema=df.schema, multi_line=False)
    assert back.select("task").distinct().count() == 8  # the stage above the write was not narrowed
    assert back.count() == 4000


def test_one_file_without_rows_holds_the_header(spark, tmp_path):
    path = files.write_csv(table(spark).limit(0), str(tmp_path / "e.csv"), single_file=True, order=["id"])
    assert open(path).read() == "id,score,t x\n"


def test_ordered_parts(spark, tmp_path):
    path = files.write_csv(table(spark), str(tmp_path / "parts"), order=["id"])
    ids = []
    for name in sorted(n for n in os.listdir(path) if n.startswith("part-")):
        with open(os.path.join(path, name), newline="") as f:
            ids += [int(r[0]) for r in list(csv.reader(f))[1:]]
    assert ids == list(range(5000))


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,), (11.0,)], "x double")
    got = analysis.histogram(df, "x", 0, 10, 5, keep_empty=True).orderBy("bin").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 2.0, 1), (1, 2.0, 4.0, 0), (2, 4.0, 6.0, 0), (3, 6.0, 8.0, 0), (4, 8.0, 10.0, 1)]
    assert [r["rows"] for r in analysis.histogram(df.limit(0), "x", 0, 10, 5, keep_empty=True).collect()] == [0] * 5
