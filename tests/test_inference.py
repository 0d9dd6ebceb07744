import pytest
from pyspark.sql import functions as F

from scrubjay.functions import inference
from scrubjay.functions.inference import infer_types, narrowest, shared_bits
from scrubjay.sources import files


@pytest.mark.parametrize("values, kind", [
    (["1", "-7", " 12 ", None, ""], "int"),
    (["1", "2147483648"], "bigint"),
    (["1", "9223372036854775808"], "string"),
    (["1", "2.5"], "double"),
    ([".5", "1e3", "0", "-0.25", "3."], "double"),
    (["1e400", "1"], "string"),
    (["007", "12"], "string"),
    (["00.5"], "string"),
    (["NaN", "1"], "string"),
    (["true", "FALSE"], "boolean"),
    (["true", "1"], "string"),
    (["1", "0"], "int"),
    (["2024-02-29", "1999-12-31"], "date"),
    (["2024-02-30"], "string"),
    (["2024-02-29", "2024-02-29 10:15"], "timestamp"),
    (["2024-02-29T10:15:00.5Z"], "timestamp"),
    (["2024-02-29 25:00"], "string"),
    (["2024-02-29", "5"], "string"),
    ([None, "  "], "string"),
    ([], "string"),
])
def test_narrowest_type(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert infer_types(df) == {"a.b": kind}


def test_states_merge(spark):
    """The bits of parts, merged, are those of the whole."""
    rows = [("1",)] * 50 + [("2.5",)] * 50 + [(None,)]
    df = spark.createDataFrame(rows, "x string").repartition(7)
    parts = df.groupBy(F.spark_partition_id()).agg(shared_bits("x").alias("bits"))
    assert narrowest(parts.agg(F.bit_and("bits")).first()[0]) == infer_types(df)["x"] == "double"


def test_csv_read_with_inference(spark, tmp_path):
    df = spark.createDataFrame([(1, "007", 2.5, True, None), (None, "x", None, None, None)],
                               "n int, code string, d double, b boolean, none string")
    path = files.write_csv(df, str(tmp_path / "t"))
    back = files.read_csv(spark, path, infer=True)
    assert dict(back.dtypes) == dict(df.dtypes)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_other_types_are_kept(spark):
    df = spark.range(3).withColumn("t", F.col("id").cast("string"))
    assert infer_types(df) == {"id": "bigint", "t": "int"}


def test_types_of_several_columns_as_one_array(spark):
    """The array holds the bits of each value's every type, as each form taken alone would give them."""
    texts = ["1", "+1", "-0", "007", "2147483648", "9223372036854775808", "2.5", ".5", "3.", "1e3", "1e400", "-1e400", ".",
             "NaN", "-Infinity", "true", "FALSE", "truth", "2024-02-29", "2024-02-30", "2024-02-29 10:15", "2024-02-29 25:00",
             "2024-02-29T10:15:00.5Z", " 12 ", "1\n", "true\n", "2024-02-29\n", ":", "/", "é", "  ", "", None]
    df = spark.createDataFrame([(t, u) for t, u in zip(texts, reversed(texts))], "a string, b string")
    bits = {"boolean": 1, "int": 2, "bigint": 4, "double": 8, "date": 16, "timestamp": 32}
    text = F.trim("a")
    whole, fits = text.rlike(inference.WHOLE), text.try_cast("bigint").isNotNull()
    holds = {"boolean": text.rlike(inference.TRUTH), "int": whole & text.try_cast("int").isNotNull(), "bigint": whole & fits,
             "double": text.rlike(inference.NUMBER) & (~whole | fits) & (F.abs(text.try_cast("double")) < float("inf")),
             "date": text.rlike(inference.DAY) & text.try_cast("date").isNotNull(),
             "timestamp": text.rlike(inference.MOMENT) & text.try_cast("timestamp").isNotNull()}
    alone = F.when(text != "", sum((F.when(holds[t], n).otherwise(0) for t, n in bits.items()), F.lit(0)))
    rows = df.select("a", "b", alone.alias("alone"), inference.type_bits_array(["a", "b"]).alias("both"),
                     inference.type_bits("b").alias("one")).collect()
    assert [(r.a, r.both[0]) for r in rows] == [(r.a, r.alone) for r in rows]
    assert [(r.b, r.both[1]) for r in rows] == [(r.b, r.one) for r in rows]
