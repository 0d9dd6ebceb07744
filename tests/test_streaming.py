from pyspark.sql import functions as F

from scrubjay.functions import text
from scrubjay.functions.predicates import gem_filter
from scrubjay.operators.features import band, flag
from scrubjay.session import scratch_path
from scrubjay.sources import fixtures

from .conftest import SF_SMALL


def _clean(df):
    return df.where(gem_filter()).select(
        "gem_id", text.category_token("clarity").alias("clarity"),
        band("carat", [1, 2, 3], ["small", "medium", "large", "huge"]).alias("size_band"),
        flag(F.col("price") > 1500).alias("pricey"))


def test_row_wise_operators_run_unchanged_on_a_stream(spark):
    gems = fixtures.gems(spark, SF_SMALL)
    src = scratch_path(spark, "t-stream-src")
    gems.write.parquet(src)
    stream = spark.readStream.schema(gems.schema).parquet(src)
    q = (_clean(stream).writeStream.format("memory").queryName("clean_gems_stream")
         .option("checkpointLocation", scratch_path(spark, "t-stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("clean_gems_stream")
    want = _clean(gems)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
