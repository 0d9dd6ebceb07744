from scrubjay.operators.joins import join_dimension


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_optimiser_decides_on_broadcasting_by_bytes(spark):
    fact = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    dim = spark.range(10).selectExpr("id AS k", "concat('name', id) AS name")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert "BroadcastHashJoin" in _plan(join_dimension(fact, dim, "k"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = join_dimension(fact, dim, "k")
        assert "BroadcastHashJoin" not in _plan(big)  # no hint of ours overrides it
        assert big.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
