"""Tables derived by another statement than the checks use."""

import random

from videonet.sources import views


def test_offer_edges_are_those_of_the_join_by_one_shuffle(spark, tmp_path):
    """Orders longer than a run of lines, lines that come twice, numbers below zero and nulls."""
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 2, None]), rng.choice([None, *range(-140, 200)]), rng.choice([None, 1, 2, 3]), rng.choice([None, 5, 6]))
        for _ in range(2000)
    ]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    lines = lines.selectExpr("*", "timestamp '1995-01-01' + make_interval(pmod(l_partkey, 3)) AS l_shipdate")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    # Else tables this small are sent to all tasks.
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    lines.createOrReplaceTempView("lineitem")
    try:
        got, expected = views.view(spark, str(tmp_path), "offer_edges"), spark.sql(views.OFFER_EDGES_SQL)
        assert got.schema == expected.schema
        assert got.count() == expected.count() > 1000
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set(name, before)
        spark.catalog.dropTempView("lineitem")
