"""Ordinals without a whole-group window, RUL cycles and alignment."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from condmon.operators.ordinal import ordinal_within
from condmon.operators.supervised import rul_cycles, rul_supervised


def test_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5003).alias("o")
    ).repartition(7)
    got = ordinal_within(df, ["g"], ["o"], name="n", total_name="total", num_partitions=6)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    a = sorted(tuple(r) for r in got.select("g", "o", "n").collect())
    b = sorted(tuple(r) for r in ref.select("g", "o", "n").collect())
    assert a == b
    totals = {r["g"]: r["total"] for r in got.select("g", "total").distinct().collect()}
    assert totals == {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}


def test_cycles_and_fallback(spark):
    rows = [("s1", "2004.01.02.00.00.00"), ("s1", "2004.01.01.00.00.00"), ("s1", "2004.01.03.00.00.00"),
            ("s2", "03.01.2004"), ("s2", "01.02.2004"), ("s2", "2004.01.01.00.00.00")]
    df = spark.createDataFrame(rows, "test_set string, file string")
    out = {(r["test_set"], r["file"]): (r["cycle"], r["rul"]) for r in rul_cycles(df).collect()}
    assert out[("s1", "2004.01.01.00.00.00")] == (1, 3)
    assert out[("s1", "2004.01.03.00.00.00")] == (3, 1)
    # one unparsable name: the whole set sorts by name
    assert out[("s2", "01.02.2004")] == (1, 3)
    assert out[("s2", "2004.01.01.00.00.00")] == (3, 1)


def test_aligned_union(spark):
    rows = [("1st_test", "f1", 1.0, 2.0, 3.0, 9.0, 9.0, None, 2), ("2nd_test", "f2", 9.0, 9.0, 9.0, 4.0, 5.0, 6.0, 1)]
    df = spark.createDataFrame(
        rows, "test_set string, file string, b3_max double, b3_p2p double, b3_rms double, "
              "b4_max double, b4_p2p double, b4_rms double, rul long")
    out = rul_supervised(df)
    assert out.columns == ["test_set", "file", "b3_max", "b3_p2p", "b3_rms", "b4_max", "b4_p2p", "b4_rms", "rul"]
    got = {r["test_set"]: r for r in out.collect()}
    assert (got["1st_test"]["b3_rms"], got["1st_test"]["b4_max"]) == (3.0, 0.0)
    assert (got["2nd_test"]["b3_max"], got["2nd_test"]["b4_rms"]) == (0.0, 6.0)
    # only the first set present -> only its columns
    only = rul_supervised(df.where(F.col("test_set") == "1st_test"))
    assert only.columns == ["test_set", "file", "b3_max", "b3_p2p", "b3_rms", "rul"]


def test_hot_group_spreads_over_partitions(spark):
    """A group holding most rows is cut into several range partitions, so
    no single task numbers it whole."""
    hot = spark.range(0, 6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 5 + 1).alias("g"),
                                      F.col("id").alias("o"))
    tagged = hot.repartitionByRange(8, "g", "o").withColumn("_pid", F.spark_partition_id())
    spread = tagged.where(F.col("g") == 0).select("_pid").distinct().count()
    assert spread >= 4
    got = ordinal_within(hot, ["g"], ["o"], name="n", num_partitions=8)
    hot0 = got.where(F.col("g") == 0).agg(F.min("n"), F.max("n"), F.count_distinct("n")).collect()[0]
    assert tuple(hot0) == (1, 4000, 4000)


def test_null_groups_are_kept(spark):
    from condmon.operators.ordinal import first_k_per_group, ordinal_within
    from condmon.operators.supervised import rul_cycles

    df = spark.createDataFrame([(None if i % 2 else "g", i) for i in range(100)], "g string, i int")
    out = ordinal_within(df, ["g"], ["i"], total_name="n")
    assert out.count() == 100 and {r["n"] for r in out.collect()} == {50}
    assert sorted(r["i"] for r in first_k_per_group(df, ["g"], ["i"], 3).collect()) == [0, 1, 2, 3, 4, 5]
    sets = df.selectExpr("g AS test_set", "CAST(i AS STRING) AS file", "1.0 AS b3_max")
    assert rul_cycles(sets).count() == 100
