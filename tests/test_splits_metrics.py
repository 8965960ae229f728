"""Exact hash splits and evaluation metrics against brute force."""

import hashlib
import math

from pyspark.sql import functions as F

from condmon.operators.metrics import classification_report, regression_metrics
from condmon.operators.splits import hash_split


def _h(k, seed=42):
    return int(hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], 16)


def test_split_exact_and_brute_force(spark):
    df = spark.range(0, 3001).withColumnRenamed("id", "k").withColumn("g", (F.col("k") % 3).cast("int"))
    got = {r["k"]: r["split"] for r in hash_split(df, ["k"], 0.2, 42, strata=["g"]).collect()}
    for g in range(3):
        keys = [k for k in range(3001) if k % 3 == g]
        ranked = sorted(keys, key=lambda k: (_h(k), k))
        n_test = math.ceil(0.2 * len(keys))
        assert {k for k in keys if got[k] == "test"} == set(ranked[:n_test])


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").collect()[0]
    assert r["rmse"] == math.sqrt((1 + 0 + 9) / 3) and r["mae"] == 4 / 3


def test_classification_report(spark):
    y = [0, 0, 0, 1, 1, 1, 1, 2]
    p = [0, 1, 0, 1, 1, 0, 1, 1]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    rep = {r["label"]: r for r in classification_report(df, "y", "p").collect()}
    assert rep["0"]["precision"] == 2 / 3 and rep["0"]["recall"] == 2 / 3
    assert rep["1"]["precision"] == 3 / 5 and rep["1"]["recall"] == 3 / 4
    assert rep["2"]["precision"] == 0.0 and rep["2"]["f1_score"] == 0.0 and rep["2"]["support"] == 1
    assert rep["accuracy"]["f1_score"] == 5 / 8 and rep["accuracy"]["support"] == 8
    f1 = [2 * (2 / 3) * (2 / 3) / (4 / 3), 2 * 0.6 * 0.75 / 1.35, 0.0]
    assert abs(rep["macro avg"]["f1_score"] - sum(f1) / 3) < 1e-12
    assert abs(rep["weighted avg"]["f1_score"] - (3 * f1[0] + 4 * f1[1]) / 8) < 1e-12


def test_split_size_with_equal_rows(spark):
    """Exact sizes when rows are equal, keys are NULL or strata are NULL."""
    import math

    from condmon.operators.splits import hash_split

    for n in (1, 3, 10, 101):
        df = spark.createDataFrame([(7, "x")] * n, "k int, v string").repartition(4)
        assert hash_split(df, ["k"]).where("split = 'test'").count() == math.ceil(0.2 * n)
    rows = [(None if i % 2 else 1, "a" if i % 3 else None) for i in range(90)]
    out = hash_split(spark.createDataFrame(rows, "k int, s string").repartition(3), ["k"], strata=["s"])
    sizes = {(r["s"], r["split"]): r["count"] for r in out.groupBy("s", "split").count().collect()}
    assert sizes == {("a", "test"): 12, ("a", "train"): 48, (None, "test"): 6, (None, "train"): 24}
    assert out.columns == ["k", "s", "split"]


def test_split_of_an_empty_table(spark):
    from condmon.operators.splits import hash_split

    assert hash_split(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def _grouped(sizes, fraction, seed=42):
    """sizes: {(stratum, group): rows} -> test groups, by the stated rule."""
    out = set()
    for s in {s for s, _ in sizes}:
        mine = [(g, n) for (t, g), n in sizes.items() if t == s]
        k = math.ceil(fraction * sum(n for _, n in mine))
        before = 0
        for g, n in sorted(mine, key=lambda x: (x[1] > k, _h(x[0], seed), x[0])):
            if 2 * before + n <= 2 * k:
                out.add(g)
            before += n
    return out


def test_grouped_split(spark):
    sizes = {("ab"[g % 2], f"e{g:03d}"): 5 + g * 7 % 31 for g in range(90)}
    sizes["a", "hot"] = sum(n for (s, _), n in sizes.items() if s == "a")  # half of its stratum, a third of all rows
    rows = [(s, g, i) for (s, g), n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "s string, g string, i int")
    got = hash_split(df, ["i"], 0.2, 42, strata=["s"], group_col="g").collect()
    assert len(got) == len(rows)
    sides = {}
    for r in got:
        sides.setdefault(r["g"], set()).add(r["split"])
    assert all(len(v) == 1 for v in sides.values())
    test = {g for g, v in sides.items() if v == {"test"}}
    assert test == _grouped(sizes, 0.2) and "hot" not in test
    for s in "ab":
        total = sum(n for (t, _), n in sizes.items() if t == s)
        assert abs(sum(n for (t, g), n in sizes.items() if t == s and g in test) - 0.2 * total) < 20


def test_grouped_split_edge_cases(spark):
    ddl = "g string, s string"
    assert hash_split(spark.createDataFrame([], ddl), [], group_col="g").collect() == []
    # groups that are all larger than the share: one is tested on
    df = spark.createDataFrame([(g, None) for g in "abc" for _ in range(10)], ddl)
    assert sum(r["split"] == "test" for r in hash_split(df, [], 0.2, group_col="g").collect()) == 10
    # a NULL group stays together; a group in two strata counts in the least
    df = spark.createDataFrame([(None, "x")] * 4 + [("a", "x"), ("a", "y"), ("b", "y")], ddl)
    got = hash_split(df, [], 0.5, strata=["s"], group_col="g").collect()
    assert len(got) == 7 and all(len({r["split"] for r in got if r["g"] == g}) == 1 for g in (None, "a", "b"))


def test_grouped_wear_training(spark):
    from condmon.plans import ml

    rows = [(f"e{g:02d}", float(i), "worn" if g % 2 else "unworn", float(g % 2) + i / 100) for g in range(20) for i in range(10)]
    df = spark.createDataFrame(rows, "experiment string, seq double, tool_condition string, feedrate double")
    trained = ml.train_wear(df, ["experiment", "seq"], params={"maxIter": 2}, group_col="experiment")
    tested = trained.test_predictions.groupBy("experiment").count().collect()
    assert len(tested) == 4 and {r["count"] for r in tested} == {10}


def test_few_strata_leave_the_rows_spread(spark, monkeypatch):
    from condmon.operators import splits as SP

    df = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 2).alias("s"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = hash_split(df, ["id"], 0.2, 42, strata=["s"])
        tasks = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) == 8 and {r["count"] for r in tasks} == {500}
        sent = sorted(map(tuple, out.collect()), key=str)
        # more strata than are sent: the same sides
        monkeypatch.setattr(SP, "SENT_CUTOFFS", 0)
        assert sorted(map(tuple, hash_split(df, ["id"], 0.2, 42, strata=["s"]).collect()), key=str) == sent
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fit_partitions_follow_the_slots(spark, monkeypatch):
    from condmon.plans import ml

    monkeypatch.setattr(ml, "FIT_ROWS", 10)
    monkeypatch.setattr(ml, "MAX_FIT_ROWS", 50, raising=False)
    slots = spark.sparkContext.defaultParallelism

    def parts(n):
        rows = ml.training_rows(spark.range(n).withColumn("split", F.lit("train")))
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == n and rows.distinct().count() == n
        return len(sizes)

    assert parts(5) == 1 and parts(25) == 3
    # past a partition per slot: whole rounds of the slots, of up to 50 rows a partition
    assert parts(slots * 20) == slots and parts(slots * 120) == 3 * slots
