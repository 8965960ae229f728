"""Metadata joins and row cleaning on the shipped metadata shape."""

import pytest
from pyspark.sql import functions as F

from condmon.operators import cleaning as CL
from condmon.operators import joins as J
from condmon.schemas import EXPERIMENT_METADATA

# The 18 experiment metadata rows of the tool-wear dataset.
META = [
    (1, "wax", 6.0, 4.0, "unworn", "yes", "yes"), (2, "wax", 20.0, 4.0, "unworn", "yes", "yes"),
    (3, "wax", 6.0, 3.0, "unworn", "yes", "yes"), (4, "wax", 6.0, 2.5, "unworn", "no", None),
    (5, "wax", 20.0, 3.0, "unworn", "no", None), (6, "wax", 6.0, 4.0, "worn", "yes", "no"),
    (7, "wax", 20.0, 4.0, "worn", "no", None), (8, "wax", 20.0, 4.0, "worn", "yes", "no"),
    (9, "wax", 15.0, 4.0, "worn", "yes", "no"), (10, "wax", 12.0, 4.0, "worn", "yes", "no"),
    (11, "wax", 3.0, 4.0, "unworn", "yes", "yes"), (12, "wax", 3.0, 3.0, "unworn", "yes", "yes"),
    (13, "wax", 3.0, 4.0, "worn", "yes", "yes"), (14, "wax", 3.0, 3.0, "worn", "yes", "yes"),
    (15, "wax", 6.0, 3.0, "worn", "yes", "yes"), (16, "wax", 20.0, 3.0, "worn", "no", None),
    (17, "wax", 3.0, 2.5, "unworn", "yes", "yes"), (18, "wax", 3.0, 2.5, "worn", "yes", "yes"),
]


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame(META, EXPERIMENT_METADATA)


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(f"experiment_{i:02d}", float(i * 10 + k)) for i in range(1, 21) for k in range(3)]
    return spark.createDataFrame(rows, "experiment string, X1_ActualPosition double")


def test_exact_rule_finds_no_key(meta, samples):
    out = J.lookup_join(samples, meta)
    assert out.where(F.col("metadata").isNotNull()).count() == 0
    assert out.count() == samples.count()


def test_suffix_rule(meta, samples):
    out = J.flatten_metadata(J.lookup_join(samples, meta, key_rule="suffix", pad=2), ["No", "tool_condition"])
    got = {r["experiment"]: r["No"] for r in out.collect()}
    assert got["experiment_01"] == 1 and got["experiment_18"] == 18 and got["experiment_19"] is None


def test_ordinal_join_min_length(meta, samples):
    out = J.ordinal_join(samples, meta)
    exps = {r["experiment"]: r["No"] for r in out.select("experiment", "No").distinct().collect()}
    assert len(exps) == 18 and exps["experiment_01"] == 1 and exps["experiment_18"] == 18


def test_dropna_keeps_14_experiments(meta, samples):
    joined = J.ordinal_join(samples, meta)
    clean = CL.drop_incomplete(joined)
    per = {r["tool_condition"]: r["n"] for r in clean.select("experiment", "tool_condition").distinct()
           .groupBy("tool_condition").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"unworn": 6, "worn": 8}


def test_absent_columns_not_fillna(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    out = CL.add_absent_columns(df, ["a", "b", "c"]).collect()[0]
    assert (out["a"], out["b"], out["c"]) == (1.0, None, 0.0)


def test_required_input_checks(spark):
    from condmon.plans import ml

    df = spark.createDataFrame([(1.0, "worn")], "a double, tool_condition string")
    with pytest.raises(ValueError):
        CL.existing_columns(df, ["X1_ActualPosition"])
    with pytest.raises(ValueError):
        ml.train_wear(df.drop("tool_condition"), ["a"])


def test_unpaired_sides_are_named_and_warned_of(spark):
    import pytest

    from condmon.operators.joins import ordinal_join, unpaired

    samples = spark.createDataFrame([(f"e{i}", float(i)) for i in range(4) for _ in range(3)], "experiment string, x double")
    meta = spark.createDataFrame([(i, f"m{i}") for i in (10, 20, 30, 40, 50, 60)], "No int, material string")
    left = {(r["ordinal"], r["side"], r["experiment"], r["No"]) for r in unpaired(samples, meta).collect()}
    assert left == {(5, "metadata", None, 50), (6, "metadata", None, 60)}
    with pytest.warns(UserWarning, match="4 experiments and 6 metadata rows"):
        assert ordinal_join(samples, meta).count() == 12
    short = meta.where("No < 30")
    left = {(r["ordinal"], r["side"], r["experiment"], r["No"]) for r in unpaired(samples, short).collect()}
    assert left == {(3, "experiment", "e2", None), (4, "experiment", "e3", None)}
    assert unpaired(samples, meta.where("No < 50")).count() == 0
