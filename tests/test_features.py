"""Golden feature values (FIXTURES.md section 6) and NULL/edge rules."""

import math

import pytest

from conftest import wide
from condmon.operators.features import feature_table, stream_features

SIGNALS = {"A": [1, -2, 3, -4], "B": [0.5, 0.5, -0.25, 1, 0], "C": [2, 2, 2, 2, 2, 2], "D": [1, 2, 3, 4, 10]}
GOLDEN = {
    "mean": [2.5, 0.45, 2.0, 4.0],
    "std": [3.1091263510, 0.4873397172, 0.0, 3.5355339059],
    "skew": [0.0, 0.0809982910, 0.0, 1.6970562748],
    "kurtosis": [-2.4328180737, -0.8171745152, 0.0, 3.1520000000],
    "entropy": [1.3862943611, 1.3321790402, 0.0, 1.6094379124],
    "rms": [2.7386127875, 0.5590169944, 2.0, 5.0990195136],
    "max": [4.0, 1.0, 2.0, 10.0],
    "p2p": [7.0, 1.25, 4.0, 11.0],
    "crest": [1.4605934867, 1.7888543820, 1.0, 1.9611613514],
    "clearance": [2.3610353566, 0.3397056275, 2.0, 3.4659581891],
    "shape": [1.0954451150, 1.2422599875, 1.0, 1.2747548784],
    "impulse": [1.6, 2.2222222222, 1.0, 2.5],
}


@pytest.fixture(scope="module")
def table(spark):
    df = wide(spark, {k: [float(x) for x in v] for k, v in SIGNALS.items()})
    return {r["file"]: r for r in feature_table(df, checkpoint=False).collect()}


@pytest.mark.parametrize("feature", list(GOLDEN))
def test_golden(table, feature):
    for i, f in enumerate("ABCD"):
        for ch in ("b1", "b4"):
            assert table[f][f"{ch}_{feature}"] == pytest.approx(GOLDEN[feature][i], abs=1e-9)


def test_p2p_stream_differs_from_batch(spark):
    df = wide(spark, {k: [float(x) for x in v] for k, v in SIGNALS.items()}).withColumn("timestamp", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("t"))
    rows = {r["file"]: r for r in stream_features(df).collect()}
    assert [rows[f]["b1_p2p"] for f in "ABCD"] == [8.0, 1.25, 4.0, 11.0]
    # properties: rms <= max
    for f in "ABCD":
        assert rows[f]["b1_rms"] <= rows[f]["b1_max"] + 1e-12


def test_edge_rows(spark):
    df = wide(spark, {"one": [1.0], "two": [1.0, 2.0], "three": [1.0, 2.0, 4.0], "zeros": [0.0, 0.0], "nul": [1.0, None, 3.0]})
    t = {r["file"]: r for r in feature_table(df, checkpoint=False).collect()}
    assert t["one"]["b1_std"] is None and t["one"]["b1_skew"] is None and t["one"]["b1_kurtosis"] is None
    assert t["two"]["b1_skew"] is None and t["two"]["b1_kurtosis"] is None
    assert t["three"]["b1_skew"] is not None and t["three"]["b1_kurtosis"] is None
    for f in ("crest", "shape", "impulse"):
        assert t["zeros"][f"b1_{f}"] is None
    # a NULL sample: batch rms and entropy are NULL, mean skips it
    assert t["nul"]["b1_rms"] is None
    assert t["nul"]["b1_entropy"] is None
    assert t["nul"]["b1_mean"] == pytest.approx(2.0)
    # clearance divides by all rows, NULL included
    assert t["nul"]["b1_clearance"] == pytest.approx(((1 + math.sqrt(3)) / 3) ** 2)


def test_stream_rms_skips_null(spark):
    from pyspark.sql import functions as F

    df = wide(spark, {"nul": [1.0, None, 3.0]}).withColumn("timestamp", F.lit("t"))
    r = stream_features(df).collect()[0]
    assert r["b1_rms"] == pytest.approx(math.sqrt(5.0))


def test_small_signals_as_pandas(spark):
    """Batch features and feature table follow pandas' rounding guards."""
    import numpy as np
    import pandas as pd
    import pytest

    from condmon.operators.features import feature_table, snapshot_features

    rng = np.random.default_rng(4)
    sig = {f"s{k}": (10.0**-k * rng.gamma(1.5, size=200)).tolist() for k in range(4, 10)}
    rows = wide(spark, sig)
    batch = {r["file"]: r for r in snapshot_features(rows).collect()}
    table = {r["file"]: r for r in feature_table(rows).collect()}
    for f, xs in sig.items():
        s = pd.Series(xs)
        for name, want in (("skew", s.skew()), ("kurtosis", s.kurtosis())):
            assert table[f][f"b1_{name}"] == pytest.approx(want, rel=1e-6, abs=1e-9), (f, name)
            assert batch[f][f"b1_{name}"] == pytest.approx(want, rel=1e-6, abs=1e-9), (f, name)


def test_feature_table_explodes_bin_codes_only(spark):
    """No row that carries moments or samples is exploded."""
    import re

    from condmon.operators.features import feature_table

    df = wide(spark, {"2004.01.01.00.00.00": [1.0, 2.0, 5.0]})
    plan = feature_table(df)._jdf.queryExecution().optimizedPlan().toString()
    made = re.findall(r"Generate explode\((.*)\), .*, \[(.*)\]", plan)
    assert len(made) == 1 and made[0][1].startswith("_code") and "struct" not in made[0][0]
