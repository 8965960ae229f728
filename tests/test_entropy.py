"""Histogram entropy equals NumPy's 500-bin histogram entropy."""

import numpy as np
import pytest

from condmon.operators.entropy import histogram_entropy


def numpy_entropy(values, bins=500):
    counts, _ = np.histogram(np.asarray(values, dtype=float), bins=bins)
    counts = counts[counts > 0]
    p = counts / counts.sum()
    return float(-(p * np.log(p)).sum())


def test_matches_numpy(spark):
    rng = np.random.default_rng(7)
    groups = {
        "normal": rng.normal(size=1000),
        "quantised": np.round(rng.normal(size=800), 2),
        "uniform_edges": np.linspace(-1, 1, 501),
        "constant": np.full(20, 3.5),
        "two": np.array([0.0, 1.0]),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r["entropy"] for r in histogram_entropy(df, ["g"]).collect()}
    for g, xs in groups.items():
        assert got[g] == pytest.approx(numpy_entropy(xs), abs=1e-12), g
    assert got["constant"] == 0.0


def test_bounds(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 7, float(x)) for i, x in enumerate(rng.exponential(size=3000))]
    df = spark.createDataFrame(rows, "g int, x double")
    for r in histogram_entropy(df, ["g"]).collect():
        assert 0.0 <= r["entropy"] <= np.log(min(3000 / 7 + 1, 500)) + 1e-9
