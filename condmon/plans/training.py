"""Offline training jobs.

Bearing RUL: scan snapshot files -> width guard and channels -> feature
table of the failing bearings -> cycles and RUL per test set -> failing-bearing
columns aligned across sets -> 80/20 hash split -> GBT regressor -> RMSE ->
saved pipeline.

Tool wear: one scan of all experiment files + the metadata file ->
ordinal pairing -> drop incomplete rows -> present candidate features ->
stratified split -> GBT classifier -> accuracy and report -> saved pipeline.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from condmon.operators.features import snapshot_features
from condmon.operators.joins import ordinal_join
from condmon.operators.supervised import rul_cycles, rul_supervised
from condmon.plans import ml
from condmon.schemas import FAILING_BEARING, RUL_FEATURES
from condmon.sources.bearing_files import read_snapshot_files
from condmon.sources.experiment_files import read_experiments, read_metadata


def bearing_training_table(spark: SparkSession, root: str, policy: str = "by_width") -> DataFrame:
    """Cycles and the selected features of the failing bearings (the only
    ones the model reads; ``feature_table`` gives all 48).  A file that cannot
    be read stops the job."""
    samples = read_snapshot_files(spark, root, policy=policy, on_wide="fail")
    channels = sorted({c.rstrip("_") for c in FAILING_BEARING.values()})
    names = [f.lstrip("_") for f in RUL_FEATURES]
    feats = snapshot_features(samples, channels=channels, features=names)
    return rul_supervised(rul_cycles(feats))


def require_sets(spark: SparkSession, supervised: DataFrame) -> None:
    """Sets 1 and 2 are required; a missing third only warns."""
    present = {r[0] for r in supervised.select("test_set").distinct().collect()}  # at most three names
    missing = [s for s in FAILING_BEARING if s not in present]
    if required := [s for s in missing if s != "3rd_test"]:
        raise RuntimeError(f"no snapshots of {', '.join(required)}")
    if missing:
        warnings.warn("no snapshots of 3rd_test; training on the other sets", stacklevel=2)


def train_rul_model(
    spark: SparkSession, root: str, model_path: str | None = None, params: dict | None = None
) -> ml.Trained:
    sup = bearing_training_table(spark, root)
    if not sup.take(1):
        raise RuntimeError("no supervised rows could be built from the bearing sets")
    require_sets(spark, sup)
    feature_cols = [c for c in sup.columns if c not in ("test_set", "file", "rul")]
    trained = ml.train_rul(sup, feature_cols, params=params)
    if model_path:
        ml.save(trained.model, model_path)
    return trained


def toolwear_training_table(spark: SparkSession, root: str) -> DataFrame:
    return ordinal_join(read_experiments(spark, root), read_metadata(spark, root))


def train_wear_model(
    spark: SparkSession, root: str, model_path: str | None = None, params: dict | None = None, grouped: bool = False
) -> ml.Trained:
    """``grouped`` keeps the rows of an experiment on one side of the split."""
    data = toolwear_training_table(spark, root)
    # a sample's id is its place in its file; equal rows stay separate
    trained = ml.train_wear(data, key_cols=["experiment", "seq"], params=params, group_col="experiment" if grouped else None)
    if model_path:
        ml.save(trained.model, model_path)
    return trained
