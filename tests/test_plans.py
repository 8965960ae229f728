"""End-to-end training and serving plans on small fixture trees."""

import os

import pytest

from condmon.plans import ml
from condmon.plans.training import (
    bearing_training_table,
    train_rul_model,
    train_wear_model,
)


def _snap(root, test_set, name, rows):
    d = os.path.join(root, test_set, test_set)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join("\t".join(f"{v:.3f}" for v in r) for r in rows) + "\n")


@pytest.fixture(scope="module")
def bearing_root(tmp_path_factory):
    import numpy as np

    root = str(tmp_path_factory.mktemp("snapshots"))
    rng = np.random.default_rng(3)
    for s, width in (("1st_test", 8), ("2nd_test", 4), ("3rd_test", 4)):
        for i in range(12):
            rows = rng.normal(scale=0.1 + 0.02 * i, size=(64, width))
            _snap(root, s, f"2004.0{1 + len(s) % 3}.1{i // 10}.{i % 10}0.00.00", rows)
    return root


def test_bearing_training_table(spark, bearing_root):
    sup = bearing_training_table(spark, bearing_root)
    assert sup.columns == ["test_set", "file", "b3_max", "b3_p2p", "b3_rms", "b4_max", "b4_p2p", "b4_rms", "rul"]
    per_set = {r["test_set"]: sorted(x["rul"] for x in sup.where(sup.test_set == r["test_set"]).collect())
               for r in sup.select("test_set").distinct().collect()}
    assert all(v == list(range(1, 13)) for v in per_set.values()) and len(per_set) == 3


def test_train_and_reload_bearing(spark, bearing_root, tmp_path):
    path = str(tmp_path / "rul")
    trained = train_rul_model(spark, bearing_root, path, params={"maxIter": 3})
    assert trained.metrics.collect()[0]["n"] == 8  # ceil(0.2 * 36)
    assert ml.model_feature_cols(ml.load(path)) == trained.feature_cols


def test_train_toolwear(spark, tmp_path):
    from condmon.sources.experiment_files import EXPERIMENT_COLUMNS

    header = ",".join(EXPERIMENT_COLUMNS + ["Machining_Process"])
    for i in range(1, 5):
        lines = [header]
        for k in range(30):
            vals = [str(float(i * 100 + k + j)) for j in range(len(EXPERIMENT_COLUMNS))]
            lines.append(",".join(vals + ["Layer 1 Up"]))
        (tmp_path / f"experiment_{i:02d}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "train.csv").write_text(
        "No,material,feedrate,clamp_pressure,tool_condition,machining_finalized,passed_visual_inspection\n"
        "1,wax,6,4,unworn,yes,yes\n2,wax,20,4,worn,yes,no\n3,wax,6,3,unworn,yes,yes\n4,wax,6,2.5,worn,no,\n"
    )
    trained = train_wear_model(spark, str(tmp_path), params={"maxIter": 3})
    rep = {r["label"]: r for r in trained.metrics.collect()}
    # experiment 4 has a blank inspection field and is dropped: 90 rows,
    # 60 unworn / 30 worn -> 12 + 6 test rows
    assert rep["accuracy"]["support"] == 18
    assert set(rep) >= {"unworn", "worn", "accuracy", "macro avg", "weighted avg"}
    assert trained.feature_cols[:2] == ["clamp_pressure", "feedrate"]
