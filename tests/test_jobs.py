"""The four jobs through the command line, on fixture files:
publish -> train both models -> serve both streams."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from condmon import cli
from condmon.plans.publish import messages
from condmon.session import work_dir
from condmon.sources import topics as TP
from condmon.sources.experiment_files import EXPERIMENT_COLUMNS


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    rng = np.random.default_rng(11)
    broot = tmp_path_factory.mktemp("bearing")
    for s, width in (("1st_test", 8), ("2nd_test", 4), ("3rd_test", 4)):
        d = broot / s / s
        d.mkdir(parents=True)
        for i in range(10):
            rows = rng.normal(scale=0.05 * (i + 1), size=(50, width))
            (d / f"2004.03.0{1 + i // 5}.1{i % 5}.00.00").write_text(
                "\n".join("\t".join(f"{v:.3f}" for v in r) for r in rows) + "\n")
        if s == "1st_test":  # a 4-wide file in the first set: not published
            (d / "2004.03.09.00.00.00").write_text("1\t2\t3\t4\n")
    troot = tmp_path_factory.mktemp("cnc")
    header = ",".join(EXPERIMENT_COLUMNS + ["Machining_Process"])
    for i in range(1, 5):
        lines = [header] + [",".join([str(float(i * 10 + k + j % 3)) for j in range(len(EXPERIMENT_COLUMNS))]
                                     + ["Layer 2 Down"]) for k in range(25)]
        (troot / f"experiment_{i:02d}.csv").write_text("\n".join(lines) + "\n")
    (troot / "train.csv").write_text(
        "No,material,feedrate,clamp_pressure,tool_condition,machining_finalized,passed_visual_inspection\n"
        "1,wax,6,4,unworn,yes,yes\n2,wax,20,4,worn,yes,no\n3,wax,6,3,unworn,yes,yes\n4,wax,12,3,worn,yes,no\n")
    return str(broot), str(troot)


def test_publish_rules(spark, roots):
    broot, troot = roots
    msgs = messages(spark, "both", broot, troot)
    bearing = TP.parse_bearing(msgs)
    assert bearing.where(F.col("file") == "2004.03.09.00.00.00").count() == 0  # by-test guard
    assert bearing.select("timestamp").distinct().where(F.col("timestamp").contains("-")).count() == 0  # F3
    tool = TP.parse_toolwear(msgs)
    assert tool.where(F.col("metadata").isNotNull()).count() == 0  # 'No' is not a key candidate
    assert tool.where(F.col("timestamp").isNotNull()).count() == 0  # no time column
    assert messages(spark, "neither", broot, troot) is None
    assert messages(spark, "BEARING", broot, troot).select("topic").distinct().count() == 1


def test_cli_end_to_end(spark, roots):
    broot, troot = roots
    records, rul, wear = work_dir(spark, "j-rec"), work_dir(spark, "j-rul"), work_dir(spark, "j-wear")
    sinks, ckpts = work_dir(spark, "j-sinks"), work_dir(spark, "j-ckpt")
    # suffix rule so the served tool-wear rows carry their metadata features
    assert cli.main(["publish", "--bearing-root", broot, "--toolwear-root", troot, "--out", records,
                     "--key-rule", "suffix"]) == 0
    assert cli.main(["train-bearing", "--root", broot, "--model", rul, "--trees", "3"]) == 0
    assert cli.main(["train-toolwear", "--root", troot, "--model", wear, "--trees", "3"]) == 0
    assert cli.main(["serve", "--bearing-model", rul, "--toolwear-model", wear, "--records", records,
                     "--sinks", sinks, "--checkpoints", ckpts, "--available-now"]) == 0
    bp = spark.read.parquet(f"{sinks}/bearing_predictions")
    assert bp.select("test_set", "file").distinct().count() == 30
    assert set(bp.columns) == {"test_set", "file", "timestamp", "rul_prediction", "batch_id"}
    tp = spark.read.parquet(f"{sinks}/toolwear_predictions")
    assert tp.count() == 100
    assert {r[0] for r in tp.select("tool_condition_prediction").distinct().collect()} <= {"worn", "unworn"}


def test_finalize_mode_one_row_per_snapshot(spark):
    from condmon.sources import driver_tables as T
    from condmon.streaming import bearing as SB

    recs = T.bearing_records(spark, "/root/testdata/sf0.001")
    landing = work_dir(spark, "fin-landing")
    TP.write_messages(TP.bearing_messages(recs).repartition(3), landing, mode="overwrite")
    sink, ckpt = work_dir(spark, "fin-sink"), work_dir(spark, "fin-ckpt")
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=1)
    SB.start(SB.bearing_feature_stream(stream, finalize_after="0 seconds"), sink, ckpt, "append").awaitTermination()
    out = SB.read_sink(spark, sink)
    n = out.count()
    # each emitted snapshot appears once; the newest ones wait for a later watermark
    assert n == out.select("test_set", "file").distinct().count()
    assert 0 < n <= recs.select("test_set", "file").distinct().count()
