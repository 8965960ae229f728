"""Raw snapshot files (A1, B1-B4) on generated fixture files."""

import os

import pytest

from condmon.sources.bearing_files import read_snapshot_files


def _write(root, test_set, name, lines):
    d = os.path.join(root, test_set, test_set)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join("\t".join(str(v) for v in ln) for ln in lines) + "\n")


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bearing"))
    _write(root, "1st_test", "2004.01.01.00.00.00", [[1, 9, 2, 9, 3, 9, 4, 9], [5, 9, 6, 9, 7, 9, 8, 9]])  # 8-wide
    _write(root, "1st_test", "2004.01.01.00.10.00", [[1, 2, 3, 4], [5, 6, 7, 8]])  # 4-wide in set 1
    _write(root, "2nd_test", "2004.02.01.00.00.00", [[1, 2, 3, 4], [5, 6, 7, 8]])
    _write(root, "2nd_test", "2004.02.01.00.10.00", [[1, 2, 3], [4, 5, 6]])  # 3-wide: skipped
    _write(root, "3rd_test", "2004.03.01.00.00.00", [[1, 2, 3, 4], [1, 2, 3, 4, 5]])  # wider later line
    _write(root, "3rd_test", "2004.03.01.00.10.00", [[1, 2, 3, 4], [1, 2]])  # narrower: NULL padded
    return root


def test_by_width(spark, tree):
    rows = read_snapshot_files(spark, tree, policy="by_width").collect()
    files = {(r["test_set"], r["file"]) for r in rows}
    assert ("1st_test", "2004.01.01.00.00.00") in files
    assert ("1st_test", "2004.01.01.00.10.00") in files  # kept by width
    assert ("2nd_test", "2004.02.01.00.10.00") not in files
    assert ("3rd_test", "2004.03.01.00.00.00") not in files
    eight = sorted((r["seq"], r["b1"], r["b2"], r["b3"], r["b4"]) for r in rows if r["file"] == "2004.01.01.00.00.00")
    assert eight == [(0, 1.0, 2.0, 3.0, 4.0), (1, 5.0, 6.0, 7.0, 8.0)]
    narrow = sorted((r["seq"], r["b3"]) for r in rows if r["file"] == "2004.03.01.00.10.00")
    assert narrow == [(0, 3.0), (1, None)]


def test_by_test(spark, tree):
    files = {(r["test_set"], r["file"]) for r in read_snapshot_files(spark, tree, policy="by_test").collect()}
    assert ("1st_test", "2004.01.01.00.10.00") not in files  # skipped by test name
    assert ("2nd_test", "2004.02.01.00.00.00") in files


def test_experiment_files(spark, tmp_path):
    from condmon.operators.joins import ordinal_join
    from condmon.sources.experiment_files import EXPERIMENT_COLUMNS, read_experiments, read_metadata

    header = ",".join(EXPERIMENT_COLUMNS + ["Machining_Process"])
    for i in (1, 2, 3):
        row = ",".join(["1.5"] * len(EXPERIMENT_COLUMNS) + ["Layer 1 Up"])
        (tmp_path / f"experiment_{i:02d}.csv").write_text(header + "\n" + row + "\n" + row + "\n")
    (tmp_path / "train.csv").write_text(
        "No,material,feedrate,clamp_pressure,tool_condition,machining_finalized,passed_visual_inspection\n"
        "1,wax,6,4,unworn,yes,yes\n2,wax,20,4,unworn,no,\n"
    )
    (tmp_path / "notes.txt").write_text("x")
    exp = read_experiments(spark, str(tmp_path))
    assert sorted(r["experiment"] for r in exp.select("experiment").distinct().collect()) == [
        "experiment_01", "experiment_02", "experiment_03"]
    meta = read_metadata(spark, str(tmp_path))
    assert [r["passed_visual_inspection"] for r in meta.orderBy("No").collect()] == ["yes", None]
    joined = ordinal_join(exp, meta)
    assert sorted(r["experiment"] for r in joined.select("experiment").distinct().collect()) == [
        "experiment_01", "experiment_02"]


def test_file_report(spark, tree):
    from condmon.sources.bearing_files import snapshot_file_report

    rep = {r["file"]: r for r in snapshot_file_report(spark, tree).collect()}
    assert rep["2004.03.01.00.00.00"]["reason"] == "line wider than the first"
    assert rep["2004.02.01.00.10.00"]["reason"] == "unexpected width"
    assert rep["2004.01.01.00.10.00"]["keep_by_width"] and not rep["2004.01.01.00.10.00"]["keep_by_test"]
    assert rep["2004.01.01.00.00.00"]["reason"] is None and rep["2004.01.01.00.00.00"]["lines"] == 2


def test_experiment_samples_keep_file_order(spark, tmp_path):
    from condmon.operators.cleaning import elapsed_time
    from condmon.sources.experiment_files import EXPERIMENT_COLUMNS, read_experiments

    header = ",".join(EXPERIMENT_COLUMNS + ["Machining_Process"])
    body = [",".join([str(float(k))] * len(EXPERIMENT_COLUMNS) + [f'"Layer {k % 3 + 1} Up"']) for k in (5, 3, 9, 1)]
    (tmp_path / "experiment_07.csv").write_text(header + "\n" + "\n".join(body) + "\n")
    (tmp_path / "train.csv").write_text("No,material\n1,wax\n")
    out = elapsed_time(read_experiments(spark, str(tmp_path))).orderBy("seq").collect()
    assert [(r["seq"], r["X1_ActualPosition"], r["elapsed_s"]) for r in out] == [
        (0, 5.0, 0.0), (1, 3.0, 0.1), (2, 9.0, 0.2), (3, 1.0, 0.30000000000000004)]
    assert out[0]["Machining_Process"] == "Layer 3 Up" and out[0]["experiment"] == "experiment_07"


def test_columns_by_header_name(spark, tmp_path):
    """Swapped, extra and missing header columns give pandas' values."""
    import pandas as pd

    from condmon.sources.experiment_files import read_experiments, read_metadata

    files = {
        "experiment_01.csv": "X1_ActualPosition,Y1_ActualPosition,Machining_Process\n1,2,Prep\n3,4,End\n",
        "experiment_02.csv": "time,Machining_Process,Y1_ActualPosition,X1_ActualPosition\n9.5,Prep,20,10\n\n9.6,\"a,b\",,30\n",
        "experiment_03.CSV": "X1_ActualPosition\n7\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "train.csv").write_text("tool_condition,No,operator\nworn,2,x\n,1,\n")
    got = read_experiments(spark, str(tmp_path)).toPandas()
    assert list(got.columns) == ["experiment", "seq", "X1_ActualPosition", "Y1_ActualPosition", "Machining_Process", "time"]
    want = pd.concat(pd.read_csv(tmp_path / n).assign(experiment=n[:13]) for n in files)
    for c in ("X1_ActualPosition", "Y1_ActualPosition", "time"):
        a = got.sort_values(["experiment", "seq"])[c].tolist()
        assert [x for x in a if x == x] == [x for x in want[c].tolist() if x == x]
        assert [x == x for x in a] == [x == x for x in want[c].tolist()]
    assert set(got["Machining_Process"].dropna()) == {"Prep", "End", "a,b"}
    meta = read_metadata(spark, str(tmp_path)).orderBy("No")
    assert meta.columns == ["No", "tool_condition", "operator"]
    assert [tuple(r) for r in meta.collect()] == [(1, None, None), (2, "worn", "x")]


def test_training_stops_at_an_unreadable_file(spark, tree):
    with pytest.raises(Exception, match="line wider than the first"):
        read_snapshot_files(spark, tree, on_wide="fail").collect()


def test_empty_lines_are_skipped(spark, tmp_path):
    _write(str(tmp_path), "1st_test", "f", [[1, 2, 3, 4], [], [5, 6, 7, 8]])
    rows = read_snapshot_files(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["seq"], r["b1"]) for r in rows] == [(0, 1.0), (1, 5.0)]


def test_snapshot_files_round_trip(spark, tmp_path):
    """Samples landed as one file per snapshot and scanned back give the
    same features as the samples themselves."""
    import numpy as np

    from condmon.operators.features import snapshot_features
    from condmon.sources.bearing_files import write_snapshot_files

    rng = np.random.default_rng(2)
    rows = [(s, f"2004.01.0{d}.00.00.00", *map(float, np.round(rng.normal(size=4), 4)))
            for s in ("1st_test", "2nd_test") for d in range(1, 6) for _ in range(40)]
    df = spark.createDataFrame(rows, "test_set string, file string, b1 double, b2 double, b3 double, b4 double")
    root = str(tmp_path / "landed")
    write_snapshot_files(df, root)
    back = read_snapshot_files(spark, root, layout="partitioned")
    assert back.count() == 400
    a = {r["file"] + r["test_set"]: r for r in snapshot_features(back).collect()}
    b = {r["file"] + r["test_set"]: r for r in snapshot_features(df).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in a[k].asDict():
            if c not in ("test_set", "file"):
                assert a[k][c] == pytest.approx(b[k][c], rel=1e-12, abs=1e-12), (k, c)


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _mixed_tree(root):
    rng = __import__("random").Random(3)
    for i in range(12):
        width = (8, 4, 4, 3)[i % 4]
        lines = [[rng.randint(-99, 99) for _ in range(width)] for _ in range((5, 700, 60)[i % 3])]
        if i % 5 == 0:
            lines.insert(len(lines) // 2, [])
        if i == 6:
            lines.append([1] * 9)  # the last of hundreds of lines is wider
        _write(root, ("1st_test", "2nd_test")[i % 2], f"2004.01.{i + 1:02d} 00+%", lines)


def test_splittable_files_equal_whole_files(spark, tmp_path, small_splits):
    """First-line width, wider-line check, sequence and names, in many splits."""
    from condmon.sources import bearing_files as BF
    from condmon.sources import lines as LN

    _mixed_tree(str(tmp_path))
    blocks = LN.blocks_of(LN.stage_lines(LN.scan_lines(spark, str(tmp_path), recursive=True)))
    assert blocks.count() > 3 * blocks.select("path").distinct().count()
    whole = spark.read.option("recursiveFileLookup", True).text(str(tmp_path), wholetext=True).select(
        LN.folder_name("_metadata.file_path").alias("test_set"), LN.file_name("_metadata.file_path").alias("file"), "value"
    )
    for policy in BF.POLICIES:
        want = sorted(BF.parse_snapshot_texts(whole, policy).collect())
        got = sorted(read_snapshot_files(spark, str(tmp_path), policy).collect())
        assert got == want and len(got) > 500
    assert {r["file"] for r in got} <= {f"2004.01.{i + 1:02d} 00+%" for i in range(12)} and all(r["seq"] >= 0 for r in got)
    with pytest.raises(Exception, match="line wider than the first"):
        read_snapshot_files(spark, str(tmp_path), on_wide="fail").collect()


def test_no_row_holds_a_file(spark, tmp_path, small_splits):
    _mixed_tree(str(tmp_path))
    df = read_snapshot_files(spark, str(tmp_path))
    plan = df._jdf.queryExecution().toString()
    assert "Generate" not in plan and "parquet" in plan and "wholetext" not in plan


def test_splittable_experiment_files(spark, tmp_path, small_splits):
    import pandas as pd

    from condmon.sources.experiment_files import read_experiments

    heads = ["time,X1_ActualPosition,Machining_Process", "Machining_Process,time,X1_ActualPosition", "X1_ActualPosition"]
    for i in range(6):
        body = [f"{k / 10},{k},\"a, {k}\"" if i % 3 == 0 else f"Prep,{k / 10},{k}" if i % 3 == 1 else str(k) for k in range(200 * i + 1)]
        (tmp_path / f"experiment_{i:02d}.{'csv' if i % 2 else 'CSV'}").write_text(heads[i % 3] + "\n" + "\n".join(body) + "\n")
    (tmp_path / "train.csv").write_text("No\n1\n")
    (tmp_path / "experiment_99.txt").write_text("no,data\n1,2\n")
    got = read_experiments(spark, str(tmp_path)).toPandas().sort_values(["experiment", "seq"])
    for i in range(6):
        want = pd.read_csv(next(tmp_path.glob(f"experiment_{i:02d}.*")))
        mine = got[got.experiment == f"experiment_{i:02d}"]
        assert mine.seq.tolist() == list(range(len(want)))
        for c in want.columns:
            assert mine[c].tolist() == want[c].tolist(), (i, c)
    assert set(got.experiment) == {f"experiment_{i:02d}" for i in range(6)}


def test_report_names_every_file(spark, tmp_path):
    """Unreadable, empty, wide and non-numeric files each have a row."""
    from condmon.sources.bearing_files import snapshot_file_report

    _write(str(tmp_path), "1st_test", "good", [[1, 2, 3, 4], [5, 6, 7, 8]])
    _write(str(tmp_path), "1st_test", "cells", [["n/a", 2, 3, 4], [5, "x", 7, 8]])
    _write(str(tmp_path), "2nd_test", "wide", [[1, 2, 3, 4], [5, 6, 7, 8, 9]])
    _write(str(tmp_path), "2nd_test", "blank", [[], []])
    folder = tmp_path / "2nd_test" / "2nd_test"
    (folder / "nothing").write_text("")
    (folder / "broken.gz").write_bytes(b"1\t2\t3\t4\n")
    (folder / "bytes").write_bytes(b"\xff\xfe\t2\t3\t4\n")
    rep = {r["file"]: r for r in snapshot_file_report(spark, str(tmp_path)).collect()}
    assert {f: r["reason"] for f, r in rep.items()} == {
        "good": None, "cells": "non-numeric cells", "wide": "line wider than the first", "blank": "empty",
        "nothing": "empty", "broken.gz": "unreadable", "bytes": "non-numeric cells",
    }
    assert rep["cells"]["non_numeric_cells"] == 2 and rep["broken.gz"]["size"] == 8 and rep["good"]["lines"] == 2
    kept = read_snapshot_files(spark, str(tmp_path), ignore_corrupt=True).select("file").distinct().collect()
    assert {r["file"] for r in kept} == {"good", "cells", "bytes"}


def test_files_landed_in_order(spark, tmp_path):
    from condmon.sources.landing import land_files

    rows = [(f, f"n {k:02d}+.csv", i, f"{f} {k} {i}") for f in ("b", "a") for k in range(5) for i in reversed(range(300))]
    df = spark.createDataFrame(rows, "folder string, name string, no int, line string")
    assert land_files(df, str(tmp_path / "x"), in_name_order=True) == 10
    files = sorted((tmp_path / "x").glob("*/*.csv"), key=lambda p: p.stat().st_mtime)
    assert [(p.parent.name, p.name) for p in files] == [(f, f"n {k:02d}+.csv") for f in "ab" for k in range(5)]
    assert files[7].read_text().splitlines() == [f"b 2 {i}" for i in range(300)]
    assert land_files(df.where("folder = 'a'").withColumn("folder", __import__("pyspark").sql.functions.lit("")), str(tmp_path / "y")) == 5
    assert len(list((tmp_path / "y").glob("*.csv"))) == 5


def test_files_named_by_tasks(spark, tmp_path, monkeypatch):
    """On a mounted folder the driver names no file; missing names and lines
    are kept as Spark's writers keep them."""
    from condmon.sources import landing

    monkeypatch.setattr(landing, "unquote", lambda *_: pytest.fail("the driver named a file"))
    rows = [("a", f"f{k}", i, f"{k}\t{i}") for k in range(40) for i in (1, 0)] + [("a", "f7", 2, None), (None, None, 0, "x"), ("b", "", 0, "")]
    df = spark.createDataFrame(rows, "folder string, name string, no int, line string").repartition(5)
    assert landing.land_files(df, f"file://{tmp_path}/x", in_name_order=True) == 42
    found = {str(p.relative_to(tmp_path / "x")): p.read_text() for p in (tmp_path / "x").rglob("*") if p.is_file()}
    want = {f"a/f{k}": f"{k}\t0\n{k}\t1\n" + "\n" * (k == 7) for k in range(40)}
    assert found == want | {"_HIVE_DEFAULT_PARTITION__/__HIVE_DEFAULT_PARTITION__": "x\n", "b/__HIVE_DEFAULT_PARTITION__": "\n"}
    files = sorted((tmp_path / "x").glob("a/*"), key=lambda p: p.stat().st_mtime_ns)
    assert [p.name for p in files] == sorted(p.name for p in files)


def test_small_files_share_tasks(spark, tmp_path):
    """Many small files are scanned in few tasks, with the lines of each in order."""
    from condmon.sources import lines as LN

    for k in range(1200):
        (tmp_path / f"f{k:04d}").write_text(f"{k}\n{k + 1}\n")
    raw = LN.scan_lines(spark, str(tmp_path))
    staged = LN.stage_lines(raw)
    splits = raw.rdd.getNumPartitions()
    assert len(staged.inputFiles()) == max(-(-splits // LN.SPLITS_PER_TASK), 2 * spark.sparkContext.defaultParallelism) < splits
    rows = LN.numbered(staged, LN.blocks_of(staged)).collect()
    assert len(rows) == 2400 and all(int(r["value"]) == int(r["path"][-4:]) + r["no"] for r in rows)


def test_one_scan_for_both_policies(spark, tree):
    from condmon.sources import bearing_files as BF

    scanned = BF.scan_snapshot_files(spark, tree)
    for policy in BF.POLICIES:
        own = BF.read_snapshot_files(spark, tree, policy).collect()
        assert sorted(BF.read_snapshot_files(spark, tree, policy, scanned=scanned).collect()) == sorted(own)


def test_count_files(spark, tmp_path):
    from condmon.sources import lines as LN

    (tmp_path / "a").mkdir()
    for name, text in (("a/x 1", "1\n"), ("a/y+", ""), ("z", "2")):
        (tmp_path / name).write_text(text)
    assert LN.count_files(spark, str(tmp_path), recursive=True) == LN.list_files(spark, str(tmp_path), recursive=True).count() == 3
