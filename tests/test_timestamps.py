"""File-name timestamps (FIXTURES.md section 7) and extension stripping."""

import datetime as dt
import os


from condmon.functions.timestamps import published_timestamp, snapshot_time, strip_extension


def test_published_and_typed(spark):
    names = ["2004.02.12.10.32.39", "2004.02.12.10.32.39.txt", "noext"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    got = {r["file"]: r for r in df.select("file", published_timestamp("file").alias("t"), snapshot_time("file").alias("e")).collect()}
    assert got["2004.02.12.10.32.39"]["t"] == "2004.02.12.10.32"
    assert got["2004.02.12.10.32.39"]["e"] == dt.datetime(2004, 2, 12, 10, 32, 39)
    assert got["2004.02.12.10.32.39.txt"]["t"] == "2004-02-12 10:32:39"
    assert got["2004.02.12.10.32.39.txt"]["e"] is None
    assert got["noext"]["t"] == "noext" and got["noext"]["e"] is None


def test_strip_extension_like_splitext(spark):
    names = [".hidden", "a..b", "file.", "..a", "a.b.c", "plain", "x.tar.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["s"] for r in df.select("n", strip_extension("n").alias("s")).collect()}
    for n in names:
        assert got[n] == os.path.splitext(n)[0], n
