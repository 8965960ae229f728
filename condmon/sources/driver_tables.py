"""Adapters from the shared parquet tables to the shapes of this library.

The parquet tables stand in for the sensor data:

* ``signal_rows``  bearing samples ``(test_set, file, b1..b4)`` from ``lineitem``
* ``signal_long``  long-format samples ``(vec_id, channel, x)`` from ``embeddings``
* ``machine_rows`` machine-tool samples per experiment from ``events``
* ``lookup_metadata`` / ``ordinal_metadata`` experiment metadata from
  ``customer`` / ``nation``

All adapters are plain projections over a parquet scan, so filters and
column pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from condmon.functions.timestamps import published_timestamp
from condmon.schemas import PAYLOAD_SENSORS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _p2(c):
    return F.lpad(c.cast("string"), 2, "0")


def ntz_snapshot_name(ts) -> F.Column:
    """``yyyy.MM.dd.HH.mm.ss`` of a TIMESTAMP_NTZ from its fields.

    ``date_format`` would first cast to a session-zone timestamp; the field
    arithmetic is the same in every session time zone.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat_ws(
        ".",
        F.lpad(F.year(ts).cast("string"), 4, "0"),
        _p2(F.month(ts)),
        _p2(F.dayofmonth(ts)),
        _p2(F.hour(ts)),
        _p2(F.minute(ts)),
        _p2(F.second(ts)),
    )


def ntz_epoch_seconds(ts) -> F.Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ wall-clock value, without
    a time-zone conversion: whole days plus the time of day, summed exactly
    as a decimal and converted to double once."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(ts.cast("date")).cast("decimal(20,6)")
    tod = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (days * 86400 + tod.cast("decimal(20,6)") + F.date_part(F.lit("SECOND"), ts)).cast("double")


def signal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bearing samples: one row per sample, key ``(test_set, file)``."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_returnflag")
    test_set = (
        F.when(ts == "R", "1st_test").when(ts == "A", "2nd_test").when(ts == "N", "3rd_test")
    )
    return li.select(
        test_set.alias("test_set"),
        ntz_snapshot_name("l_shipdate").alias("file"),
        (F.col("l_quantity") - 25.5).alias("b1"),
        ((F.col("l_extendedprice") - 50000) / 1000).alias("b2"),
        F.round(F.col("l_discount") * 100 - 5).alias("b3"),
        F.round(F.col("l_tax") * 100 - 4).alias("b4"),
    )


def bearing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``signal_rows`` in the published bearing record shape."""
    rows = signal_rows(spark, sf_dir)
    return rows.select(
        F.lit("bearing").alias("dataset"),
        "test_set",
        published_timestamp("file").alias("timestamp"),
        "file",
        "b1",
        "b2",
        "b3",
        "b4",
    )


def signal_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long samples ``(vec_id, channel, pos, x)``: vector position ``pos``
    goes to channel ``b{pos % 4 + 1}``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.posexplode("embedding").alias("pos", "v")).select(
        "vec_id",
        F.concat(F.lit("b"), (F.col("pos") % 4 + 1).cast("string")).alias("channel"),
        "pos",
        F.col("v").cast("double").alias("x"),
    )


def snapshot_width(label) -> F.Column:
    """Stand-in for the column count of a snapshot file: 8, 4 or 3."""
    return F.when(label % 3 == 0, 8).when(label % 3 == 1, 4).otherwise(3)


def snapshot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshot files from ``embeddings``, one row per file: ``test_set``,
    ``file`` and ``value``, the tab-separated lines.

    All values of a vector are used, in lines of 8, 4 or 3 by ``label % 3``
    (the last of a 3-wide file is narrower).  Every 10th file ends with a line
    one value wider, every 7th has an empty line inside and every 11th ends
    with a line of one value.  The test set is ``vec_id % 3``, so every width
    meets every set.
    """
    emb = table(spark, sf_dir, "embeddings")
    width = snapshot_width(F.col("label"))
    # integer samples: floor(v * 10^4) prints the same in every engine
    vals = F.transform("embedding", lambda v: F.floor(v.cast("double") * 10000).cast("bigint").cast("string"))
    starts = F.sequence(F.lit(1), F.size("v"), F.col("w"))
    lines = F.transform(starts, lambda s: F.array_join(F.slice(F.col("v"), s, F.col("w")), "\t"))
    wider = F.array(F.array_join(F.slice(F.col("v"), F.lit(1), F.col("w") + 1), "\t"))
    lines_out = (
        F.when(F.col("vec_id") % 10 == 0, F.concat("l", wider))
        .when(F.col("vec_id") % 7 == 0, F.concat(F.slice("l", 1, 2), F.array(F.lit("")), F.slice("l", 3, 1 << 20)))
        .when(F.col("vec_id") % 11 == 0, F.concat("l", F.array(F.lit("5"))))
        .otherwise(F.col("l"))
    )
    test_set = (
        F.when(F.col("vec_id") % 3 == 0, "1st_test")
        .when(F.col("vec_id") % 3 == 1, "2nd_test")
        .otherwise("3rd_test")
    )
    return (
        emb.select("vec_id", width.alias("w"), vals.alias("v"))
        .withColumn("l", lines)
        .select(test_set.alias("test_set"), F.concat(F.lit("f"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("file"),
                F.array_join(lines_out, "\n").alias("value"))
    )


def _experiment_id(key, width: int = 6):
    return F.concat(F.lit("experiment_"), F.lpad(F.col(key).cast("string"), width, "0"))


# The stand-in's rule for a worn tool.
WORN_FEEDRATE = 13

# Event type -> machining stage of the machine-tool stand-in.
EVENT_STAGE = {
    "view": "Layer 1 Up",
    "click": "Layer 1 Down",
    "purchase": "Layer 2 Up",
    "signup": "Prep",
    "error": "End",
}


def machine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine-tool samples, one row per sample, keyed by ``experiment``.

    Columns: ``experiment, time``, the 18 payload sensors,
    ``M1_CURRENT_PROGRAM_NUMBER, Machining_Process``.  ``time`` is seconds
    since the epoch of the event's wall-clock time; sensor number ``i`` without
    a source of its own is ``value + i / 2``.
    """
    ev = table(spark, sf_dir, "events")
    own = {
        "X1_ActualPosition": F.col("value"),
        "Y1_ActualPosition": F.get_json_object("props", "$.k").cast("double") + 0.25,
        "M1_CURRENT_FEEDRATE": F.get_json_object("props", "$.k").cast("double"),
        "M1_sequence_number": F.col("event_id").cast("double"),
    }
    sensors = [
        own.get(c, F.col("value") + i / 2).alias(c) for i, c in enumerate(PAYLOAD_SENSORS)
    ]
    stage = F.lit(None).cast("string")
    for et, name in EVENT_STAGE.items():
        stage = F.when(F.col("event_type") == et, F.lit(name)).otherwise(stage)
    return ev.select(
        _experiment_id("user_id").alias("experiment"),
        ntz_epoch_seconds("ts").alias("time"),
        *sensors,
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("M1_CURRENT_PROGRAM_NUMBER"),
        stage.alias("Machining_Process"),
    )


def lookup_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment metadata in the ``train.csv`` shape, from ``customer``.

    Every customer has a row; the number of each tenth (``c_custkey % 10 = 3``)
    is negative, so its experiment stays without metadata.  The tool is worn
    where the feed rate reaches ``WORN_FEEDRATE``.  ``passed_visual_inspection``
    is NULL where machining was not finalized, as in the shipped metadata.
    """
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("int")
    finalized = F.when(F.col("c_nationkey") < 20, "yes").otherwise("no")
    return c.select(
        F.when(key % 10 == 3, -key).otherwise(key).alias("No"),
        F.lit("wax").alias("material"),
        F.col("c_nationkey").cast("double").alias("feedrate"),
        (F.col("c_acctbal") / 1000).alias("clamp_pressure"),
        F.when(F.col("c_nationkey") >= WORN_FEEDRATE, "worn").otherwise("unworn").alias("tool_condition"),
        finalized.alias("machining_finalized"),
        F.when(finalized == "no", F.lit(None).cast("string"))
        .when(F.col("c_acctbal") > 2000, "yes")
        .otherwise("no")
        .alias("passed_visual_inspection"),
    )


def ordinal_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short metadata list (25 rows) from ``nation``, in the same shape."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        (F.col("n_nationkey") + 1).cast("int").alias("No"),
        F.col("n_name").alias("material"),
        F.col("n_regionkey").cast("double").alias("feedrate"),
        ((F.col("n_nationkey") % 3) + 2.5).cast("double").alias("clamp_pressure"),
        F.when(F.col("n_nationkey") % 2 == 0, "unworn").otherwise("worn").alias("tool_condition"),
        F.lit("yes").alias("machining_finalized"),
        F.when(F.col("n_regionkey") == 0, F.lit(None).cast("string")).otherwise("yes").alias("passed_visual_inspection"),
    )
