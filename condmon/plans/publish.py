"""Publishing job: raw files -> topic records (SURVEY 3.1/3.2 "publish").

* bearing: snapshot files under ``bearing_root`` with the by-test width
  guard (B1), the a-channels as b1..b4, ``timestamp`` = the published text
  of the file name (I1);
* tool wear: every experiment file under ``toolwear_root`` with all its
  columns as ``payload``, metadata attached by the exact key rule (C1) —
  with the shipped metadata (key column ``No``) nothing matches and
  records go out without ``metadata``, as the original producer does.

Records are written in parallel; order across files is not kept (the
consumer groups by file, so results do not depend on it).  For a replay
in name order, land one folder per test set and stream it with
``maxFilesPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from condmon.functions.timestamps import published_timestamp
from condmon.operators.joins import lookup_join
from condmon.schemas import BEARING_DATASET
from condmon.sources import topics as TP
from condmon.sources.bearing_files import read_snapshot_files
from condmon.sources.experiment_files import read_experiments, read_metadata


def bearing_records_from_files(spark: SparkSession, root: str) -> DataFrame:
    samples = read_snapshot_files(spark, root, policy="by_test", ignore_corrupt=True)
    return samples.select(
        F.lit(BEARING_DATASET).alias("dataset"),
        "test_set",
        published_timestamp("file").alias("timestamp"),
        "file",
        "b1", "b2", "b3", "b4",
    )


def toolwear_samples_from_files(spark: SparkSession, root: str, key_rule: str = "exact") -> DataFrame:
    return lookup_join(read_experiments(spark, root).drop("seq"), read_metadata(spark, root), "experiment", key_rule=key_rule)


def messages(
    spark: SparkSession,
    datasets: str = "both",
    bearing_root: str | None = None,
    toolwear_root: str | None = None,
    key_rule: str = "exact",
) -> DataFrame | None:
    bearing = TP.bearing_messages(bearing_records_from_files(spark, bearing_root)) if bearing_root else None
    tool = TP.toolwear_messages(toolwear_samples_from_files(spark, toolwear_root, key_rule)) if toolwear_root else None
    return TP.select_datasets(datasets, bearing, tool)


def publish(
    spark: SparkSession,
    datasets: str = "both",
    bearing_root: str | None = None,
    toolwear_root: str | None = None,
    path: str | None = None,
    bootstrap: str | None = None,
    key_rule: str = "exact",
) -> bool:
    """Write the records to ``path`` (parquet) or a broker; False when the
    dataset choice selects nothing."""
    msgs = messages(spark, datasets, bearing_root, toolwear_root, key_rule)
    if msgs is None:
        return False
    if bootstrap:
        TP.write_kafka(msgs, bootstrap)
    else:
        TP.write_messages(msgs, path)
    return True
