"""Numbered lines of text files that Spark may read in many splits.

A file read whole is one row, which ends at 2 GB; read line by line, its lines
lose their numbers.  ``scan_lines`` reads the files line by line, each line with
its file, the start of its split (``_metadata.file_block_start``) and an
increasing position in its task; ``stage_lines`` writes them once.  Rows
of a split are consecutive in a task, so ``blocks_of`` needs one row per split,
taken by an ordinary aggregate: its first position and its number of lines
give every line of the split its number in the file, and the split that begins
the file knows the file's first line.  Nothing but this small table is joined
back (AQE broadcasts it while it measures small), and no line is shuffled.

The written copy is what makes positions final: splits of a second scan need
not be those of the first.  ``scan_lines`` alone serves what reads the lines
once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from condmon.session import stage


def scan_lines(
    spark: SparkSession,
    root: str,
    recursive: bool = False,
    ignore_corrupt: bool = False,
    glob: str | None = None,
    keep: Sequence[str] = (),
    empty: bool = False,
) -> DataFrame:
    """``path, block, pos, value`` per line of the files under ``root``, and
    the partition folders named in ``keep`` (as text).  Empty lines are left
    out, before positions are given, unless ``empty``."""
    reader = spark.read.option("ignoreCorruptFiles", ignore_corrupt)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(root)
    return (text if empty else text.where(F.col("value") != "")).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
        *[F.col(c).cast("string").alias(c) for c in keep],
    )


#: Splits of a scan that one task takes.  A split holds up to 128 MB or, by
#: Spark's cost of opening a file, 32 small files.
SPLITS_PER_TASK = 8


def packed(lines: DataFrame) -> DataFrame:
    """Scanned ``lines`` in fewer tasks, without a shuffle, where there are
    many splits: many small files else make a task, and a written file, of
    each 32 of them.  A split's lines stay together in their order."""
    splits = lines.rdd.getNumPartitions()
    tasks = max(-(-splits // SPLITS_PER_TASK), min(splits, 2 * lines.sparkSession.sparkContext.defaultParallelism))
    return lines.coalesce(tasks) if tasks < splits else lines


def stage_lines(lines: DataFrame) -> DataFrame:
    """The lines, written once to the shared folder."""
    return stage(packed(lines), "lines")


def blocks_of(lines: DataFrame, **aggs: Column) -> DataFrame:
    """``path, block, first, before, head`` per split that holds a line:
    ``first`` position, lines of the file ``before`` the split, and the
    file's first line; further ``aggs`` are taken per split."""
    per = lines.groupBy("path", "block").agg(
        F.min("pos").alias("first"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by("value", "pos").alias("_head"),
        *[c.alias(n) for n, c in aggs.items()],
    )
    file = Window.partitionBy("path")
    order = file.orderBy("block")
    return per.select(
        "path",
        "block",
        "first",
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.first("_head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("head"),
        *aggs,
    )


def numbered(lines: DataFrame, blocks: DataFrame, *cols: str) -> DataFrame:
    """Staged ``lines`` of the splits in ``blocks`` with ``no``, the 0-based
    number in the file, and the named columns of ``blocks``."""
    side = blocks.select("path", "block", "first", "before", *cols)
    rows = lines.join(side, ["path", "block"])
    return rows.withColumn("no", F.col("before") + F.col("pos") - F.col("first")).drop("first", "before", "pos", "block")


def file_name(path="path") -> Column:
    """The last part of a path (URI-encoded in file metadata) as text."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def folder_name(path="path") -> Column:
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -2), F.lit("+"), F.lit("%2B")))


def _indexed(files: DataFrame):
    """The file index of a scan, left in the JVM."""
    return files._jdf.inputFiles()


def count_files(spark: SparkSession, root: str, recursive: bool = False) -> int:
    """How many files ``list_files`` would give, without listing them."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return len(_indexed(reader.load(root)))


def list_files(spark: SparkSession, root: str, recursive: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``path, size`` of every file under ``root``, readable or not, and the
    folder values ``keep`` (``name=value``): contents are not touched.  Scans
    leave out files of no bytes, so the names come from the file index, which
    the driver holds for any scan, and sizes from a scan of the metadata."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    files = reader.load(root)
    sized = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    # the index writes a local path with an empty authority, the metadata without
    to_json = spark.sparkContext._jvm.com.fasterxml.jackson.databind.ObjectMapper()
    paths = json.loads(to_json.writeValueAsString(_indexed(files)))  # one call, not one per file
    names = spark.createDataFrame([(p,) for p in paths], "path string")
    names = names.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    out = names.join(sized, "path", "left").fillna(0, ["size"])
    return out.withColumns({c: F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)", 1)) for c in keep})
