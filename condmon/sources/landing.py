"""Landing of files under their true names.

Spark's writers name their files themselves.  On a file system that every
machine mounts, the tasks of ``land_files`` write each file under its own name
and set its modification time; nothing is done per file by the driver.  On
other stores one job writes one folder per file and one sorted stream of lines
per writer, and the driver then gives every file its name: one rename per file,
as at the commit of a job.  No content passes through the driver.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.session import stage, work_dir

#: Milliseconds between the modification times of files landed in order.
TIME_STEP = 10

#: The folder name by which Spark's writers replace a missing or empty value.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def land_files(rows: DataFrame, root: str, order: Sequence[str] = ("no",), in_name_order: bool = False) -> int:
    """Write rows ``folder, name, line`` as text files ``<root>/<folder>/<name>``
    with their lines by ``order``; returns the number of files.  An empty
    folder name stands for ``root`` itself.  With ``in_name_order`` the files'
    modification times follow ``(folder, name)``, which is the order in which
    a file stream takes them."""
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        return _land_in_tasks(rows, hadoop.Path(root).toUri().getPath(), order, in_name_order)
    staged = work_dir(spark, "landing")
    folder = F.concat(F.lit("f"), "folder").alias("_folder")  # an empty name is no partition value
    lines = rows.select(folder, F.col("name").alias("_name"), F.col("line").alias("value"), *order)
    lines = lines.repartition("_folder", "_name").sortWithinPartitions("_folder", "_name", *order)
    lines.select("_folder", "_name", "value").write.partitionBy("_folder", "_name").text(staged)

    found = []
    for status in fs.globStatus(hadoop.Path(f"{staged}/_folder=*/_name=*/part-*")):
        path = status.getPath()
        name = unquote(path.getParent().getName().split("=", 1)[1])
        above = unquote(path.getParent().getParent().getName().split("=", 1)[1])[1:]
        found.append((above, name, path))
    found.sort(key=lambda x: x[:2])
    if len({x[:2] for x in found}) != len(found):
        raise RuntimeError("a file was written in several parts")
    for above in {x[0] for x in found}:
        fs.mkdirs(hadoop.Path(f"{root}/{above}" if above else root))
    begin = int(spark.sparkContext._jvm.java.lang.System.currentTimeMillis()) - TIME_STEP * len(found)
    for k, (above, name, path) in enumerate(found):
        to = hadoop.Path(f"{root}/{above}/{name}" if above else f"{root}/{name}")
        if not fs.rename(path, to):
            raise OSError(f"could not name {to}")
        if in_name_order:
            fs.setTimes(to, begin + TIME_STEP * k, -1)
    return len(found)


def _land_in_tasks(rows: DataFrame, root: str, order: Sequence[str], in_name_order: bool) -> int:
    """``land_files`` below a mounted folder.  The rows lie in ranges of
    ``(folder, name)``, so a file is written by one task from one sorted run,
    first under a hidden name; a second pass over one row per file gives the
    modification times, from the number of files in the ranges before."""
    spark = rows.sparkSession
    folder = F.coalesce("folder", F.lit(NO_NAME[1:]))
    name = F.when(F.col("name") != "", F.col("name")).otherwise(NO_NAME)
    lines = rows.select(folder.alias("_folder"), name.alias("_name"), F.col("line").cast("binary").alias("value"), *order)
    # by number of tasks, not of bytes: the cost is one of files
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = lines.repartitionByRange(parts, "_folder", "_name").sortWithinPartitions("_folder", "_name", *order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, temp = task.partitionId(), f".landing-{task.taskAttemptId()}"
        at, out, nth, done = None, None, 0, []

        def finish() -> None:
            nonlocal nth
            out.close()
            os.replace(os.path.join(root, at[0], temp), os.path.join(root, *at))
            done.append({"part": part, "nth": nth, "folder": at[0], "name": at[1]})
            nth += 1

        for batch in batches:
            for folder, name, value in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if (folder, name) != at:
                    if at is not None:
                        finish()
                    if at is None or folder != at[0]:
                        os.makedirs(os.path.join(root, folder), exist_ok=True)
                    at, out = (folder, name), open(os.path.join(root, folder, temp), "wb")
                out.write((value or b"") + b"\n")
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if at is not None:
            finish()
            yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("folder", pa.string()), ("name", pa.string())])
    lines = lines.select("_folder", "_name", "value")
    files = stage(lines.mapInArrow(write, "part int, nth bigint, folder string, name string"), "landed")
    counts = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if in_name_order:
        begin = int(spark.sparkContext._jvm.java.lang.System.currentTimeMillis()) - TIME_STEP * total
        first, upto = {}, 0
        for part in sorted(counts):
            first[part], upto = begin + TIME_STEP * upto, upto + counts[part]

        def set_times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, nth, folder, name in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                    ns = (first[part] + TIME_STEP * nth) * 1_000_000
                    os.utime(os.path.join(root, folder, name), ns=(ns, ns))
                yield batch.select(["nth"])

        files.mapInArrow(set_times, "nth bigint").count()
    return total
