"""Bearing snapshot sources.

A snapshot is a headerless tab-separated file named by its time
(``YYYY.MM.DD.HH.MM.SS``) inside a test-set folder; 8 columns (two axes per
bearing) in the first test, 4 in the others.  Channels b1..b4 are columns
0,2,4,6 of an 8-wide file and 0..3 of a 4-wide one.

Two width guards exist and differ:

* ``by_test``  (publishing): test 1 needs 8 columns, the others 4, else the
  whole file is skipped;
* ``by_width`` (training): 8 -> a-channels, 4 -> all, anything else skipped.

The width of a file is the width of its first line; a later line that is
wider makes the file unreadable (skipped whole), a narrower one is padded
with NULL samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from condmon.functions.features import nan_to_null
from condmon.schemas import CHANNELS, TEST_SET_WIDTH
from condmon.session import stage
from condmon.sources import lines as LN

POLICIES = ("by_width", "by_test")


def line_parts(line) -> Column:
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, "\t")


def keep_by_width(width) -> Column:
    width = F.col(width) if isinstance(width, str) else width
    return width.isin(8, 4)


def keep_by_test(test_set, width) -> Column:
    test_set = F.col(test_set) if isinstance(test_set, str) else test_set
    width = F.col(width) if isinstance(width, str) else width
    expected = F.lit(None).cast("int")
    for ts, w in TEST_SET_WIDTH.items():
        expected = F.when(test_set == ts, F.lit(w)).otherwise(expected)
    # sets other than the first expect 4 columns
    expected = F.coalesce(expected, F.lit(4))
    return width == expected


def channel_values(parts, width) -> list[Column]:
    """b1..b4 from split parts by the file width: 8 -> 0,2,4,6; 4 -> 0..3.

    Cells are ``try_cast`` to double (a non-numeric cell is NULL) and NaN
    becomes NULL.
    """
    parts = F.col(parts) if isinstance(parts, str) else parts
    width = F.col(width) if isinstance(width, str) else width
    out = []
    for i, ch in enumerate(CHANNELS):
        cell = (
            F.when(width == 8, F.try_element_at(parts, F.lit(2 * i + 1)))
            .when(width == 4, F.try_element_at(parts, F.lit(i + 1)))
        )
        out.append(nan_to_null(F.trim(cell).try_cast("double")).alias(ch))
    return out


def parse_lines(df: DataFrame, line: str = "line", test_set: str = "test_set", policy: str = "by_width") -> DataFrame:
    """Per-line guard and channel selection; every line is its own file.

    Adds ``width``, ``keep_by_width``, ``keep_by_test`` and b1..b4 (taken
    by width, NULL on lines the chosen ``policy`` skips).
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    parts = line_parts(line)
    width = F.size(parts)
    kept_w = keep_by_width(width)
    kept_t = keep_by_test(test_set, width)
    kept = kept_w if policy == "by_width" else kept_t
    cols = channel_values(parts, width)
    return df.select(
        "*",
        width.alias("width"),
        kept_w.alias("keep_by_width"),
        kept_t.alias("keep_by_test"),
        *[F.when(kept, c).alias(ch) for c, ch in zip(cols, CHANNELS)],
    )


def write_snapshot_files(samples: DataFrame, root: str, channels=CHANNELS) -> None:
    """Land sample rows as snapshot files: one tab-separated file per
    ``(test_set, file)`` under ``test_set=<set>/file=<name>/``.

    A snapshot is one file, so its rows go to one writer task
    (``repartition`` on the snapshot key); line order inside a file is not
    kept.
    """
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in channels])
    (
        samples.select("test_set", "file", line.alias("value"))
        .repartition("test_set", "file")
        .write.mode("overwrite")
        .partitionBy("test_set", "file")
        .text(root)
    )


LAYOUTS = ("folders", "partitioned")


def _layout(layout: str) -> list[str]:
    """The partition folders that a layout's files lie in."""
    if layout not in LAYOUTS:
        raise ValueError("layout must be 'folders' or 'partitioned'")
    return ["test_set", "file"] if layout == "partitioned" else []


def _named(df: DataFrame, layout: str) -> DataFrame:
    """With ``test_set`` and ``file`` of the column ``path``."""
    if layout == "partitioned":
        return df
    return df.withColumns({"test_set": LN.folder_name(), "file": LN.file_name()})


def snapshot_stream(spark: SparkSession, root: str, files_per_trigger: int, ignore_corrupt: bool = True) -> DataFrame:
    """Streaming ``test_set, file, value`` of raw snapshot files read whole,
    ``files_per_trigger`` per micro-batch in the order of their modification
    times (A7); ``parse_snapshot_texts`` turns them into samples."""
    files = (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", ignore_corrupt)
        .text(root, wholetext=True)
    )
    return files.select(
        LN.folder_name("_metadata.file_path").alias("test_set"), LN.file_name("_metadata.file_path").alias("file"), "value"
    )


def _file_lines(value: str = "value") -> Column:
    """The lines of a file's text; empty lines are skipped, as pandas does."""
    return F.filter(F.split(value, r"\r?\n"), lambda ln: ln != "")


def _line_widths(lines: Column) -> Column:
    return F.transform(lines, lambda ln: F.size(F.split(ln, "\t")))


def parse_snapshot_texts(files: DataFrame, policy: str = "by_width", on_wide: str = "skip") -> DataFrame:
    """``test_set, file, seq, b1..b4`` of the whole files ``test_set, file,
    value`` that the ``policy`` keeps; ``seq`` is the 0-based line number.

    A line wider than the first makes a file unreadable: ``on_wide="skip"``
    leaves the file out (publishing), ``"fail"`` stops with an error
    (training).  Everything is computed inside the file's row (no shuffle).
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if on_wide not in ("skip", "fail"):
        raise ValueError("on_wide must be 'skip' or 'fail'")
    widths = _line_widths(F.col("_lines"))
    rows = files.withColumn("_lines", _file_lines()).where(F.size("_lines") > 0)
    rows = rows.select("test_set", "file", "_lines", F.try_element_at(widths, F.lit(1)).alias("width"), F.array_max(widths).alias("_max"))
    wide = F.col("_max") > F.col("width")
    if on_wide == "skip":
        rows = rows.where(~wide)
    else:
        message = F.concat(F.lit("line wider than the first in "), "test_set", F.lit("/"), "file")
        rows = rows.withColumn("width", F.when(wide, F.raise_error(message).cast("int")).otherwise(F.col("width")))
    rows = rows.where(keep_by_width("width") if policy == "by_width" else keep_by_test("test_set", "width"))
    samples = rows.select("test_set", "file", "width", F.posexplode("_lines").alias("seq", "line"))
    return samples.select("test_set", "file", "seq", *channel_values(line_parts("line"), "width"))


def _scan(spark: SparkSession, root: str, recursive: bool, ignore_corrupt: bool, layout: str) -> tuple[DataFrame, DataFrame]:
    """The written lines of the files and the table of their splits, with what
    the guards look at."""
    keep = _layout(layout)
    raw = LN.scan_lines(spark, root, recursive and layout == "folders", ignore_corrupt, keep=keep)
    lines = LN.stage_lines(raw)
    blocks = LN.blocks_of(lines, widest=F.max(F.size(line_parts("value"))), **{c: F.first(c) for c in keep})
    blocks = blocks.withColumn("widest", F.max("widest").over(Window.partitionBy("path")))
    return lines.drop(*keep), _named(blocks.withColumn("width", F.size(line_parts("head"))), layout)


def scan_snapshot_files(
    spark: SparkSession, root: str, recursive: bool = True, ignore_corrupt: bool = False, layout: str = "folders"
) -> tuple[DataFrame, DataFrame]:
    """One scan of the files for several ``read_snapshot_files(scanned=…)``:
    the lines and the table of splits, both written once."""
    lines, blocks = _scan(spark, root, recursive, ignore_corrupt, layout)
    return lines, stage(blocks, "splits")


def read_snapshot_files(
    spark: SparkSession,
    root: str,
    policy: str = "by_width",
    recursive: bool = True,
    ignore_corrupt: bool = False,
    layout: str = "folders",
    on_wide: str = "skip",
    scanned: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Scan a folder tree of snapshot files into sample rows (A1).

    Returns ``test_set, file, seq, b1..b4`` for the files the ``policy``
    keeps (see ``parse_snapshot_texts``).  ``test_set`` is the name of the
    file's folder, or with ``layout="partitioned"`` comes from the
    ``test_set=…/file=…`` folders of the writers above.  Unreadable files are
    an error unless ``ignore_corrupt`` (publishing) skips them.  To read the
    same files under several policies, scan them once by
    ``scan_snapshot_files`` and pass it as ``scanned``.

    Lines are read in splits of any size and numbered from a table of one row
    per split (``sources.lines``), so a single file of any length spreads over
    all tasks and no row holds a file; the guards drop whole files in that
    table, before its join with the lines.  Empty lines are skipped.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if on_wide not in ("skip", "fail"):
        raise ValueError("on_wide must be 'skip' or 'fail'")
    lines, blocks = scanned or _scan(spark, root, recursive, ignore_corrupt, layout)
    wide = F.col("widest") > F.col("width")
    if on_wide == "skip":
        blocks = blocks.where(~wide)
    else:
        message = F.concat(F.lit("line wider than the first in "), "test_set", F.lit("/"), "file")
        blocks = blocks.withColumn("width", F.when(wide, F.raise_error(message).cast("int")).otherwise(F.col("width")))
    blocks = blocks.where(keep_by_width("width") if policy == "by_width" else keep_by_test("test_set", "width"))
    rows = LN.numbered(lines, blocks, "width", "test_set", "file")
    return rows.select("test_set", "file", F.col("no").alias("seq"), *channel_values(line_parts("value"), "width"))


def snapshot_file_report(spark: SparkSession, root: str, recursive: bool = True, layout: str = "folders") -> DataFrame:
    """One row per file under ``root``, readable or not, with what the guards
    see (B3): ``size`` in bytes, first-line width, widest line, number of lines
    that are not empty, non-numeric cells, both guard verdicts and the reason a
    file would be skipped (NULL when kept by width).

    The listing of all files meets the files that gave lines in one scan that
    skips what cannot be read: a file of some size without any line, not even
    an empty one, is ``unreadable``.  A file that breaks off midway counts by
    the lines before.
    """
    keep = _layout(layout)
    deep = recursive and layout == "folders"
    files = LN.list_files(spark, root, deep, keep)
    lines = LN.packed(LN.scan_lines(spark, root, deep, ignore_corrupt=True, empty=True))
    cells = line_parts("value")
    width, full = F.size(cells), F.col("value") != ""
    bad = F.size(F.filter(cells, lambda c: F.trim(c).try_cast("double").isNull()))
    per = lines.groupBy("path", "block").agg(
        F.min_by(F.when(full, width), F.when(full, F.col("pos"))).alias("_first"),
        F.max(F.when(full, width)).alias("_max"),
        F.count_if(full).alias("_lines"),
        F.sum(F.when(full, bad)).alias("_bad"),
    )
    seen = per.groupBy("path").agg(
        F.min_by("_first", F.when(F.col("_first").isNotNull(), F.col("block"))).alias("width"),
        F.max("_max").alias("max_width"),
        F.sum("_lines").alias("lines"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("non_numeric_cells"),
    )
    rep = _named(files.join(seen, "path", "left"), layout).withColumn("_read", F.col("lines").isNotNull())
    rep = rep.fillna(0, ["lines", "non_numeric_cells"])
    return rep.select(
        "test_set",
        "file",
        "size",
        "width",
        "max_width",
        "lines",
        "non_numeric_cells",
        F.coalesce(keep_by_width("width"), F.lit(False)).alias("keep_by_width"),
        F.coalesce(keep_by_test("test_set", "width"), F.lit(False)).alias("keep_by_test"),
        F.when(~F.col("_read") & (F.col("size") > 0), "unreadable")
        .when(F.col("lines") == 0, "empty")
        .when(F.col("max_width") > F.col("width"), "line wider than the first")
        .when(~keep_by_width("width"), "unexpected width")
        .when(F.col("non_numeric_cells") > 0, "non-numeric cells")
        .alias("reason"),
    )
