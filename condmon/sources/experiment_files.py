"""Machine-tool experiment sources.

A folder holds ``experiment_NN.csv`` series (header row, one row per
100 ms sample) and the metadata file ``train.csv`` (one row per
experiment).  All experiment files are read in one multi-file scan, their
columns by header name; the experiment id is the file stem.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from condmon.functions.timestamps import strip_extension
from condmon.schemas import EXPERIMENT_METADATA
from condmon.session import materialize
from condmon.sources import lines as LN

METADATA_FILE = "train.csv"

# The documented columns of an experiment file.
_AXIS_FIELDS = [
    "ActualPosition", "ActualVelocity", "ActualAcceleration", "CommandPosition", "CommandVelocity",
    "CommandAcceleration", "CurrentFeedback", "DCBusVoltage", "OutputCurrent", "OutputVoltage",
]
EXPERIMENT_COLUMNS = (
    [f"X1_{f}" for f in _AXIS_FIELDS] + ["X1_OutputPower"]
    + [f"Y1_{f}" for f in _AXIS_FIELDS] + ["Y1_OutputPower"]
    + [f"Z1_{f}" for f in _AXIS_FIELDS]
    + [f"S1_{f}" for f in _AXIS_FIELDS] + ["S1_OutputPower", "S1_SystemInertia"]
    + ["M1_CURRENT_PROGRAM_NUMBER", "M1_sequence_number", "M1_CURRENT_FEEDRATE"]
)
EXPERIMENT_SCHEMA = StructType(
    [StructField(c, DoubleType()) for c in EXPERIMENT_COLUMNS] + [StructField("Machining_Process", StringType())]
)


def is_experiment_file(name) -> F.Column:
    """``.csv`` (any case) and not the metadata file."""
    low = F.lower(F.col(name) if isinstance(name, str) else name)
    return low.endswith(".csv") & (low != METADATA_FILE)


def read_experiments(
    spark: SparkSession, root: str, schema: StructType = EXPERIMENT_SCHEMA, layout: str = "files"
) -> DataFrame:
    """All experiment files under ``root`` as one DataFrame (A2, H2):
    ``experiment`` (file stem, B6), ``seq`` (0-based sample number in file
    order, L3), then every column that some file's header names — the known
    ones in schema order, then ``time`` and other columns (as doubles) by name.

    Columns are found by header name in each file: their order may differ, and
    a file without a column has NULL there.  A column that no header names is
    left out.  ``layout="partitioned"`` reads ``stem=<experiment>/`` folders of
    one text file each instead of ``<experiment>.csv``.

    Lines are read in splits of any size and numbered from a table of one row
    per split, which also carries the number of the file's header
    (``sources.lines``); no row holds a file.  A line is parsed once, by Spark's
    own CSV rules, into cells, and the header says which cell a column is.
    """
    if layout == "partitioned":
        keep, raw = ["stem"], LN.scan_lines(spark, root, keep=["stem"])
        name = F.concat("stem", F.lit(".csv"))
    elif layout == "files":
        keep, raw = [], LN.scan_lines(spark, root, glob="*.[cC][sS][vV]")
        name = LN.file_name()
    else:
        raise ValueError("layout must be 'files' or 'partitioned'")
    lines = LN.stage_lines(raw.where(is_experiment_file(name)))
    blocks = LN.blocks_of(lines, **{c: F.first(c) for c in keep})
    blocks = materialize(blocks.withColumn("experiment", strip_extension(name)))
    headers = sorted(r[0] for r in blocks.select("head").distinct().collect())  # a handful
    number = F.lit(None).cast("int")
    for i, header in enumerate(headers):
        number = F.when(F.col("head") == header, i).otherwise(number)
    rows = LN.numbered(lines.drop(*keep), blocks.withColumn("header", number), "experiment", "header").where("no > 0")
    seq = (F.col("no") - 1).alias("seq")
    if not headers:
        return rows.select("experiment", seq)
    names = [[c.strip() for c in next(csv.reader([header]))] for header in headers]
    # the first of several columns of one name counts, as a nameless one does not
    at = [{c: row.index(c) for c in row if c} for row in names]
    cells = ", ".join(f"c{i} string" for i in range(max(map(len, names))))
    known = {f.name: f.dataType for f in schema.fields}
    found = {c for row in at for c in row}
    columns = [c for c in known if c in found] + sorted(found - set(known))
    parsed = rows.select("experiment", seq, "header", F.from_csv("value", cells).alias("_c"))

    def column(name: str):
        cell = F.lit(None).cast("string")
        for i, row in enumerate(at):
            if name in row:
                cell = F.when(F.col("header") == i, F.col(f"_c.c{row[name]}")).otherwise(cell)
        kind = known.get(name, DoubleType())
        return (cell if isinstance(kind, StringType) else cell.try_cast(kind)).alias(name)

    return parsed.select("experiment", "seq", *map(column, columns))


def read_metadata(spark: SparkSession, root: str, schema: StructType = EXPERIMENT_METADATA) -> DataFrame:
    """The metadata file by header name; blank cells are NULL (A3).  Known
    columns come first, in schema order, other ones follow as text."""
    text = spark.read.option("header", True).csv(f"{root.rstrip('/')}/{METADATA_FILE}")
    known = {f.name: f.dataType for f in schema.fields}
    cols = [F.col(f"`{c}`").try_cast(t).alias(c) for c, t in known.items() if c in text.columns]
    return text.select(*cols, *[f"`{c}`" for c in text.columns if c not in known])
