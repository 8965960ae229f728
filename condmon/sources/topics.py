"""Topic records: publish (A5, A6, B19, B20), source (A4, A7) and parse
(B8-B12, 1.4 quarantine).

A topic record is ``(topic STRING, value STRING)`` with a JSON value.  The
same shape comes from a Kafka source (binary columns cast to string) or from
landed parquet files, so the parse side does not care where records live.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType

from condmon.schemas import (
    BEARING_DATASET,
    BEARING_RECORD,
    BEARING_TOPIC,
    PAYLOAD_SENSORS,
    TOOLWEAR_DATASET,
    TOOLWEAR_RECORD,
    TOOLWEAR_TOPIC,
    TOPIC_RECORD,
)

DATASET_CHOICES = ("bearing", "toolwear", "both")
CORRUPT_COL = "_corrupt_record"


# ---------------------------------------------------------------------------
# publish
# ---------------------------------------------------------------------------
def bearing_messages(records: DataFrame, topic: str = BEARING_TOPIC) -> DataFrame:
    """Bearing sample rows (``dataset, test_set, timestamp, file, b1..b4``)
    to topic records; NULL samples are left out of the JSON."""
    fields = [f.name for f in BEARING_RECORD.fields]
    return records.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*fields)).alias("value"))


def toolwear_messages(
    samples: DataFrame,
    experiment_col: str = "experiment",
    metadata_col: str | None = "metadata",
    topic: str = TOOLWEAR_TOPIC,
) -> DataFrame:
    """Machine samples to topic records.

    Every sample column except the experiment id goes into ``payload``;
    ``timestamp`` is ``payload.time`` when a ``time`` column exists, else
    NULL; ``metadata`` (a struct column, NULL when the experiment has none)
    is added only when present — ``to_json`` omits NULL fields, like a
    message built without the key.
    """
    payload_cols = [c for c in samples.columns if c not in (experiment_col, metadata_col)]
    ts = F.col("time").cast("double") if "time" in payload_cols else F.lit(None).cast("double")
    fields = [
        F.lit(TOOLWEAR_DATASET).alias("dataset"),
        F.col(experiment_col).alias("experiment"),
        ts.alias("timestamp"),
        F.struct(*payload_cols).alias("payload"),
    ]
    if metadata_col and metadata_col in samples.columns:
        fields.append(F.col(metadata_col).alias("metadata"))
    return samples.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*fields)).alias("value"))


def select_datasets(choice: str, bearing: DataFrame | None, toolwear: DataFrame | None) -> DataFrame | None:
    """``bearing`` / ``toolwear`` / ``both`` (case-insensitive) -> the union
    of the chosen message frames; anything else publishes nothing (B20)."""
    choice = (choice or "").lower()
    parts = []
    if choice in ("bearing", "both") and bearing is not None:
        parts.append(bearing)
    if choice in ("toolwear", "both") and toolwear is not None:
        parts.append(toolwear)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_messages(messages: DataFrame, path: str, mode: str = "append", by_topic: bool = False) -> None:
    """Land topic records as parquet files (the testable stand-in for a
    broker; ``write_kafka`` is the broker path), ``by_topic`` in a folder per
    topic, so that a route reads only its own.

    The known topics are written one after another: a writer that meets them
    mixed sorts all records of its task by topic, in memory.  Records of other
    topics go through that sort, into folders beside."""
    if not by_topic:
        messages.write.mode(mode).parquet(path)
        return
    known = (BEARING_TOPIC, TOOLWEAR_TOPIC)
    others = messages.where(F.col("topic").isNull() | ~F.col("topic").isin(*known))
    others.write.mode(mode).partitionBy("topic").parquet(path)
    for topic in known:
        one = messages.where(F.col("topic") == topic).drop("topic")
        one.write.mode("append").parquet(f"{path}/topic={topic}")


def land_in_order(messages: DataFrame, path: str, order: Sequence, files: int) -> None:
    """Land topic records for an ordered replay (A7): ``files`` consecutive
    ranges of ``order`` (e.g. test set and file name), appended one after
    another, so that the stream, which takes files by modification time, meets
    the names in order.  The records are sorted and written once; each file of
    that copy is then one append."""
    from condmon.session import work_dir

    spark = messages.sparkSession
    staged = work_dir(spark, "ordered")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = messages.repartitionByRange(files, *cols).sortWithinPartitions(*cols)
    ranged.withColumn("_part", F.spark_partition_id()).write.partitionBy("_part").parquet(staged)
    schema = StructType([*messages.schema.fields, StructField("_part", IntegerType())])
    copy = spark.read.schema(schema).parquet(staged)
    for part in range(files):
        one = copy.where(F.col("_part") == part).coalesce(1).sortWithinPartitions(*cols)
        one.select("topic", "value").write.mode("append").parquet(path)


def write_kafka(messages: DataFrame, bootstrap: str) -> None:
    """Publish to a broker; needs the Kafka connector on the classpath."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()


# ---------------------------------------------------------------------------
# source
# ---------------------------------------------------------------------------
def topic_stream(
    spark: SparkSession,
    source: str = "files",
    path: str | None = None,
    topics: Sequence[str] = (BEARING_TOPIC, TOOLWEAR_TOPIC),
    bootstrap: str | None = None,
    max_files_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """Streaming ``(topic, value)`` records.

    ``source="kafka"`` subscribes to ``topics`` from ``starting_offsets``
    (needs the Kafka connector); ``source="files"`` reads landed parquet
    records under ``path``, ``max_files_per_trigger`` files per micro-batch
    (files are taken in modification-time order; ``land_in_order`` writes
    them so that this is the order of the records' names).
    """
    if source == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets)
            .load()
        )
    elif source == "files":
        reader = spark.readStream.schema(TOPIC_RECORD)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        raw = reader.parquet(path)
    else:
        raise ValueError("source must be 'kafka' or 'files'")
    return raw.selectExpr("CAST(topic AS STRING) AS topic", "CAST(value AS STRING) AS value")


# ---------------------------------------------------------------------------
# parse
# ---------------------------------------------------------------------------
def _with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType())])


def _without_nan(value: Column, kind: DataType) -> Column:
    """NULL for the bare ``NaN`` a JSON writer leaves: NaN in a number, the
    quoted text in a string; structs field by field."""
    if isinstance(kind, StructType):
        fields = [_without_nan(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, StringType):
        return F.when(value.isin("NaN", '"NaN"'), F.lit(None).cast("string")).otherwise(value)
    if isinstance(kind, DoubleType):
        return F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value)
    return value


def parse_records(records: DataFrame, topic: str, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    """Route one topic (B9) and expand its JSON.

    PERMISSIVE parsing: a malformed value gives an all-NULL row, a field of
    the wrong type only that field NULL, a bare ``NaN`` NULL.  With ``keep_corrupt`` the raw text
    of such records is kept in ``_corrupt_record``.
    """
    sch = _with_corrupt(schema) if keep_corrupt else schema
    opts = {"columnNameOfCorruptRecord": CORRUPT_COL} if keep_corrupt else {}
    parsed = records.where(F.col("topic") == topic).select(F.from_json("value", sch, opts).alias("data"))
    return parsed.select(*[_without_nan(F.col(f"data.{f.name}"), f.dataType).alias(f.name) for f in sch.fields])


def parse_bearing(records: DataFrame) -> DataFrame:
    return parse_records(records, BEARING_TOPIC, BEARING_RECORD)


def parse_toolwear(records: DataFrame) -> DataFrame:
    return parse_records(records, TOOLWEAR_TOPIC, TOOLWEAR_RECORD)


def tag_quarantine(records: DataFrame, topic: str, schema: StructType) -> DataFrame:
    """One pass: ``value``, the parsed ``data`` struct and ``quarantined``
    (malformed JSON or a wrongly typed field), for the records of ``topic``."""
    parsed = records.where(F.col("topic") == topic).select(
        "value", F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT_COL}).alias("data")
    )
    clean = [_without_nan(F.col(f"data.{f.name}"), f.dataType).alias(f.name) for f in schema.fields]
    return parsed.select(
        "value", F.struct(*clean).alias("data"), F.col(f"data.{CORRUPT_COL}").isNotNull().alias("quarantined")
    )


def split_quarantine(records: DataFrame, topic: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Parsed good rows, and the quarantined raw values that did not parse.

    Two frames over the same records; to parse once and write both, use
    ``tag_quarantine`` and filter its output.
    """
    tagged = tag_quarantine(records, topic, schema)
    good = tagged.where(~F.col("quarantined")).select("data.*")
    quarantine = tagged.where(F.col("quarantined")).select("value")
    return good, quarantine


def flatten_toolwear(parsed: DataFrame) -> DataFrame:
    """24 flat columns: ids, metadata (``tool_condition`` ->
    ``tool_condition_true``) and the 18 payload sensors (B12)."""
    cols: list[Column] = [
        F.col("experiment"),
        F.col("timestamp"),
        F.col("dataset"),
        F.col("metadata.clamp_pressure").alias("clamp_pressure"),
        F.col("metadata.feedrate").alias("feedrate"),
        F.col("metadata.tool_condition").alias("tool_condition_true"),
    ]
    cols += [F.col(f"payload.{c}").alias(c) for c in PAYLOAD_SENSORS]
    return parsed.select(*cols)


__all__ = [
    "BEARING_DATASET",
    "bearing_messages",
    "toolwear_messages",
    "select_datasets",
    "write_messages",
    "write_kafka",
    "topic_stream",
    "parse_records",
    "parse_bearing",
    "parse_toolwear",
    "split_quarantine",
    "tag_quarantine",
    "flatten_toolwear",
]
