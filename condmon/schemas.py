"""Record schemas and column lists.

Everything in this module is a fixed value that must equal the published
record format and the model feature lists, so it is written out plainly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Topic names, dataset tags, test-set folders, failing bearings.
# ---------------------------------------------------------------------------
BEARING_TOPIC = "bearing_raw"
TOOLWEAR_TOPIC = "toolwear_raw"
BEARING_DATASET = "bearing"
TOOLWEAR_DATASET = "toolwear"

TEST_SETS = ("1st_test", "2nd_test", "3rd_test")
# width each test set must have under the by-test guard (B1)
TEST_SET_WIDTH = {"1st_test": 8, "2nd_test": 4, "3rd_test": 4}
# failing bearing per test set (H3)
FAILING_BEARING = {"1st_test": "b3_", "2nd_test": "b4_", "3rd_test": "b3_"}

CHANNELS = ("b1", "b2", "b3", "b4")

# Batch feature names, in the order of the feature table.
BATCH_FEATURES = (
    "mean",
    "std",
    "skew",
    "kurtosis",
    "entropy",
    "rms",
    "max",
    "p2p",
    "crest",
    "clearance",
    "shape",
    "impulse",
)
# Features computed by the streaming aggregation.
STREAM_FEATURES = ("max", "p2p", "rms")
# Features kept for the RUL model.
RUL_FEATURES = ("max", "p2p", "rms")

ENTROPY_BINS = 500

# File-name timestamp format of the bearing snapshots.
SNAPSHOT_TS_FORMAT = "yyyy.MM.dd.HH.mm.ss"

# Metadata key candidates for the key lookup (C1), in priority order.
METADATA_KEY_CANDIDATES = ("exp_number", "experiment", "Experiment", "file_id")

# Tool-wear model candidate features (B13), in this order.
TOOLWEAR_CANDIDATE_FEATURES = (
    "clamp_pressure",
    "feedrate",
    "X1_ActualPosition",
    "Y1_ActualPosition",
    "Z1_ActualPosition",
    "X1_DCBusVoltage",
    "Y1_DCBusVoltage",
    "S1_DCBusVoltage",
    "X1_OutputCurrent",
    "Y1_OutputCurrent",
    "S1_OutputCurrent",
    "X1_OutputVoltage",
    "Y1_OutputVoltage",
    "S1_OutputVoltage",
    "M1_CURRENT_FEEDRATE",
    "S1_ActualVelocity",
    "S1_CurrentFeedback",
    "S1_CommandVelocity",
    "M1_sequence_number",
    "S1_OutputPower",
)

# Sensor fields carried by a tool-wear record payload (besides ``time``).
PAYLOAD_SENSORS = (
    "X1_ActualPosition",
    "Y1_ActualPosition",
    "Z1_ActualPosition",
    "X1_DCBusVoltage",
    "Y1_DCBusVoltage",
    "S1_DCBusVoltage",
    "X1_OutputCurrent",
    "Y1_OutputCurrent",
    "S1_OutputCurrent",
    "X1_OutputVoltage",
    "Y1_OutputVoltage",
    "S1_OutputVoltage",
    "M1_CURRENT_FEEDRATE",
    "S1_ActualVelocity",
    "S1_CurrentFeedback",
    "S1_CommandVelocity",
    "M1_sequence_number",
    "S1_OutputPower",
)

# Active machining stages (L2).
ACTIVE_STAGES = (
    "Layer 1 Up",
    "Layer 1 Down",
    "Layer 2 Up",
    "Layer 2 Down",
    "Layer 3 Up",
    "Layer 3 Down",
)

# Sampling period of the machine series, seconds (L3).
SAMPLE_PERIOD_S = 0.1

# ---------------------------------------------------------------------------
# Record schemas (all fields nullable)
# ---------------------------------------------------------------------------
BEARING_RECORD = StructType(
    [
        StructField("dataset", StringType()),
        StructField("test_set", StringType()),
        StructField("timestamp", StringType()),
        StructField("file", StringType()),
        StructField("b1", DoubleType()),
        StructField("b2", DoubleType()),
        StructField("b3", DoubleType()),
        StructField("b4", DoubleType()),
    ]
)

PAYLOAD = StructType(
    [StructField("time", DoubleType())] + [StructField(c, DoubleType()) for c in PAYLOAD_SENSORS]
)

METADATA = StructType(
    [
        StructField("feedrate", DoubleType()),
        StructField("clamp_pressure", DoubleType()),
        StructField("tool_condition", StringType()),
        StructField("machining_finalized", StringType()),
        StructField("passed_visual_inspection", StringType()),
    ]
)

TOOLWEAR_RECORD = StructType(
    [
        StructField("dataset", StringType()),
        StructField("experiment", StringType()),
        StructField("timestamp", DoubleType()),
        StructField("payload", PAYLOAD),
        StructField("metadata", METADATA),
    ]
)

# Experiment metadata table (one row per experiment).
EXPERIMENT_METADATA = StructType(
    [
        StructField("No", IntegerType()),
        StructField("material", StringType()),
        StructField("feedrate", DoubleType()),
        StructField("clamp_pressure", DoubleType()),
        StructField("tool_condition", StringType()),
        StructField("machining_finalized", StringType()),
        StructField("passed_visual_inspection", StringType()),
    ]
)

# Raw topic record as carried by a broker or a landed file.
TOPIC_RECORD = StructType([StructField("topic", StringType()), StructField("value", StringType())])


def feature_columns(features=BATCH_FEATURES, channels=CHANNELS) -> list[str]:
    """``b1_mean, b1_std, ...`` — channel-major, feature order as given."""
    return [f"{c}_{f}" for c in channels for f in features]
