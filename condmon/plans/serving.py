"""Serving job: two independent streaming queries over
the same topic source definition.

* bearing: records -> per-snapshot features (update mode) -> RUL model ->
  ``bearing_predictions`` (``test_set, file, timestamp, rul_prediction,
  batch_id``);
* tool wear: records -> flat rows (append mode) -> wear model ->
  ``toolwear_predictions`` (``experiment, timestamp,
  tool_condition_prediction, tool_condition_true, unscoreable, batch_id``).

Models are loaded once; scoring runs in the executors inside each
micro-batch.  Rows the wear model cannot score (a NULL feature, e.g. no
metadata for the experiment) are written with a NULL prediction and the names
of the missing features, instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from condmon.plans import ml
from condmon.sources import topics as TP
from condmon.streaming import bearing as SB

BEARING_OUT = ["test_set", "file", "timestamp", "rul_prediction"]
TOOLWEAR_OUT = ["experiment", "timestamp", "tool_condition_prediction", "tool_condition_true", "unscoreable"]


def serve(
    spark: SparkSession,
    bearing_model_path: str,
    toolwear_model_path: str,
    sink_root: str,
    checkpoint_root: str,
    source: str = "files",
    path: str | None = None,
    bootstrap: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    jdbc: dict | None = None,
) -> list[StreamingQuery]:
    """Start both queries and return them (``streaming.bearing.await_any``
    blocks until the first ends).  ``jdbc`` = ``{"url", "properties",
    "bearing_table", "toolwear_table"}`` appends to database tables instead
    of the parquet sinks."""
    rul_model = ml.load(bearing_model_path)
    wear_model = ml.load(toolwear_model_path)

    def records():
        return TP.topic_stream(spark, source, path, bootstrap=bootstrap, max_files_per_trigger=max_files_per_trigger)

    def jdbc_for(table_key):
        if not jdbc:
            return None
        return {"url": jdbc["url"], "table": jdbc[table_key], "properties": jdbc.get("properties", {})}

    bearing_q = SB.start(
        SB.bearing_feature_stream(records()),
        f"{sink_root}/bearing_predictions",
        f"{checkpoint_root}/bearing",
        "update",
        scorer=lambda df: ml.score_rul(rul_model, df, keep=("test_set", "file", "timestamp")),
        columns=BEARING_OUT,
        available_now=available_now,
        jdbc=jdbc_for("bearing_table"),
    )
    toolwear_q = SB.start(
        SB.toolwear_feature_stream(records()),
        f"{sink_root}/toolwear_predictions",
        f"{checkpoint_root}/toolwear",
        "append",
        scorer=lambda df: ml.score_wear(wear_model, df),
        columns=TOOLWEAR_OUT,
        available_now=available_now,
        jdbc=jdbc_for("toolwear_table"),
    )
    return [bearing_q, toolwear_q]
