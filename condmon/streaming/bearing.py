"""Structured Streaming pipelines.

* Bearing: topic records -> parse -> per-snapshot ``max, p2p, rms`` as a
  stateful aggregation in ``update`` mode; each micro-batch re-emits the
  snapshots it touched with their running features (J2).  No watermark:
  state is kept for every snapshot and late samples are always accepted
  (J4) — ``finalize_after`` opts into a watermark and one row per snapshot.
* Tool wear: topic records -> parse -> flatten, stateless ``append``.

Sinks are ``foreachBatch`` writers that stay in DataFrames (no collect):
each batch is scored (optionally), tagged with ``batch_id`` and written to
``<sink>/batch_id=<n>`` with overwrite, so a replayed batch replaces its own
output instead of duplicating it.  A ``checkpointLocation`` is mandatory, so
a restart resumes instead of re-reading from the earliest offset (J6).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from condmon.functions.timestamps import snapshot_time
from condmon.operators.features import stream_features
from condmon.sources import topics as TP

Scorer = Callable[[DataFrame], DataFrame]


def bearing_feature_stream(records: DataFrame, finalize_after: str | None = None, observe: bool = True) -> DataFrame:
    """Streaming per-snapshot features from ``(topic, value)`` records.

    ``observe`` publishes the number of parsed samples of each micro-batch
    as the ``bearing_samples`` metric of the query progress (D22).

    With ``finalize_after`` (e.g. ``"1 hour"``) the snapshot time parsed
    from the file name is a watermarked grouping column, so ``append`` mode
    can emit each snapshot once, after the watermark passes it.
    """
    parsed = TP.parse_bearing(records)
    if observe:
        parsed = parsed.observe("bearing_samples", F.count(F.lit(1)).alias("samples"))
    if finalize_after:
        parsed = parsed.withColumn("event_ts", snapshot_time("file").cast("timestamp")).withWatermark(
            "event_ts", finalize_after
        )
        return stream_features(parsed, keys=("test_set", "file", "event_ts"))
    return stream_features(parsed)


def toolwear_feature_stream(records: DataFrame, observe: bool = True) -> DataFrame:
    """Flat tool-wear rows; ``observe`` publishes per-batch row and
    experiment counts as the ``toolwear_rows`` metric (D22)."""
    flat = TP.flatten_toolwear(TP.parse_toolwear(records))
    if observe:
        flat = flat.observe("toolwear_rows", F.count(F.lit(1)).alias("rows"))
    return flat


class MetricTotals(StreamingQueryListener):
    """Observed metrics of all micro-batches of a session (D22), per batch and
    as running totals.  ``recentProgress`` forgets old batches; a listener sees
    each once.

        totals = MetricTotals(); spark.streams.addListener(totals)
    """

    def __init__(self):
        self.totals: dict[tuple[str, str, str], int] = {}
        self.batches: dict[tuple[str, int, str, str], int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        for name, row in (p.observedMetrics or {}).items():
            for field, value in row.asDict().items():
                key = (str(p.id), name, field)
                self.totals[key] = self.totals.get(key, 0) + int(value or 0)
                self.batches[str(p.id), int(p.batchId), name, field] = int(value or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))

    def total(self, query: StreamingQuery, name: str, field: str) -> int:
        return self.totals.get((str(query.id), name, field), 0)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the events of a query's run have arrived: they come after it
        has ended."""
        limit = time.time() + seconds
        while str(query.runId) not in self.ended:
            if time.time() > limit:
                raise TimeoutError("the stream's last events have not arrived")
            time.sleep(0.05)

    def table(self, spark, queries: dict[str, StreamingQuery]) -> DataFrame:
        """``stream, batch_id, metric, value`` per micro-batch of the named
        queries: one row per batch and metric, of which the driver is told."""
        names = {str(q.id): name for name, q in queries.items()}
        rows = [
            (names[q], batch, f"{metric}.{field}", value)
            for (q, batch, metric, field), value in sorted(self.batches.items())
            if q in names
        ]
        return spark.createDataFrame(rows, "stream string, batch_id bigint, metric string, value bigint")


def batch_writer(sink_path: str, scorer: Scorer | None = None, columns: Sequence[str] | None = None,
                 jdbc: dict | None = None):
    """A ``foreachBatch`` function: score, add ``batch_id``, write.

    Parquet sink: ``<sink_path>/batch_id=<n>`` overwritten per batch
    (idempotent on replay).  ``jdbc`` (``url``, ``table``, ``properties``)
    appends to a database table instead (A8, A9).
    """

    def write(df: DataFrame, batch_id: int) -> None:
        out = scorer(df) if scorer else df
        if columns:
            out = out.select(*columns)
        if jdbc:
            out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
            out.write.mode("append").jdbc(jdbc["url"], jdbc["table"], properties=jdbc.get("properties", {}))
        else:
            out.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    return write


def start(
    features: DataFrame,
    sink_path: str,
    checkpoint_location: str,
    output_mode: str,
    scorer: Scorer | None = None,
    columns: Sequence[str] | None = None,
    available_now: bool = True,
    query_name: str | None = None,
    jdbc: dict | None = None,
) -> StreamingQuery:
    """Start a ``foreachBatch`` query; ``available_now`` drains what is
    there and stops (tests, replays), else micro-batches run as soon as
    possible."""
    if not checkpoint_location:
        raise ValueError("a checkpointLocation is required")
    w = (
        features.writeStream.outputMode(output_mode)
        .foreachBatch(batch_writer(sink_path, scorer, columns, jdbc))
        .option("checkpointLocation", checkpoint_location)
    )
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_sink(spark, sink_path: str) -> DataFrame:
    """All rows written by a ``batch_writer`` sink, with ``batch_id``."""
    return spark.read.option("basePath", sink_path).parquet(sink_path)


def latest_per_key(sink: DataFrame, keys: Sequence[str], version_col: str = "batch_id") -> DataFrame:
    """Latest version of each key (J8): ``max_by`` over the versions of a
    key — an aggregate, and a key has at most one row per micro-batch."""
    keys = list(keys)
    others = [c for c in sink.columns if c not in keys]
    latest = sink.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(version_col)).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in others])


def await_any(queries: Sequence[StreamingQuery]) -> None:
    """Block until the first query ends, stop the others and re-raise a
    failure (J7): a service with one of its queries gone is not served."""
    while all(q.isActive for q in queries):
        time.sleep(0.2)
    failed = [q for q in queries if not q.isActive and q.exception() is not None]
    for q in queries:
        if q.isActive:
            q.stop()
    if failed:
        raise failed[0].exception()


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Block until every query has drained its input (replays that stop by
    themselves); the first failure stops the others and is raised."""
    left = list(queries)
    while left:
        time.sleep(0.2)
        failed = [q for q in left if q.exception() is not None]
        if failed:
            for q in left:
                q.stop()
            raise failed[0].exception()
        left = [q for q in left if q.isActive]
