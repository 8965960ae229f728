"""Stream equals batch, restart safety, JSON round trip, model persistence."""



from pyspark.sql import functions as F

from conftest import SF_SMALL
from condmon.operators.features import stream_features
from condmon.plans import catalog as C
from condmon.session import work_dir
from condmon.sources import driver_tables as T
from condmon.sources import topics as TP
from condmon.streaming import bearing as SB


def _until(done, seconds=20):
    """Progress reports reach listeners a moment after a batch ends."""
    import time

    end = time.time() + seconds
    while not done() and time.time() < end:
        time.sleep(0.1)


def test_totals_over_more_batches_than_spark_remembers(spark):
    landing, sink, ckpt = work_dir(spark, "m-landing"), work_dir(spark, "m-sink"), work_dir(spark, "m-ckpt")
    rows = [("toolwear_raw", '{"experiment":"e%d"}' % i) for i in range(105)]
    df = spark.createDataFrame(rows, "topic string, value string").repartitionByRange(105, "value")
    TP.write_messages(df, landing, mode="overwrite")
    files = len(spark.read.parquet(landing).inputFiles())
    assert files > 100
    totals = SB.MetricTotals()
    spark.streams.addListener(totals)
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=1)
    q = SB.start(SB.toolwear_feature_stream(stream), sink, ckpt, "append")
    q.awaitTermination()
    _until(lambda: totals.total(q, "toolwear_rows", "rows") == 105)
    spark.streams.removeListener(totals)
    assert totals.total(q, "toolwear_rows", "rows") == 105 and len(q.recentProgress) < files


def test_a_failed_query_ends_the_service(spark):
    import pytest

    landing = work_dir(spark, "f-landing")
    df = spark.createDataFrame([("toolwear_raw", '{"experiment":"e"}')], "topic string, value string")
    TP.write_messages(df, landing, mode="overwrite")

    def broken(batch):
        raise ValueError("no model")

    def query(scorer):
        stream = TP.topic_stream(spark, "files", landing)
        return SB.start(SB.toolwear_feature_stream(stream), work_dir(spark, "f-sink"), work_dir(spark, "f-ckpt"),
                        "append", scorer=scorer, available_now=False)

    good, bad = query(None), query(broken)
    with pytest.raises(Exception, match="no model"):
        SB.await_any([good, bad])
    assert not good.isActive and not bad.isActive
    good, bad = query(None), query(broken)
    with pytest.raises(Exception, match="no model"):
        SB.await_all([good, bad])
    assert not good.isActive


def test_every_row_is_scored_or_explained(spark):
    from condmon.plans import ml

    train = spark.createDataFrame([(i, float(i % 10), "worn" if i % 10 >= 5 else "unworn") for i in range(200)],
                                  "id int, feedrate double, tool_condition string")
    model = ml.train_wear(train, ["id"], params={"maxIter": 3}).model
    flat = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", None)], "experiment string, feedrate double")
    got = {r["experiment"]: (r["tool_condition_prediction"], r["unscoreable"]) for r in ml.score_wear(model, flat).collect()}
    assert got == {"a": ("unworn", None), "b": ("worn", None), "c": (None, "feedrate")}


def test_stream_equals_batch_and_restart(spark):
    msgs = TP.bearing_messages(T.bearing_records(spark, SF_SMALL))
    landing = work_dir(spark, "t-landing")
    TP.write_messages(msgs.repartition(4), landing, mode="overwrite")
    sink, ckpt = work_dir(spark, "t-sink"), work_dir(spark, "t-ckpt")
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=1)
    totals = SB.MetricTotals()
    spark.streams.addListener(totals)
    q = SB.start(SB.bearing_feature_stream(stream), sink, ckpt, "update")
    q.awaitTermination()
    n = msgs.count()
    _until(lambda: totals.total(q, "bearing_samples", "samples") == n)
    spark.streams.removeListener(totals)
    assert totals.total(q, "bearing_samples", "samples") == n
    written = SB.read_sink(spark, sink)
    n1 = written.count()
    assert written.select("batch_id").distinct().count() >= 2
    latest = SB.latest_per_key(written, ["test_set", "file"]).drop("batch_id")
    batch = stream_features(T.bearing_records(spark, SF_SMALL))
    a = C.compare_form(latest)
    b = C.compare_form(batch).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # restart with the same checkpoint: nothing new is written
    stream2 = TP.topic_stream(spark, "files", landing, max_files_per_trigger=1)
    SB.start(SB.bearing_feature_stream(stream2), sink, ckpt, "update").awaitTermination()
    assert SB.read_sink(spark, sink).count() == n1


def test_json_round_trip_keeps_values(spark):
    recs = T.bearing_records(spark, SF_SMALL)
    back = TP.parse_bearing(TP.bearing_messages(recs))
    assert recs.exceptAll(back.select(*recs.columns)).count() == 0


def test_quarantine(spark):
    rows = [("toolwear_raw", '{"experiment":"e1","payload":{"X1_ActualPosition":1.5}}'),
            ("toolwear_raw", "garbage"), ("toolwear_raw", '{"experiment":"e2","timestamp":"x"}')]
    df = spark.createDataFrame(rows, "topic string, value string")
    from condmon.schemas import TOOLWEAR_RECORD

    good, bad = TP.split_quarantine(df, "toolwear_raw", TOOLWEAR_RECORD)
    assert [r["experiment"] for r in good.collect()] == ["e1"]
    assert bad.count() == 2


def test_model_save_load_same_predictions(spark):
    from condmon.plans import ml

    sup = C._supervised(spark, SF_SMALL)
    cols = [c for c in sup.columns if c[:2] in ("b3", "b4")]
    trained = ml.train_rul(sup, cols, params={"maxIter": 3})
    path = work_dir(spark, "t-model")
    ml.save(trained.model, path)
    loaded = ml.load(path)
    assert ml.model_feature_cols(loaded) == cols
    a = ml.score_rul(trained.model, sup, keep=("test_set", "file")).orderBy("test_set", "file").collect()
    b = ml.score_rul(loaded, sup, keep=("test_set", "file")).orderBy("test_set", "file").collect()
    assert a == b
    assert trained.metrics.collect()[0]["rmse"] >= 0


def test_jdbc_sink_plumbing(spark, monkeypatch):
    """The JDBC branch of the batch writer (A8, A9), without a database:
    ``DataFrameWriter.jdbc`` is replaced to record what it is given."""
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties, self._df.columns, self._df.count()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    write = SB.batch_writer("unused", columns=["a"], jdbc={"url": "jdbc:x", "table": "public.t", "properties": {"user": "u"}})
    write(spark.createDataFrame([(1, 2), (3, 4)], "a int, b int"), 7)
    assert calls == [("jdbc:x", "public.t", {"user": "u"}, ["a", "batch_id"], 2)]


def test_nan_in_records_becomes_null(spark):
    value = '{"dataset":NaN,"experiment":"e","timestamp":NaN,"payload":{"X1_ActualPosition":NaN},"metadata":{"tool_condition":NaN,"feedrate":2}}'
    df = spark.createDataFrame([("toolwear_raw", value)], "topic string, value string")
    row = TP.parse_toolwear(df).collect()[0]
    assert row["dataset"] is None and row["timestamp"] is None and row["payload"]["X1_ActualPosition"] is None
    assert row["metadata"]["tool_condition"] is None and row["metadata"]["feedrate"] == 2.0


def test_ordered_replay(spark):
    """Landed in order, the batches of a stream meet the names in order."""
    rows = [("bearing_raw", '{"test_set":"%d","file":"f%03d"}' % (i % 2, i)) for i in range(60)]
    df = spark.createDataFrame(rows, "topic string, value string").repartition(5)
    landing, sink, ckpt = work_dir(spark, "o-landing"), work_dir(spark, "o-sink"), work_dir(spark, "o-ckpt")
    TP.land_in_order(df, landing, [F.get_json_object("value", "$.test_set"), F.get_json_object("value", "$.file")], 4)
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=1)
    SB.start(TP.parse_bearing(stream), sink, ckpt, "append").awaitTermination()
    span = SB.read_sink(spark, sink).groupBy("batch_id").agg(
        F.min(F.struct("test_set", "file")).alias("lo"), F.max(F.struct("test_set", "file")).alias("hi"), F.count("*").alias("n"))
    got = span.orderBy("batch_id").collect()
    assert sum(r["n"] for r in got) == 60 and len(got) == 4
    assert all(a["hi"] < b["lo"] for a, b in zip(got, got[1:]))


def test_topics_written_without_a_sort(spark, tmp_path, monkeypatch):
    """The known topics go to their folders without the writer that sorts by
    topic; other topics and a missing one are kept."""
    from pyspark.sql import DataFrameWriter

    sorted_rows, partition_by = [], DataFrameWriter.partitionBy
    monkeypatch.setattr(
        DataFrameWriter, "partitionBy", lambda w, *c: sorted_rows.append(w._df.count()) or partition_by(w, *c)
    )
    known = [("bearing_raw", "1"), ("toolwear_raw", "2"), ("bearing_raw", None)]
    rows = [*known, ("other", "3"), (None, "4")]
    path = str(tmp_path / "t")
    TP.write_messages(spark.createDataFrame(rows, "topic string, value string"), path, by_topic=True)
    read = spark.read.schema("topic string, value string").parquet(path).select("topic", "value")
    assert sorted(map(repr, read.collect())) == sorted(f"Row(topic={t!r}, value={v!r})" for t, v in rows)
    assert sorted_rows == [2]


def test_landed_replay_grows_with_tasks(spark):
    from condmon.plans import catalog as C

    rows = spark.createDataFrame([("t", str(i)) for i in range(200)], "topic string, value string")
    for parts, files, per_trigger in ((21, 21, 6), (1, C.REPLAY_FILES, 2)):
        path, each = C._land(spark, rows.repartition(parts), "land-test")
        landed = spark.read.parquet(path)
        assert (len(landed.inputFiles()), each, landed.count()) == (files, per_trigger, 200)
