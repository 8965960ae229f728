"""Registered queries over the shared parquet tables, with oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` built from the library's
operators.  ``ORACLES`` holds, per query, an independent SQL formulation
(DuckDB dialect) over the same tables.  Double columns are rounded in
both — ``round(x + 3.3e-8, 6) + 0.0``: the offset keeps exact decimal ties
away from the rounding point and ``+ 0.0`` turns ``-0.0`` into ``0.0`` —
because sums in a different order differ in the last bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from condmon.functions import features as FX
from condmon.functions.timestamps import published_timestamp, snapshot_time
from condmon.operators.entropy import histogram_entropy
from condmon.operators.features import feature_table, snapshot_features, stream_features
from condmon.operators.supervised import rul_cycles, rul_supervised
from condmon.operators import cleaning as CL
from condmon.operators import joins as J
from condmon.operators import metrics as ME
from condmon.operators import splits as SP
from condmon.sources import topics as TP
from condmon.schemas import TOOLWEAR_RECORD, TOOLWEAR_TOPIC, TOPIC_RECORD
from condmon.schemas import BATCH_FEATURES, CHANNELS, PAYLOAD_SENSORS, STREAM_FEATURES, feature_columns
from condmon.session import materialize, work_dir
from condmon.sources import bearing_files as BF
from condmon.sources import experiment_files as EF
from condmon.sources import landing as LD
from condmon.sources import lines as LN
from condmon.sources import driver_tables as T


def compare_form(df: DataFrame) -> DataFrame:
    """Round every floating column the way the oracle SQL does."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name) + 3.3e-8, 6) + 0.0).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r6(expr: str) -> str:
    """SQL twin of ``compare_form`` for one expression."""
    return f"(round(({expr}) + 3.3e-8, 6) + 0.0)"


# ---------------------------------------------------------------------------
# Bearing features over lineitem
# ---------------------------------------------------------------------------
SQL_SIGNAL = """
sig AS (
  SELECT CASE l_returnflag WHEN 'R' THEN '1st_test' WHEN 'A' THEN '2nd_test'
                           WHEN 'N' THEN '3rd_test' END AS test_set,
         strftime(l_shipdate, '%Y.%m.%d.%H.%M.%S') AS file,
         l_quantity - 25.5 AS b1,
         (l_extendedprice - 50000) / 1000 AS b2,
         round(l_discount * 100 - 5) AS b3,
         round(l_tax * 100 - 4) AS b4
  FROM lineitem
)"""

SQL_PUBLISHED_TS = """
CASE WHEN len(string_split(regexp_replace({f}, '^(\\.*[^.].*)\\.[^.]*$', '\\1'), '.')) = 6
     THEN array_to_string(string_split(regexp_replace({f}, '^(\\.*[^.].*)\\.[^.]*$', '\\1'), '.')[1:3], '-')
          || ' ' ||
          array_to_string(string_split(regexp_replace({f}, '^(\\.*[^.].*)\\.[^.]*$', '\\1'), '.')[4:6], ':')
     ELSE regexp_replace({f}, '^(\\.*[^.].*)\\.[^.]*$', '\\1') END"""


def _sql_feature(ch: str, f: str) -> str:
    rms = f"CASE WHEN count({ch}) < count(*) THEN NULL ELSE sqrt(sum({ch}*{ch}) / count(*)) END"
    mean = f"avg(abs({ch}))"
    mx = f"max(abs({ch}))"
    return {
        "mean": mean,
        "std": f"stddev_samp({ch})",
        "skew": f"CASE WHEN count({ch}) < 3 THEN NULL WHEN max({ch}) = min({ch}) THEN 0 ELSE skewness({ch}) END",
        "kurtosis": f"CASE WHEN count({ch}) < 4 THEN NULL WHEN max({ch}) = min({ch}) THEN 0 ELSE kurtosis({ch}) END",
        "rms": rms,
        "max": mx,
        "p2p": f"abs(max({ch})) + abs(min({ch}))",
        "p2p_stream": f"max(abs({ch})) + abs(min({ch}))",
        "rms_stream": f"sqrt(avg({ch}*{ch}))",
        "crest": f"{mx} / nullif({rms}, 0)",
        "clearance": f"pow(coalesce(sum(sqrt(abs({ch}))), 0) / count(*), 2)",
        "shape": f"({rms}) / nullif({mean}, 0)",
        "impulse": f"{mx} / nullif({mean}, 0)",
    }[f]


def _sql_entropy_ctes(src: str, keys: list[str], bins: int = 500) -> str:
    """CTEs ``st``..``ent`` computing entropy per keys from ``src(keys, x)``."""
    k = ", ".join(keys)
    kj = " AND ".join(f"l.{c} = s.{c}" for c in keys)
    kl = ", ".join(f"l.{c}" for c in keys)
    return f"""
st AS (SELECT {k}, min(x) AS lo0, max(x) AS hi0, count(x) AS n, count(*) AS rws FROM {src} GROUP BY {k}),
st2 AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
                  CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM st),
bn0 AS (SELECT {kl}, l.x, s.lo, s.hi, s.n, s.rws,
               least(floor((l.x - s.lo) / (s.hi - s.lo) * {bins}), {bins - 1}) AS i0
        FROM {src} l JOIN st2 s ON {kj} WHERE l.x IS NOT NULL),
bn1 AS (SELECT *, CASE WHEN x < i0 * ((hi - lo) / {bins}) + lo THEN i0 - 1 ELSE i0 END AS i1 FROM bn0),
bn2 AS (SELECT *, CASE WHEN i1 <> {bins - 1} AND x >= (i1 + 1) * ((hi - lo) / {bins}) + lo
                       THEN i1 + 1 ELSE i1 END AS bin FROM bn1),
hist AS (SELECT {k}, n, rws, bin, count(*) AS c FROM bn2 GROUP BY {k}, n, rws, bin),
ent AS (SELECT {k}, CASE WHEN max(n) < max(rws) THEN NULL
                         ELSE -sum((c / n) * ln(c / n)) END AS entropy
        FROM hist GROUP BY {k})"""


def q_bearing_features_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_form(stream_features(T.bearing_records(spark, sf_dir)))


def sql_bearing_features_stream() -> str:
    aggs = []
    for ch in CHANNELS:
        aggs.append(f"{r6(_sql_feature(ch, 'max'))} AS {ch}_max")
        aggs.append(f"{r6(_sql_feature(ch, 'p2p_stream'))} AS {ch}_p2p")
        aggs.append(f"{r6(_sql_feature(ch, 'rms_stream'))} AS {ch}_rms")
    return f"""WITH {SQL_SIGNAL},
rec AS (SELECT test_set, file, {SQL_PUBLISHED_TS.format(f='file')} AS timestamp, b1, b2, b3, b4 FROM sig)
SELECT test_set, file, min(timestamp) AS timestamp, {', '.join(aggs)}
FROM rec GROUP BY test_set, file"""


def q_bearing_features_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_form(snapshot_features(T.signal_rows(spark, sf_dir)))


_MOMENT_FEATURES = [f for f in BATCH_FEATURES if f != "entropy"]


def sql_bearing_features_batch() -> str:
    aggs = [f"{r6(_sql_feature(ch, f))} AS {ch}_{f}" for ch in CHANNELS for f in _MOMENT_FEATURES]
    return f"""WITH {SQL_SIGNAL}
SELECT test_set, file, {', '.join(aggs)} FROM sig GROUP BY test_set, file"""


def q_bearing_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_df = T.signal_long(spark, sf_dir)
    return compare_form(histogram_entropy(long_df, ["vec_id", "channel"], "x"))


def sql_bearing_entropy() -> str:
    return f"""WITH lng AS (
  SELECT vec_id, 'b' || CAST((pos % 4) + 1 AS VARCHAR) AS channel, CAST(v AS DOUBLE) AS x
  FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings)
),{_sql_entropy_ctes('lng', ['vec_id', 'channel'])}
SELECT vec_id, channel, {r6('entropy')} AS entropy FROM ent"""


def q_bearing_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_form(feature_table(T.signal_rows(spark, sf_dir)))


def sql_bearing_feature_table() -> str:
    aggs = [f"{r6(_sql_feature(ch, f))} AS {ch}_{f}" for ch in CHANNELS for f in _MOMENT_FEATURES]
    unions = " UNION ALL ".join(f"SELECT test_set, file, '{ch}' AS channel, {ch} AS x FROM sig" for ch in CHANNELS)
    ent_cols = ", ".join(
        f"{r6(f'max(CASE WHEN channel = {chr(39)}{ch}{chr(39)} THEN entropy END)')} AS {ch}_entropy" for ch in CHANNELS
    )
    cols = ", ".join(feature_columns(BATCH_FEATURES))
    return f"""WITH {SQL_SIGNAL},
lng AS ({unions}),{_sql_entropy_ctes('lng', ['test_set', 'file', 'channel'])},
entw AS (SELECT test_set, file, {ent_cols} FROM ent GROUP BY test_set, file),
mom AS (SELECT test_set, file, {', '.join(aggs)} FROM sig GROUP BY test_set, file)
SELECT m.test_set, m.file, try_strptime(m.file, '%Y.%m.%d.%H.%M.%S') AS event_ts, {cols}
FROM mom m LEFT JOIN entw e USING (test_set, file)"""


def q_p2p_batch_vs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.signal_rows(spark, sf_dir)
    aggs = []
    for ch in CHANNELS:
        aggs += [FX.p2p_batch(ch).alias(f"{ch}_p2p_batch"), FX.p2p_stream(ch).alias(f"{ch}_p2p_stream")]
    return compare_form(rows.groupBy("test_set", "file").agg(*aggs))


def sql_p2p_batch_vs_stream() -> str:
    aggs = []
    for ch in CHANNELS:
        aggs.append(f"{r6(_sql_feature(ch, 'p2p'))} AS {ch}_p2p_batch")
        aggs.append(f"{r6(_sql_feature(ch, 'p2p_stream'))} AS {ch}_p2p_stream")
    return f"""WITH {SQL_SIGNAL}
SELECT test_set, file, {', '.join(aggs)} FROM sig GROUP BY test_set, file"""


# ---------------------------------------------------------------------------
# File names, widths
# ---------------------------------------------------------------------------
def q_file_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published text and typed time for three name shapes found in the
    data: ``yyyy.MM.dd.HH.mm.ss``, the same with ``.txt``, and ``yyyy.MM.dd``."""
    li = T.table(spark, sf_dir, "lineitem")
    base = T.ntz_snapshot_name("l_shipdate")
    day = F.substring(base, 1, 10)  # yyyy.MM.dd
    names = li.select(F.explode(F.array(base, F.concat(base, F.lit(".txt")), day)).alias("file")).distinct()
    return names.select(
        "file", published_timestamp("file").alias("timestamp"), snapshot_time("file").alias("event_ts")
    )


def sql_file_timestamp() -> str:
    return f"""WITH names AS (
  SELECT DISTINCT file FROM (
    SELECT strftime(l_shipdate, '%Y.%m.%d.%H.%M.%S') AS file FROM lineitem
    UNION ALL SELECT strftime(l_shipdate, '%Y.%m.%d.%H.%M.%S') || '.txt' FROM lineitem
    UNION ALL SELECT strftime(l_shipdate, '%Y.%m.%d') FROM lineitem))
SELECT file, {SQL_PUBLISHED_TS.format(f='file')} AS timestamp,
       try_strptime(file, '%Y.%m.%d.%H.%M.%S') AS event_ts
FROM names"""


def q_column_guard_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every snapshot text, guarded as a file of its own."""
    texts = T.snapshot_texts(spark, sf_dir)
    lines = texts.select("test_set", "file", F.posexplode(F.split("value", "\n")).alias("seq", "line"))
    out = BF.parse_lines(lines, "line", "test_set", policy="by_width")
    return compare_form(out.select("file", "seq", "test_set", "width", "keep_by_width", "keep_by_test", *CHANNELS))


# Whole snapshot files: the vector's values in lines of 8, 4 or 3, and the
# files that end wider, hold an empty line or end narrower.
SQL_SNAPSHOTS = """
e AS (
  SELECT vec_id, CASE label % 3 WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE 3 END AS w,
         list_transform(embedding, lambda v: CAST(CAST(floor(CAST(v AS DOUBLE) * 10000) AS BIGINT) AS VARCHAR)) AS v
  FROM embeddings),
l AS (
  SELECT vec_id, w, v, list_transform(range(0, len(v), w), lambda s: array_to_string(v[s + 1:s + w], chr(9))) AS l FROM e),
x AS (
  SELECT 'f' || lpad(CAST(vec_id AS VARCHAR), 9, '0') AS file,
         CASE vec_id % 3 WHEN 0 THEN '1st_test' WHEN 1 THEN '2nd_test' ELSE '3rd_test' END AS test_set,
         CASE WHEN vec_id % 10 = 0 THEN list_concat(l, [array_to_string(v[1:w + 1], chr(9))])
              WHEN vec_id % 7 = 0 THEN list_concat(list_concat(l[1:2], ['']), l[3:])
              WHEN vec_id % 11 = 0 THEN list_concat(l, ['5']) ELSE l END AS lines
  FROM l)"""


def _sql_channels(p: str, w: str) -> str:
    cells = []
    for i, ch in enumerate(CHANNELS):
        cell = (
            f"CASE WHEN {w} = 8 THEN TRY_CAST(trim({p}[{2 * i + 1}]) AS DOUBLE) "
            f"WHEN {w} = 4 THEN TRY_CAST(trim({p}[{i + 1}]) AS DOUBLE) END"
        )
        cells.append(f"{r6(cell)} AS {ch}")
    return ", ".join(cells)


def sql_column_guard_channels() -> str:
    return f"""WITH {SQL_SNAPSHOTS},
n AS (SELECT file, test_set, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS seq FROM x),
parsed AS (SELECT *, string_split(line, chr(9)) AS p, len(string_split(line, chr(9))) AS w FROM n)
SELECT file, CAST(seq AS INTEGER) AS seq, test_set, CAST(w AS INTEGER) AS width,
       w IN (8, 4) AS keep_by_width,
       w = CASE test_set WHEN '1st_test' THEN 8 ELSE 4 END AS keep_by_test,
       {_sql_channels('p', 'w')}
FROM parsed"""


# What is planted beside them: a file with a cell that is no number, a text
# that is no archive although its name says so, and a file of an empty line.
SQL_LANDED = SQL_SNAPSHOTS + """,
landed AS (
  SELECT file, test_set, lines, true AS readable FROM x
  UNION ALL SELECT file || 'n', test_set, list_prepend(regexp_replace(lines[1], '^[^\t]*', 'n/a'), lines[2:]), true
    FROM x WHERE CAST(substr(file, 2) AS INTEGER) % 13 = 0
  UNION ALL SELECT file || '.gz', test_set, lines, false FROM x WHERE CAST(substr(file, 2) AS INTEGER) % 17 = 0
  UNION ALL SELECT file || 'e', test_set, [''], true FROM x WHERE CAST(substr(file, 2) AS INTEGER) % 19 = 0)"""

_landed: dict[tuple, str] = {}


def _landed_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """The snapshot texts as files under their true names in a folder per test
    set, with the planted ones; landed once per application.  Returns the
    root."""
    key = (spark.sparkContext.applicationId, "snapshots", sf_dir)
    if key not in _landed:
        texts = T.snapshot_texts(spark, sf_dir).withColumn("id", F.substring("file", 2, 9).cast("int"))
        plant = lambda rest, suffix, value: texts.where(F.col("id") % rest == 0).select(
            "test_set", F.concat("file", F.lit(suffix)).alias("file"), value.alias("value")
        )
        files = texts.select("test_set", "file", "value")
        files = files.unionByName(plant(13, "n", F.regexp_replace("value", "^[^\t]*", "n/a")))
        files = files.unionByName(plant(17, ".gz", F.col("value"))).unionByName(plant(19, "e", F.lit("")))
        lines = files.select(
            F.col("test_set").alias("folder"), F.col("file").alias("name"), F.posexplode(F.split("value", "\n")).alias("no", "line")
        )
        root = work_dir(spark, "snapshot-files")
        LD.land_files(lines, root, in_name_order=True)
        _landed[key] = root
    return _landed[key]


def q_snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshot files under their true names, scanned under both guards."""
    root = _landed_snapshots(spark, sf_dir)
    scanned = BF.scan_snapshot_files(spark, root, ignore_corrupt=True)
    parts = [
        BF.read_snapshot_files(spark, root, policy=p, ignore_corrupt=True, scanned=scanned).withColumn("policy", F.lit(p))
        for p in BF.POLICIES
    ]
    return compare_form(parts[0].unionByName(parts[1]))


_SQL_GUARDED = """
k AS (SELECT file, test_set, list_filter(lines, lambda s: s <> '') AS lines FROM landed WHERE readable),
g AS (SELECT *, len(string_split(lines[1], chr(9))) AS w,
             list_max(list_transform(lines, lambda s: len(string_split(s, chr(9))))) AS m FROM k)"""


def sql_snapshot_files() -> str:
    return f"""WITH {SQL_LANDED},{_SQL_GUARDED},
p AS (SELECT 'by_width' AS policy, * FROM g WHERE m <= w AND w IN (8, 4)
      UNION ALL SELECT 'by_test', * FROM g WHERE m <= w AND w = CASE test_set WHEN '1st_test' THEN 8 ELSE 4 END),
n AS (SELECT policy, file, test_set, w, string_split(unnest(lines), chr(9)) AS p, generate_subscripts(lines, 1) - 1 AS seq FROM p)
SELECT policy, file, test_set, CAST(seq AS BIGINT) AS seq, {_sql_channels('p', 'w')} FROM n"""


def q_snapshot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards see of every landed snapshot file, readable or not, and
    why one is skipped."""
    return BF.snapshot_file_report(spark, _landed_snapshots(spark, sf_dir))


def sql_snapshot_report() -> str:
    return f"""WITH {SQL_LANDED},{_SQL_GUARDED},
r AS (SELECT l.test_set, l.file, l.readable, strlen(array_to_string(l.lines, chr(10))) + 1 AS size, w, m, coalesce(len(g.lines), 0) AS n,
             coalesce(len(list_filter(string_split(array_to_string(g.lines, chr(9)), chr(9)),
                                      lambda c: len(g.lines) > 0 AND TRY_CAST(trim(c) AS DOUBLE) IS NULL)), 0) AS bad
      FROM landed l LEFT JOIN g ON l.file = g.file AND l.test_set = g.test_set)
SELECT test_set, file, CAST(size AS BIGINT) AS size, CASE WHEN n > 0 THEN CAST(w AS DOUBLE) END AS width, CAST(m AS DOUBLE) AS max_width,
       CAST(n AS BIGINT) AS lines, CAST(bad AS BIGINT) AS non_numeric_cells, coalesce(n > 0 AND w IN (8, 4), false) AS keep_by_width,
       coalesce(n > 0 AND w = CASE test_set WHEN '1st_test' THEN 8 ELSE 4 END, false) AS keep_by_test,
       CASE WHEN NOT readable THEN 'unreadable' WHEN n = 0 THEN 'empty' WHEN m > w THEN 'line wider than the first'
            WHEN w NOT IN (8, 4) THEN 'unexpected width' WHEN bad > 0 THEN 'non-numeric cells' END AS reason
FROM r"""


#: Micro-batches of a replay of raw files.
REPLAY_BATCHES = 8


def q_stream_raw_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshot files replayed in name order, test set after test set,
    through the publishing guard: per kept file the micro-batch that had it,
    its samples and their sums."""
    from condmon.streaming import bearing as SB

    root = _landed_snapshots(spark, sf_dir)
    files = LN.count_files(spark, root, recursive=True)
    stream = BF.snapshot_stream(spark, root, -(-files // REPLAY_BATCHES))
    sink, ckpt = work_dir(spark, "replay-sink"), work_dir(spark, "replay-ckpt")
    q = SB.start(BF.parse_snapshot_texts(stream, policy="by_test"), sink, ckpt, "append")
    q.awaitTermination()
    rows = SB.read_sink(spark, sink).groupBy("test_set", "file", F.col("batch_id").cast("long").alias("batch_id"))
    return compare_form(rows.agg(F.count(F.lit(1)).alias("samples"), *[F.sum(c).alias(c) for c in CHANNELS]))


def sql_stream_raw_replay() -> str:
    return f"""WITH {SQL_LANDED},{_SQL_GUARDED},
o AS (SELECT file, test_set, (row_number() OVER (ORDER BY test_set, file) - 1)
             // ((count(*) OVER () + {REPLAY_BATCHES - 1}) // {REPLAY_BATCHES}) AS batch_id FROM landed),
p AS (SELECT * FROM g WHERE m <= w AND w = CASE test_set WHEN '1st_test' THEN 8 ELSE 4 END),
n AS (SELECT file, test_set, w, string_split(unnest(lines), chr(9)) AS p FROM p),
c AS (SELECT file, test_set, {_sql_channels('p', 'w')} FROM n)
SELECT test_set, file, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS samples,
       {', '.join(f"{r6(f'sum({ch})')} AS {ch}" for ch in CHANNELS)}
FROM c JOIN o USING (test_set, file) GROUP BY test_set, file, batch_id"""


# ---------------------------------------------------------------------------
# RUL cycles and the aligned supervised table
# ---------------------------------------------------------------------------
def _signal_rows_mixed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``signal_rows`` where the third set's files are named day-first, so
    none of them parses and that set falls back to name order."""
    rows = T.signal_rows(spark, sf_dir)
    return rows.withColumn(
        "file",
        F.when(
            F.col("test_set") == "3rd_test",
            F.concat_ws(".", *[F.element_at(F.split("file", r"\."), i) for i in (3, 2, 1, 4, 5, 6)]),
        ).otherwise(F.col("file")),
    )


SQL_SIGNAL_MIXED = SQL_SIGNAL + """,
sigm AS (
  SELECT * REPLACE (CASE WHEN test_set = '3rd_test'
                    THEN concat_ws('.', string_split(file, '.')[3], string_split(file, '.')[2],
                                   string_split(file, '.')[1], string_split(file, '.')[4],
                                   string_split(file, '.')[5], string_split(file, '.')[6])
                    ELSE file END AS file)
  FROM sig
)"""


def q_rul_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _signal_rows_mixed_names(spark, sf_dir)
    feats = snapshot_features(rows, features=["max"])
    return compare_form(rul_cycles(feats).select("test_set", "file", "event_ts", "cycle", "rul"))


def sql_rul_cycles() -> str:
    return f"""WITH {SQL_SIGNAL_MIXED},
snap AS (SELECT DISTINCT test_set, file FROM sigm),
t AS (SELECT *, try_strptime(file, '%Y.%m.%d.%H.%M.%S') AS event_ts FROM snap),
b AS (SELECT *, sum(CASE WHEN event_ts IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY test_set) AS bad,
             count(*) OVER (PARTITION BY test_set) AS n FROM t),
c AS (SELECT *, row_number() OVER (PARTITION BY test_set
                ORDER BY CASE WHEN bad = 0 THEN event_ts END, file) AS cycle FROM b)
SELECT test_set, file, event_ts, cycle, n - cycle + 1 AS rul FROM c"""


def q_rul_supervised_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.signal_rows(spark, sf_dir)
    feats = snapshot_features(rows, features=list(STREAM_FEATURES))
    return compare_form(rul_supervised(rul_cycles(feats)))


def sql_rul_supervised_aligned() -> str:
    aggs = [f"{_sql_feature(ch, f)} AS {ch}_{f}" for ch in ("b3", "b4") for f in STREAM_FEATURES]
    sel = []
    for ch, owners in (("b3", "('1st_test', '3rd_test')"), ("b4", "('2nd_test')")):
        for f in STREAM_FEATURES:
            sel.append(f"{r6(f'CASE WHEN test_set IN {owners} THEN {ch}_{f} ELSE 0.0 END')} AS {ch}_{f}")
    return f"""WITH {SQL_SIGNAL},
feat AS (SELECT test_set, file, {', '.join(aggs)} FROM sig GROUP BY test_set, file),
c AS (SELECT *, row_number() OVER (PARTITION BY test_set
                ORDER BY try_strptime(file, '%Y.%m.%d.%H.%M.%S'), file) AS cycle,
             count(*) OVER (PARTITION BY test_set) AS n FROM feat)
SELECT test_set, file, {', '.join(sel)}, n - cycle + 1 AS rul FROM c"""


# ---------------------------------------------------------------------------
# Topic records: publish -> route -> parse
# ---------------------------------------------------------------------------
def _sql_machine() -> str:
    own = {
        "X1_ActualPosition": "value",
        "Y1_ActualPosition": "CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.25",
        "M1_CURRENT_FEEDRATE": "CAST(json_extract_string(props, '$.k') AS DOUBLE)",
        "M1_sequence_number": "CAST(event_id AS DOUBLE)",
    }
    sensors = ",\n         ".join(
        f"{own.get(c, f'value + {i} / 2.0::DOUBLE')} AS {c}" for i, c in enumerate(PAYLOAD_SENSORS)
    )
    return f"""
mach AS (
  SELECT 'experiment_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS experiment,
         epoch_us(ts) / 1e6 AS time,
         {sensors},
         CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS M1_CURRENT_PROGRAM_NUMBER,
         CASE event_type WHEN 'view' THEN 'Layer 1 Up' WHEN 'click' THEN 'Layer 1 Down'
              WHEN 'purchase' THEN 'Layer 2 Up' WHEN 'signup' THEN 'Prep' WHEN 'error' THEN 'End' END
           AS Machining_Process
  FROM events
)"""


SQL_MACHINE = _sql_machine()

SQL_LOOKUP_META = """
lmeta AS (
  SELECT CAST(CASE WHEN c_custkey % 10 = 3 THEN -c_custkey ELSE c_custkey END AS INTEGER) AS No, 'wax' AS material, CAST(c_nationkey AS DOUBLE) AS feedrate,
         c_acctbal / 1000 AS clamp_pressure,
         CASE WHEN c_nationkey >= 13 THEN 'worn' ELSE 'unworn' END AS tool_condition,
         CASE WHEN c_nationkey < 20 THEN 'yes' ELSE 'no' END AS machining_finalized,
         CASE WHEN c_nationkey >= 20 THEN NULL WHEN c_acctbal > 2000 THEN 'yes' ELSE 'no' END
           AS passed_visual_inspection
  FROM customer
)"""

SQL_ORDINAL_META = """
ometa AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS No, n_name AS material, CAST(n_regionkey AS DOUBLE) AS feedrate,
         CAST((n_nationkey % 3) + 2.5 AS DOUBLE) AS clamp_pressure,
         CASE WHEN n_nationkey % 2 = 0 THEN 'unworn' ELSE 'worn' END AS tool_condition,
         'yes' AS machining_finalized,
         CASE WHEN n_regionkey = 0 THEN NULL ELSE 'yes' END AS passed_visual_inspection
  FROM nation
)"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in one record frame, as a broker would hold them."""
    bearing = TP.bearing_messages(T.bearing_records(spark, sf_dir))
    tool = TP.toolwear_messages(_machine_with_metadata(spark, sf_dir))
    return TP.select_datasets("both", bearing, tool)


def _machine_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = T.machine_rows(spark, sf_dir)
    meta = T.lookup_metadata(spark, sf_dir)
    return J.lookup_join(samples, meta, "experiment", key_rule="suffix", pad=6)


def _landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics landed in a folder per topic, once per application, and
    read back, so that routing looks at each record's topic and leaves the
    other one's files alone."""
    key = (spark.sparkContext.applicationId, "topics", sf_dir)
    if key not in _landed:
        path = work_dir(spark, "topics")
        TP.write_messages(_messages(spark, sf_dir), path, by_topic=True)
        _landed[key] = path
    return spark.read.schema(TOPIC_RECORD).parquet(_landed[key])


def q_topic_route_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_form(TP.parse_bearing(_landed_messages(spark, sf_dir)))


def sql_topic_route_parse() -> str:
    return f"""WITH {SQL_SIGNAL}
SELECT 'bearing' AS dataset, test_set, {SQL_PUBLISHED_TS.format(f='file')} AS timestamp, file,
       {r6('b1')} AS b1, {r6('b2')} AS b2, {r6('b3')} AS b3, {r6('b4')} AS b4
FROM sig"""


def q_toolwear_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_form(TP.flatten_toolwear(TP.parse_toolwear(_landed_messages(spark, sf_dir))))


def sql_toolwear_flatten() -> str:
    sensors = ", ".join(f"{r6('s.' + c)} AS {c}" for c in PAYLOAD_SENSORS)
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META}
SELECT s.experiment, {r6('s.time')} AS timestamp, 'toolwear' AS dataset,
       {r6('m.clamp_pressure')} AS clamp_pressure, {r6('m.feedrate')} AS feedrate,
       m.tool_condition AS tool_condition_true, {sensors}
FROM mach s LEFT JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0')"""


def q_json_malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-wear records plus document texts sent to the same topic: the
    texts are not JSON and land in quarantine, as do every tenth record, whose
    position is text; ``error`` events have a bare NaN there."""
    rows = T.machine_rows(spark, sf_dir)
    good_msgs = (
        TP.toolwear_messages(rows.drop("Machining_Process"))
        .select(
            "topic",
            F.when(
                F.get_json_object("value", "$.payload.M1_CURRENT_PROGRAM_NUMBER").cast("double") == 1,
                F.regexp_replace("value", '"X1_ActualPosition":[^,}]*', '"X1_ActualPosition":NaN'),
            )
            .when(
                F.get_json_object("value", "$.payload.M1_sequence_number").cast("double") % 10 == 4,
                F.regexp_replace("value", '"X1_ActualPosition":[^,}]*', '"X1_ActualPosition":"high"'),
            )
            .otherwise(F.col("value"))
            .alias("value"),
        )
    )
    junk = T.table(spark, sf_dir, "documents").select(F.lit(TOOLWEAR_TOPIC).alias("topic"), F.col("text").alias("value"))
    records = good_msgs.unionByName(junk)
    tagged = TP.tag_quarantine(records, TOOLWEAR_TOPIC, TOOLWEAR_RECORD)
    bad = F.col("quarantined")
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    out = tagged.select(
        F.when(bad, "quarantine").otherwise("ok").alias("status"),
        F.when(bad, null_s).otherwise(F.col("data.experiment")).alias("experiment"),
        F.when(bad, null_d).otherwise(F.col("data.payload.X1_ActualPosition")).alias("X1_ActualPosition"),
        # records of this topic that hold JSON are known by their number
        F.when(bad & ~F.col("value").startswith('{"dataset"'), F.md5("value"))
        .when(bad, F.regexp_extract("value", '"M1_sequence_number":([0-9]+)', 1))
        .otherwise(null_s)
        .alias("record_md5"),
    )
    return compare_form(out)


def sql_json_malformed_quarantine() -> str:
    return f"""WITH {SQL_MACHINE}
SELECT CASE WHEN bad THEN 'quarantine' ELSE 'ok' END AS status, CASE WHEN NOT bad THEN experiment END AS experiment,
       CASE WHEN NOT bad AND M1_CURRENT_PROGRAM_NUMBER <> 1 THEN {r6('X1_ActualPosition')} END AS X1_ActualPosition,
       CASE WHEN bad THEN CAST(CAST(M1_sequence_number AS BIGINT) AS VARCHAR) END AS record_md5
FROM (SELECT *, M1_CURRENT_PROGRAM_NUMBER <> 1 AND M1_sequence_number % 10 = 4 AS bad FROM mach)
UNION ALL
SELECT CASE WHEN json_valid(text) THEN 'ok' ELSE 'quarantine' END, NULL, NULL, md5(text) FROM documents"""


# ---------------------------------------------------------------------------
# Metadata joins and cleaning
# ---------------------------------------------------------------------------
_META_OUT = ["No", "material", "feedrate", "clamp_pressure", "tool_condition", "machining_finalized",
             "passed_visual_inspection"]


def q_metadata_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact key rule on a metadata ``experiment`` column that repeats
    (one per nation): the first row by ``No`` wins, most samples match
    nothing."""
    samples = T.machine_rows(spark, sf_dir).select("experiment", "M1_sequence_number")
    meta = T.lookup_metadata(spark, sf_dir)
    meta = meta.withColumn(
        "experiment", F.concat(F.lit("experiment_"), F.lpad(F.col("feedrate").cast("int").cast("string"), 6, "0"))
    )
    out = J.flatten_metadata(J.lookup_join(samples, meta, "experiment", key_rule="exact"), _META_OUT)
    # unmatched samples have a NULL ``No``: compared as double on both sides
    return compare_form(out.withColumn("No", F.col("No").cast("double")))


def sql_metadata_lookup_join() -> str:
    cols = ", ".join(f"f.{c}" if c not in ("feedrate", "clamp_pressure") else f"{r6('f.' + c)} AS {c}" for c in _META_OUT)
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META},
k AS (SELECT *, 'experiment_' || lpad(CAST(CAST(feedrate AS INTEGER) AS VARCHAR), 6, '0') AS key FROM lmeta),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY No) AS rn FROM k) WHERE rn = 1)
SELECT s.experiment, {r6('s.M1_sequence_number')} AS M1_sequence_number, {cols.replace('f.No', 'CAST(f.No AS DOUBLE) AS No')}
FROM mach s LEFT JOIN f ON s.experiment = f.key"""


def q_metadata_ordinal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = T.machine_rows(spark, sf_dir).select("experiment", "M1_sequence_number")
    out = J.ordinal_join(samples, T.ordinal_metadata(spark, sf_dir), "experiment", "No")
    return compare_form(out.select("experiment", "M1_sequence_number", *_META_OUT))


def sql_metadata_ordinal_join() -> str:
    cols = ", ".join(f"m.{c}" if c not in ("feedrate", "clamp_pressure") else f"{r6('m.' + c)} AS {c}" for c in _META_OUT)
    return f"""WITH {SQL_MACHINE},{SQL_ORDINAL_META},
e AS (SELECT experiment, row_number() OVER (ORDER BY experiment) AS o FROM (SELECT DISTINCT experiment FROM mach)),
m AS (SELECT *, row_number() OVER (ORDER BY No) AS o FROM ometa)
SELECT s.experiment, {r6('s.M1_sequence_number')} AS M1_sequence_number, {cols}
FROM mach s JOIN e ON s.experiment = e.experiment JOIN m ON e.o = m.o"""


def q_metadata_unpaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments and metadata rows past the shorter side of the ordinal
    pairing: the nation list is shorter than the experiments, and longer than
    the machining stages taken as experiments."""
    samples, meta = T.machine_rows(spark, sf_dir), T.ordinal_metadata(spark, sf_dir)
    long = J.unpaired(samples, meta).withColumn("pairing", F.lit("experiments"))
    short = J.unpaired(samples.select(F.col("Machining_Process").alias("experiment")), meta)
    return long.unionByName(short.withColumn("pairing", F.lit("stages"))).withColumn("No", F.col("No").cast("double"))


def sql_metadata_unpaired() -> str:
    return f"""WITH {SQL_MACHINE},{SQL_ORDINAL_META},
x AS (SELECT DISTINCT 'experiments' AS pairing, experiment FROM mach UNION SELECT 'stages', Machining_Process FROM mach),
e AS (SELECT *, row_number() OVER (PARTITION BY pairing ORDER BY experiment) AS o FROM x),
m AS (SELECT p.pairing, No, row_number() OVER (PARTITION BY p.pairing ORDER BY No) AS o
      FROM ometa CROSS JOIN (SELECT DISTINCT pairing FROM x) p)
SELECT coalesce(e.pairing, m.pairing) AS pairing, coalesce(e.o, m.o) AS ordinal,
       CASE WHEN m.o IS NULL THEN 'experiment' ELSE 'metadata' END AS side, experiment, CAST(No AS DOUBLE) AS No
FROM e FULL JOIN m ON e.o = m.o AND e.pairing = m.pairing WHERE e.o IS NULL OR m.o IS NULL"""


def q_dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = J.flatten_metadata(_machine_with_metadata(spark, sf_dir), _META_OUT)
    return compare_form(CL.drop_incomplete(joined))


def sql_dropna_any() -> str:
    mcols = ["time", *PAYLOAD_SENSORS, "M1_CURRENT_PROGRAM_NUMBER"]
    sel = ", ".join([f"{r6('s.' + c)} AS {c}" for c in mcols] + ["s.Machining_Process"])
    mets = ", ".join(f"m.{c}" if c not in ("feedrate", "clamp_pressure") else f"{r6('m.' + c)} AS {c}" for c in _META_OUT)
    notnull = " AND ".join(f"m.{c} IS NOT NULL" for c in _META_OUT)
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META}
SELECT s.experiment, {sel}, {mets}
FROM mach s JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0')
WHERE {notnull}"""


#: Sensors that the table of ``candidate_columns`` lacks, besides the metadata.
_LACKED = ("X1_ActualPosition", "S1_OutputPower")


def q_candidate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training columns of a table that lacks four candidates and has other
    columns besides: the present ones in the order of the list, the absent ones
    as 0.0; the NULLs of a present one (here every seventh record's) stay NULL."""
    from condmon.schemas import TOOLWEAR_CANDIDATE_FEATURES as candidates

    rows = T.machine_rows(spark, sf_dir).drop(*_LACKED)
    gaps = F.when(F.col("M1_sequence_number") % 7 != 0, F.col("Y1_ActualPosition"))
    rows = rows.withColumn("Y1_ActualPosition", gaps)
    present = CL.existing_columns(rows, candidates)
    table = CL.add_absent_columns(rows.select("experiment", *present), candidates)
    return compare_form(table.withColumn("column_order", F.lit(",".join(table.columns))))


def sql_candidate_columns() -> str:
    from condmon.schemas import TOOLWEAR_CANDIDATE_FEATURES as candidates

    present = [c for c in candidates if c in PAYLOAD_SENSORS and c not in _LACKED]
    absent = [c for c in candidates if c not in present]
    gaps = "CASE WHEN CAST(M1_sequence_number AS BIGINT) % 7 <> 0 THEN Y1_ActualPosition END"
    cols = [f"{r6(gaps if c == 'Y1_ActualPosition' else c)} AS {c}" for c in present]
    cols += [f"CAST(0 AS DOUBLE) AS {c}" for c in absent]
    return f"""WITH {SQL_MACHINE}
SELECT experiment, {', '.join(cols)}, '{','.join(['experiment', *present, *absent])}' AS column_order
FROM mach"""


# ---------------------------------------------------------------------------
# Counts and samples of files
# ---------------------------------------------------------------------------
def q_experiment_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.machine_rows(spark, sf_dir).groupBy("experiment").agg(F.count(F.lit(1)).alias("n_rows"))


def sql_experiment_row_counts() -> str:
    return f"WITH {SQL_MACHINE} SELECT experiment, count(*) AS n_rows FROM mach GROUP BY experiment"


def q_files_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.signal_rows(spark, sf_dir)
    return rows.groupBy("test_set").agg(F.count_distinct("file").alias("files_streamed"))


def sql_files_streamed() -> str:
    return f"WITH {SQL_SIGNAL} SELECT test_set, count(DISTINCT file) AS files_streamed FROM sig GROUP BY test_set"


def q_first_files_sample(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """First ``k`` file names per test set, in name order."""
    from condmon.operators.ordinal import first_k_per_group

    files = T.signal_rows(spark, sf_dir).select("test_set", "file").distinct()
    return first_k_per_group(files, ["test_set"], ["file"], k)


def sql_first_files_sample() -> str:
    return f"""WITH {SQL_SIGNAL}
SELECT test_set, file FROM (
  SELECT test_set, file, row_number() OVER (PARTITION BY test_set ORDER BY file) AS rn
  FROM (SELECT DISTINCT test_set, file FROM sig)) WHERE rn <= 5"""


# ---------------------------------------------------------------------------
# Splits and metrics
# ---------------------------------------------------------------------------
def q_split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey")
    return SP.hash_split(orders, ["o_orderkey"], 0.2, 42)


def sql_split_random() -> str:
    return """WITH h AS (SELECT o_orderkey, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8))::BIGINT AS h
                FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY h, o_orderkey) AS rn, count(*) OVER () AS n FROM h)
SELECT o_orderkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r"""


def q_split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = T.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return SP.hash_split(labels, ["doc_id"], 0.2, 42, strata=["quality"])


def sql_split_stratified() -> str:
    return """WITH h AS (SELECT doc_id, quality, ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|42'), 1, 8))::BIGINT AS h
                FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS n FROM h)
SELECT doc_id, quality, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r"""


def q_split_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified split that keeps the samples of an experiment together;
    experiments without metadata are a stratum of their own."""
    rows = J.flatten_metadata(_machine_with_metadata(spark, sf_dir), ["tool_condition"])
    rows = rows.select("experiment", "M1_sequence_number", "tool_condition")
    out = SP.hash_split(rows, ["M1_sequence_number"], 0.2, 42, strata=["tool_condition"], group_col="experiment")
    return compare_form(out)


def sql_split_grouped() -> str:
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META},
d AS (SELECT s.experiment, s.M1_sequence_number, m.tool_condition FROM mach s
      LEFT JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0')),
g AS (SELECT experiment, tool_condition, count(*) AS size,
             ('0x' || substr(md5(experiment || '|42'), 1, 8))::BIGINT AS h FROM d GROUP BY ALL),
k AS (SELECT *, ceil(0.2 * sum(size) OVER (PARTITION BY tool_condition)) AS k FROM g),
r AS (SELECT *, sum(size) OVER (PARTITION BY tool_condition ORDER BY size > k, h, experiment ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT d.experiment, {r6('d.M1_sequence_number')} AS M1_sequence_number, d.tool_condition,
       CASE WHEN 2 * (upto - size) + size <= 2 * k THEN 'test' ELSE 'train' END AS split
FROM d JOIN r ON d.experiment = r.experiment"""


def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE of a fixed rule (``b2 / 2``) against ``b1`` per test set."""
    rows = T.signal_rows(spark, sf_dir).withColumn("pred", F.col("b2") / 2)
    return compare_form(ME.regression_metrics(rows, "b1", "pred", ["test_set"]))


def sql_regression_metrics() -> str:
    e = "(b2 / 2 - b1)"
    return f"""WITH {SQL_SIGNAL}
SELECT test_set, count(*) AS n, {r6(f'avg({e} * {e})')} AS mse, {r6(f'sqrt(avg({e} * {e}))')} AS rmse,
       {r6(f'avg(abs({e}))')} AS mae
FROM sig GROUP BY test_set"""


def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report for a fixed rule (``quality = 1 - toxic``) on ``labels``."""
    lab = T.table(spark, sf_dir, "labels").withColumn("pred", 1 - F.col("toxic"))
    return compare_form(ME.classification_report(lab, "quality", "pred"))


def sql_classification_report() -> str:
    return f"""WITH s AS (SELECT quality AS y, 1 - toxic AS p FROM labels),
cls AS (SELECT y AS c FROM s UNION SELECT p FROM s),
per AS (SELECT c, (SELECT count(*) FROM s WHERE y = c) AS support, (SELECT count(*) FROM s WHERE p = c) AS predicted,
               (SELECT count(*) FROM s WHERE y = c AND p = c) AS tp FROM cls),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr)
SELECT CAST(c AS VARCHAR) AS label, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1_score,
       support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)')},
          {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f"""


# ---------------------------------------------------------------------------
# Label codes, models, streams
# ---------------------------------------------------------------------------
def q_label_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from condmon.plans import ml

    cust = T.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return ml.encode_decode(cust, "c_mktsegment")


def sql_label_encode_decode() -> str:
    return """SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS label_index,
       c_mktsegment AS decoded FROM customer"""


def _supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = snapshot_features(T.signal_rows(spark, sf_dir), features=list(STREAM_FEATURES))
    return rul_supervised(rul_cycles(feats))


def _rul_columns(sup: DataFrame) -> list[str]:
    return [c for c in sup.columns if c[:2] in ("b1", "b2", "b3", "b4")]


def q_rul_gbt_predict(spark: SparkSession, sf_dir: str, params: dict | None = None) -> DataFrame:
    """The full model (500 trees, or with ``params``) fitted, saved, loaded and
    applied to the hold-out, on a feature for which its predictions have a closed form.

    A feature of four values (the quarter of the snapshot) is told apart by
    any tree of depth 3, the first tree has full weight, and the others find
    nothing left: every prediction is the mean label of the training rows of
    its quarter."""
    from condmon.plans import ml

    quarter = F.ceil(F.element_at(F.split("file", r"\."), 2).cast("int") / 3).cast("double")
    cycles = rul_cycles(T.signal_rows(spark, sf_dir).select("test_set", "file").distinct())
    rows = materialize(cycles.select("test_set", "file", quarter.alias("quarter"), F.col("rul").cast("double").alias("rul")))
    trained = ml.train_rul(rows, ["quarter"], params=params)
    path = work_dir(spark, "rul-model")
    ml.save(trained.model, path)
    held_out = trained.test_predictions.select("test_set", "file", "quarter", "rul")
    return compare_form(ml.score_rul(ml.load(path), held_out, keep=("test_set", "file", "rul")))


_SQL_RUL = """
c AS (SELECT test_set, file, row_number() OVER (PARTITION BY test_set
               ORDER BY try_strptime(file, '%Y.%m.%d.%H.%M.%S'), file) AS cycle,
             count(*) OVER (PARTITION BY test_set) AS n FROM (SELECT DISTINCT test_set, file FROM sig)),
u AS (SELECT test_set, file, n - cycle + 1 AS rul FROM c)"""


def sql_rul_gbt_predict() -> str:
    return f"""WITH {SQL_SIGNAL},{_SQL_RUL},
h AS (SELECT *, ('0x' || substr(md5(test_set || '|' || file || '|42'), 1, 8))::BIGINT AS h,
             ceil(CAST(string_split(file, '.')[2] AS INTEGER) / 3) AS quarter FROM u),
r AS (SELECT *, row_number() OVER (ORDER BY h, test_set, file) AS rn, count(*) OVER () AS n FROM h),
m AS (SELECT quarter, avg(rul) AS mean FROM r WHERE rn > ceil(0.2 * n) GROUP BY quarter)
SELECT test_set, file, {r6('rul')} AS rul, {r6('mean')} AS rul_prediction
FROM r JOIN m USING (quarter) WHERE rn <= ceil(0.2 * n)"""


def _wear_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.flatten_metadata(_machine_with_metadata(spark, sf_dir), _META_OUT)


def _train_wear(spark: SparkSession, sf_dir: str, params: dict | None = None):
    from condmon.plans import ml

    rows = _wear_training_rows(spark, sf_dir)
    return ml.train_wear(rows, ["M1_sequence_number"], params=params, keep=("experiment",))


def q_wear_gbt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full model (100 trees) on the stratified hold-out: the stand-in's
    label is a threshold of one feature, so a right fit repeats the rule."""
    pred = _train_wear(spark, sf_dir).test_predictions
    return pred.select("experiment", "M1_sequence_number", "tool_condition", "tool_condition_prediction")


def sql_wear_gbt_predict() -> str:
    notnull = " AND ".join(f"m.{c} IS NOT NULL" for c in _META_OUT)
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META},
d AS (SELECT s.experiment, s.M1_sequence_number, m.tool_condition FROM mach s
      JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0') WHERE {notnull}),
h AS (SELECT *, ('0x' || substr(md5(CAST(CAST(M1_sequence_number AS BIGINT) AS VARCHAR) || '.0|42'), 1, 8))::BIGINT AS h FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY tool_condition ORDER BY h, M1_sequence_number) AS rn,
             count(*) OVER (PARTITION BY tool_condition) AS n FROM h)
SELECT experiment, M1_sequence_number, tool_condition, tool_condition AS tool_condition_prediction
FROM r WHERE rn <= ceil(0.2 * n)"""


#: A landed replay has at least so many files and as many micro-batches.
REPLAY_FILES, TRIGGERS = 8, 4


def _land(spark: SparkSession, messages: DataFrame, name: str) -> tuple[str, int]:
    """Write topic records as parquet in the shared work folder, each task its
    own file, so that files and tasks grow with the records; what falls into
    fewer than ``REPLAY_FILES`` files is small and dealt over that many.
    Returns the folder and the files per micro-batch of a replay in
    ``TRIGGERS`` batches."""
    path = work_dir(spark, name)
    TP.write_messages(messages, path, mode="overwrite")
    landed = spark.read.schema(TOPIC_RECORD).parquet(path)
    files = len(landed.inputFiles())
    if files < REPLAY_FILES:
        path, files = f"{path}-dealt", REPLAY_FILES
        TP.write_messages(landed.repartition(files), path, mode="overwrite")
        files = len(spark.read.schema(TOPIC_RECORD).parquet(path).inputFiles())
    return path, max(1, -(-files // TRIGGERS))


def q_stream_update_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay the bearing records through the streaming aggregation in four
    micro-batches (update mode, batch-tagged sink), then keep the latest
    version per snapshot — which must equal the batch aggregate."""
    from condmon.streaming import bearing as SB

    landing, per_trigger = _land(spark, TP.bearing_messages(T.bearing_records(spark, sf_dir)), "bearing-landing")
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=per_trigger)
    sink, ckpt = work_dir(spark, "bearing-sink"), work_dir(spark, "bearing-ckpt")
    q = SB.start(SB.bearing_feature_stream(stream), sink, ckpt, "update")
    q.awaitTermination()
    latest = SB.latest_per_key(SB.read_sink(spark, sink), ["test_set", "file"]).drop("batch_id")
    return compare_form(latest)


def _arrive_and_run(spark: SparkSession, parts, make_stream, mode: str, crash_at: int | None = None, listener=None):
    """Records arrive part by part (``parts``: frames of topic records); after
    each the stream resumes from its checkpoint and drains what is new.  At
    part ``crash_at`` the first attempt fails after its batch was written, so
    the batch is replayed.  Returns the sink's rows, how often each batch was
    written, and the last query."""
    from pyspark.errors import StreamingQueryException

    from condmon.streaming import bearing as SB

    landing, sink, ckpt = work_dir(spark, "arrivals"), work_dir(spark, "arrivals-sink"), work_dir(spark, "arrivals-ckpt")
    written: dict[int, int] = {}

    def start(crash: bool):
        write = SB.batch_writer(sink)

        def writer(df: DataFrame, batch_id: int) -> None:
            write(df, batch_id)
            written[batch_id] = written.get(batch_id, 0) + 1
            if crash:
                raise RuntimeError("stopped after the write")

        stream = make_stream(TP.topic_stream(spark, "files", landing))
        w = stream.writeStream.outputMode(mode).foreachBatch(writer).option("checkpointLocation", ckpt)
        return w.trigger(availableNow=True).start()

    query = None
    for i, part in enumerate(parts):
        TP.write_messages(part, landing)
        if i == crash_at:
            try:
                start(True).awaitTermination()
            except StreamingQueryException as stopped:
                if "stopped after the write" not in str(stopped):
                    raise
        query = start(False)
        query.awaitTermination()
        if listener:
            listener.wait(query)
    return SB.read_sink(spark, sink), written, query


def _yearly_messages(spark: SparkSession, sf_dir: str) -> tuple[list[DataFrame], str]:
    """The bearing records of each year, from the first to the last, and the
    first year."""
    records = T.bearing_records(spark, sf_dir)
    year = F.substring("file", 1, 4).cast("int")
    first, last = records.agg(F.min(year), F.max(year)).first()
    parts = [TP.bearing_messages(records.where(F.col("file").startswith(str(y)))) for y in range(first, last + 1)]
    return parts, str(first)


def q_stream_finalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per snapshot from a watermarked append-mode aggregation.

    The years arrive one after another.  With the last one come second copies
    of the first year's records with other values: they lie before the
    watermark and are dropped by rule.  Two records far in the future end the
    stream: the first moves the watermark past all snapshots, and neither is
    ever emitted itself."""
    from condmon.streaming import bearing as SB

    parts, first = _yearly_messages(spark, sf_dir)
    records = T.bearing_records(spark, sf_dir)
    late = records.where(F.col("file").startswith(first)).withColumn("b1", F.col("b1") + 1000)
    parts[-1] = parts[-1].unionByName(TP.bearing_messages(late))
    end = spark.range(1).select(
        F.lit("bearing").alias("dataset"), F.lit("end").alias("test_set"), F.lit("end").alias("timestamp"),
        F.lit("2200.01.01.00.00.00").alias("file"), *[F.lit(0.0).alias(c) for c in CHANNELS],
    )
    parts += [TP.bearing_messages(end)] * 2
    out, _, _ = _arrive_and_run(spark, parts, lambda s: SB.bearing_feature_stream(s, finalize_after="1 hour"), "append")
    return compare_form(out.drop("event_ts", "batch_id"))


def q_stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stateless stream that is stopped after each part and resumes from its
    checkpoint; the third batch fails after its write and is replayed.  Per
    record the batch that holds it and how often that batch was written."""
    from condmon.streaming import bearing as SB

    rows = T.machine_rows(spark, sf_dir)
    parts = [TP.toolwear_messages(rows.where(F.col("M1_sequence_number") % 4 == k)) for k in range(4)]
    out, written, _ = _arrive_and_run(spark, parts, SB.toolwear_feature_stream, "append", crash_at=2)
    tries = F.lit(None).cast("int")
    for batch, n in written.items():  # one entry per batch
        tries = F.when(F.col("batch_id") == batch, n).otherwise(tries)
    out = out.withColumn("writes", tries)
    return compare_form(out.select("experiment", "M1_sequence_number", "X1_ActualPosition", F.col("batch_id").cast("long").alias("batch_id"), "writes"))


def sql_stream_recovery() -> str:
    return f"""WITH {SQL_MACHINE}
SELECT experiment, {r6('M1_sequence_number')} AS M1_sequence_number, {r6('X1_ActualPosition')} AS X1_ActualPosition,
       CAST(M1_sequence_number AS BIGINT) % 4 AS batch_id,
       CASE WHEN CAST(M1_sequence_number AS BIGINT) % 4 = 2 THEN 2 ELSE 1 END AS writes
FROM mach"""


def q_stream_empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second arrival holds records of the other topic only, so its
    micro-batch is empty: it is written once, adds no row, and the stream goes
    on with the next one.  Per batch its writes, rows and sum of sequence numbers."""
    from condmon.streaming import bearing as SB

    rows = T.machine_rows(spark, sf_dir)
    others = T.bearing_records(spark, sf_dir)
    parts = []
    for k in range(3):
        parts.append(TP.toolwear_messages(rows.where(F.col("M1_sequence_number") % 3 == k)))
        parts.append(TP.bearing_messages(others.where(F.pmod("b4", F.lit(3)) == k)))
    out, written, _ = _arrive_and_run(spark, parts, SB.toolwear_feature_stream, "append")
    batches = spark.createDataFrame(sorted(written.items()), "batch_id bigint, writes int")  # one row per batch
    found = out.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("M1_sequence_number").cast("long").alias("sequence_sum")
    )
    return batches.join(found, "batch_id", "left").na.fill(0, ["n_rows", "sequence_sum"])


def sql_stream_empty_batches() -> str:
    return f"""WITH {SQL_MACHINE}
SELECT CAST(2 * (CAST(M1_sequence_number AS BIGINT) % 3) AS BIGINT) AS batch_id, 1 AS writes, count(*) AS n_rows,
       CAST(sum(M1_sequence_number) AS BIGINT) AS sequence_sum
FROM mach GROUP BY ALL
UNION ALL SELECT 2 * i + 1, 1, 0, 0 FROM range(3) t(i)"""


def q_stream_recovery_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the stateful aggregation: after a replayed batch the state
    counts no sample twice and loses none, so the latest version of every
    snapshot is the batch aggregate."""
    from condmon.streaming import bearing as SB

    rows = T.bearing_records(spark, sf_dir)
    parts = [TP.bearing_messages(rows.where(F.col("b4") % 3 == k)) for k in (-2, -1, 0, 1, 2)]
    out, _, _ = _arrive_and_run(spark, parts, SB.bearing_feature_stream, "update", crash_at=1)
    return compare_form(SB.latest_per_key(out, ["test_set", "file"]).drop("batch_id"))


def q_stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that both streams publish with every micro-batch, gathered
    by a listener across restarts: samples per year and records per part."""
    from condmon.streaming import bearing as SB

    totals = SB.MetricTotals()
    spark.streams.addListener(totals)
    try:
        _, _, bearing = _arrive_and_run(
            spark, _yearly_messages(spark, sf_dir)[0], SB.bearing_feature_stream, "update", listener=totals
        )
        rows = T.machine_rows(spark, sf_dir)
        parts = [TP.toolwear_messages(rows.where(F.col("M1_sequence_number") % 3 == k)) for k in range(3)]
        _, _, tool = _arrive_and_run(spark, parts, SB.toolwear_feature_stream, "append", listener=totals)
    finally:
        spark.streams.removeListener(totals)
    return totals.table(spark, {"bearing": bearing, "toolwear": tool})


def sql_stream_batch_metrics() -> str:
    return """SELECT 'bearing' AS stream, CAST(year(l_shipdate) - (SELECT min(year(l_shipdate)) FROM lineitem) AS BIGINT) AS batch_id,
       'bearing_samples.samples' AS metric, count(*) AS value FROM lineitem GROUP BY ALL
UNION ALL
SELECT 'toolwear', CAST(event_id % 3 AS BIGINT), 'toolwear_rows.rows', count(*) FROM events GROUP BY ALL"""


def q_stream_as_soon_as_possible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving trigger: micro-batches start as soon as possible and the
    query goes on until it is stopped; then the batch aggregate."""
    from condmon.streaming import bearing as SB

    landing, per_trigger = _land(spark, TP.bearing_messages(T.bearing_records(spark, sf_dir)), "asap-landing")
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=per_trigger)
    sink, ckpt = work_dir(spark, "asap-sink"), work_dir(spark, "asap-ckpt")
    q = SB.start(SB.bearing_feature_stream(stream), sink, ckpt, "update", available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return compare_form(SB.latest_per_key(SB.read_sink(spark, sink), ["test_set", "file"]).drop("batch_id"))


def q_publish_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per topic that each choice of datasets publishes; a choice that
    names none publishes nothing."""
    bearing = TP.bearing_messages(T.bearing_records(spark, sf_dir))
    tool = TP.toolwear_messages(T.machine_rows(spark, sf_dir))
    out = None
    for choice in ("bearing", "ToolWear", "BOTH", "neither", ""):
        chosen = TP.select_datasets(choice, bearing, tool)
        if chosen is not None:
            part = chosen.groupBy(F.lit(choice).alias("choice"), "topic").agg(F.count(F.lit(1)).alias("records"))
            out = part if out is None else out.unionByName(part)
    return out


def sql_publish_selected() -> str:
    from condmon.schemas import BEARING_TOPIC

    return f"""WITH n AS (SELECT '{BEARING_TOPIC}' AS topic, count(*) AS records FROM lineitem
      UNION ALL SELECT '{TOOLWEAR_TOPIC}', count(*) FROM events)
SELECT choice, topic, records FROM n, (VALUES ('bearing', true, false), ('ToolWear', false, true), ('BOTH', true, true)) c(choice, b, t)
WHERE CASE WHEN topic = '{BEARING_TOPIC}' THEN b ELSE t END"""


def q_training_input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training jobs say of incomplete inputs made from the tables:
    each test set left out in turn, no label column, no known feature."""
    import warnings

    from condmon.plans import ml
    from condmon.plans.training import require_sets

    def outcome(check) -> str:
        with warnings.catch_warnings(record=True) as said:
            warnings.simplefilter("always")
            try:
                check()
            except (RuntimeError, ValueError) as e:
                return f"{type(e).__name__}: {e}"
        own = [w for w in said if w.category is UserWarning]
        return f"warning: {own[0].message}" if own else "passes"

    sets = T.signal_rows(spark, sf_dir).select("test_set").distinct()
    tool = _wear_training_rows(spark, sf_dir)
    known = ["experiment", "M1_sequence_number", "tool_condition"]
    cases = {"all sets": outcome(lambda: require_sets(spark, sets))}
    for name in ("1st_test", "2nd_test", "3rd_test"):
        cases[f"without {name}"] = outcome(lambda n=name: require_sets(spark, sets.where(F.col("test_set") != n)))
    cases["no label"] = outcome(lambda: ml.train_wear(tool.drop("tool_condition"), known[:2]))
    cases["no feature"] = outcome(lambda: CL.existing_columns(tool.select("experiment", "tool_condition"), ["feedrate"]))
    return spark.createDataFrame(list(cases.items()), "input string, outcome string")


def sql_training_input_checks() -> str:
    return f"""WITH {SQL_SIGNAL},
s AS (SELECT DISTINCT test_set FROM sig),
w AS (SELECT '1st_test' AS t UNION SELECT '2nd_test' UNION SELECT '3rd_test')
SELECT 'all sets' AS input, CASE WHEN count(*) = 3 THEN 'passes' END AS outcome FROM s
UNION ALL SELECT 'without ' || t, CASE t WHEN '3rd_test' THEN 'warning: no snapshots of 3rd_test; training on the other sets'
                                         ELSE 'RuntimeError: no snapshots of ' || t END FROM w JOIN s ON t = test_set
UNION ALL SELECT 'no label', 'ValueError: expected a ''tool_condition'' column'
UNION ALL SELECT 'no feature', 'ValueError: no candidate feature column is present in the data'"""


def q_stream_append_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-wear records through the stateless stream, scored per
    micro-batch by the full wear model trained on the same data and loaded
    from its folder; one row per record, without a prediction where the
    record has no metadata."""
    from condmon.plans import ml
    from condmon.streaming import bearing as SB

    model_path = work_dir(spark, "wear-model")
    ml.save(_train_wear(spark, sf_dir).model, model_path)
    model = ml.load(model_path)
    landing, per_trigger = _land(spark, TP.toolwear_messages(_machine_with_metadata(spark, sf_dir)), "toolwear-landing")
    stream = TP.topic_stream(spark, "files", landing, max_files_per_trigger=per_trigger)
    sink, ckpt = work_dir(spark, "toolwear-sink"), work_dir(spark, "toolwear-ckpt")
    q = SB.start(SB.toolwear_feature_stream(stream), sink, ckpt, "append", scorer=lambda df: ml.score_wear(model, df))
    q.awaitTermination()
    out = SB.read_sink(spark, sink)
    return compare_form(
        out.select(
            "experiment", "timestamp", "tool_condition_prediction", "tool_condition_true", "unscoreable",
            F.col("batch_id").between(0, TRIGGERS - 1).alias("batch_known"),
        )
    )


def sql_stream_append_scored() -> str:
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META}
SELECT s.experiment, {r6('s.time')} AS timestamp,
       CASE WHEN m.feedrate >= 13 THEN 'worn' WHEN m.feedrate IS NOT NULL THEN 'unworn' END AS tool_condition_prediction,
       m.tool_condition AS tool_condition_true,
       CASE WHEN m.feedrate IS NULL THEN 'clamp_pressure,feedrate' END AS unscoreable, true AS batch_known
FROM mach s LEFT JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0')"""


# ---------------------------------------------------------------------------
# Dataset-note predicates (L1-L3)
# ---------------------------------------------------------------------------
def q_unreliable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.machine_rows(spark, sf_dir)
    return compare_form(rows.where(CL.unreliable(rows)).select("experiment", "M1_sequence_number"))


def sql_unreliable_rows() -> str:
    return f"""WITH {SQL_MACHINE}
SELECT experiment, {r6('M1_sequence_number')} AS M1_sequence_number FROM mach
WHERE M1_CURRENT_FEEDRATE = 50 OR X1_ActualPosition = 198 OR M1_CURRENT_PROGRAM_NUMBER <> 0"""


def q_active_machining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = CL.active_machining(T.machine_rows(spark, sf_dir))
    return compare_form(rows.select("experiment", "M1_sequence_number", "Machining_Process"))


def sql_active_machining() -> str:
    from condmon.schemas import ACTIVE_STAGES

    stages = ", ".join(f"'{s}'" for s in ACTIVE_STAGES)
    return f"""WITH {SQL_MACHINE}
SELECT experiment, {r6('M1_sequence_number')} AS M1_sequence_number, Machining_Process FROM mach
WHERE Machining_Process IN ({stages})"""


def q_elapsed_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample number within each experiment (time order, then id) and the
    elapsed time at the 100 ms sampling period."""
    from condmon.operators.ordinal import ordinal_within

    rows = T.machine_rows(spark, sf_dir).select("experiment", "time", "M1_sequence_number")
    seq = ordinal_within(rows, ["experiment"], ["time", "M1_sequence_number"], name="sample_no")
    out = CL.elapsed_time(seq.withColumn("seq", F.col("sample_no") - 1), "seq")
    return compare_form(out.select("experiment", "M1_sequence_number", "seq", "elapsed_s"))


def sql_elapsed_time() -> str:
    return f"""WITH {SQL_MACHINE},
s AS (SELECT experiment, M1_sequence_number,
             row_number() OVER (PARTITION BY experiment ORDER BY time, M1_sequence_number) - 1 AS seq FROM mach)
SELECT experiment, {r6('M1_sequence_number')} AS M1_sequence_number, seq, {r6('seq * 0.1')} AS elapsed_s FROM s"""


def q_stream_serve_both(spark: SparkSession, sf_dir: str, params: dict | None = None) -> DataFrame:
    """The serving job end to end: both full models (or with ``params``) trained and saved, both
    topics landed in one folder, two independent streaming queries over it
    (J1), awaited together (J7).  One row per snapshot (latest version: a
    prediction exists) and one per tool-wear record and outcome (a count)."""
    from condmon.plans import ml
    from condmon.plans.serving import serve
    from condmon.streaming import bearing as SB

    sup = materialize(_supervised(spark, sf_dir))
    rul_path, wear_path = work_dir(spark, "rul-model"), work_dir(spark, "wear-model")
    ml.save(ml.train_rul(sup, _rul_columns(sup), params=params).model, rul_path)
    ml.save(_train_wear(spark, sf_dir, params).model, wear_path)
    landing, per_trigger = _land(spark, _messages(spark, sf_dir), "serve-landing")
    sinks, ckpts = work_dir(spark, "serve-sinks"), work_dir(spark, "serve-ckpt")
    queries = serve(spark, rul_path, wear_path, sinks, ckpts, path=landing,
                    max_files_per_trigger=per_trigger, available_now=True)
    SB.await_all(queries)
    preds = SB.latest_per_key(SB.read_sink(spark, f"{sinks}/bearing_predictions"), ["test_set", "file"])
    wear = SB.read_sink(spark, f"{sinks}/toolwear_predictions")
    return preds.select(
        "test_set", "file", "timestamp", F.col("rul_prediction").isNotNull().alias("predicted"), F.lit(1).cast("long").alias("rows")
    ).unionByName(
        wear.groupBy(
            F.lit("toolwear").alias("test_set"),
            F.col("experiment").alias("file"),
            F.coalesce("tool_condition_prediction", "unscoreable").alias("timestamp"),
            F.col("tool_condition_prediction").isNotNull().alias("predicted"),
        ).agg(F.count(F.lit(1)).alias("rows"))
    )


def sql_stream_serve_both() -> str:
    return f"""WITH {SQL_SIGNAL},{SQL_MACHINE},{SQL_LOOKUP_META}
SELECT DISTINCT test_set, file, {SQL_PUBLISHED_TS.format(f='file')} AS timestamp, true AS predicted, CAST(1 AS BIGINT) AS rows FROM sig
UNION ALL
SELECT 'toolwear', s.experiment,
       CASE WHEN m.feedrate >= 13 THEN 'worn' WHEN m.feedrate IS NOT NULL THEN 'unworn' ELSE 'clamp_pressure,feedrate' END,
       m.feedrate IS NOT NULL, count(*)
FROM mach s LEFT JOIN lmeta m ON s.experiment = 'experiment_' || lpad(CAST(m.No AS VARCHAR), 6, '0')
GROUP BY ALL"""


# ---------------------------------------------------------------------------
# Raw experiment files
# ---------------------------------------------------------------------------
def _landed_experiments(spark: SparkSession, sf_dir: str) -> str:
    """A folder of experiment CSV files with a header, ten user ids to a file,
    the metadata file beside them, and notes that are neither; landed once per
    application.  In every second file, whose name ends in upper case, columns
    come in another order and ``S1_OutputPower`` lacks."""
    key = (spark.sparkContext.applicationId, "experiments", sf_dir)
    if key in _landed:
        return _landed[key]
    cols = ["time", *PAYLOAD_SENSORS, "M1_CURRENT_PROGRAM_NUMBER", "Machining_Process"]
    other = [c for c in reversed(cols) if c != "S1_OutputPower"]
    rows = T.machine_rows(spark, sf_dir)
    ident = (F.substring("experiment", 12, 6).cast("int") / 10).cast("int")
    even = F.col("id") % 2 == 0
    csv_line = lambda names: F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    name = F.concat(F.lit("experiment_"), F.lpad(F.col("id").cast("string"), 6, "0"), F.when(even, ".csv").otherwise(".CSV"))
    rows = rows.withColumn("id", ident)
    body = rows.select(
        name.alias("name"), F.col("M1_sequence_number").alias("no"), F.when(even, csv_line(cols)).otherwise(csv_line(other)).alias("line")
    )
    heads = rows.select("id").distinct().select(
        name.alias("name"), F.lit(-1.0).alias("no"), F.when(even, ",".join(cols)).otherwise(",".join(other)).alias("line")
    )
    notes = rows.where("id % 7 = 0").select(
        F.regexp_replace(name, "[.].*", ".txt").alias("name"), F.col("M1_sequence_number").alias("no"), F.lit("no,data").alias("line")
    )
    meta = T.lookup_metadata(spark, sf_dir)
    train = meta.select(F.lit(EF.METADATA_FILE).alias("name"), F.col("No").cast("double").alias("no"), csv_line(meta.columns).alias("line"))
    train_head = spark.createDataFrame([(EF.METADATA_FILE, -1e9, ",".join(meta.columns))], train.schema)
    files = body.unionByName(heads).unionByName(notes).unionByName(train).unionByName(train_head)
    root = work_dir(spark, "experiment-files")
    LD.land_files(files.withColumn("folder", F.lit("")), root)
    _landed[key] = root
    return root


def q_experiment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment CSVs under their true names, read by header name, numbered in
    file order and joined to the metadata file of their folder."""
    root = _landed_experiments(spark, sf_dir)
    meta = EF.read_metadata(spark, root)
    out = J.lookup_join(EF.read_experiments(spark, root), meta, "experiment", key_rule="suffix", pad=6)
    out = J.flatten_metadata(out, [c for c in _META_OUT if c != "material"])
    return compare_form(out.withColumn("No", F.col("No").cast("double")))


def sql_experiment_files() -> str:
    cols = ["time", *PAYLOAD_SENSORS, "M1_CURRENT_PROGRAM_NUMBER"]
    sel = ", ".join(
        r6(f"CASE WHEN id % 2 = 0 THEN {c} END" if c == "S1_OutputPower" else f"f.{c}") + f" AS {c}" for c in cols
    )
    return f"""WITH {SQL_MACHINE},{SQL_LOOKUP_META},
f AS (SELECT *, CAST(substr(experiment, 12, 6) AS INTEGER) // 10 AS id FROM mach)
SELECT 'experiment_' || lpad(CAST(id AS VARCHAR), 6, '0') AS experiment,
       row_number() OVER (PARTITION BY id ORDER BY M1_sequence_number) - 1 AS seq, {sel}, Machining_Process,
       CAST(No AS DOUBLE) AS No, {r6('m.feedrate')} AS feedrate, {r6('m.clamp_pressure')} AS clamp_pressure,
       tool_condition, machining_finalized, passed_visual_inspection
FROM f LEFT JOIN lmeta m ON m.No = id"""
