"""Snapshot feature tables.

``snapshot_features`` is one ``groupBy(key).agg(...)`` with every
requested feature of every channel: a single hash aggregation with partial
aggregation before its one shuffle.  ``feature_table`` adds the histogram
entropy (a separate composite, see ``operators.entropy``) and the typed
snapshot time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.functions import features as FX
from condmon.functions.timestamps import snapshot_time
from condmon.operators.entropy import channel_range_aggs, widened, with_bins
from condmon.operators.keys import join_null_safe
from condmon.session import stage
from condmon.schemas import BATCH_FEATURES, CHANNELS, ENTROPY_BINS, STREAM_FEATURES

SNAPSHOT_KEY = ("test_set", "file")


def snapshot_features(
    rows: DataFrame,
    keys: Sequence[str] = SNAPSHOT_KEY,
    channels: Sequence[str] = CHANNELS,
    features: Sequence[str] = tuple(f for f in BATCH_FEATURES if f != "entropy"),
    builders=None,
) -> DataFrame:
    """``{channel}_{feature}`` per group, one aggregation pass."""
    return rows.groupBy(*keys).agg(*FX.feature_aggs(channels, features, builders))


def stream_features(
    rows: DataFrame,
    keys: Sequence[str] = SNAPSHOT_KEY,
    channels: Sequence[str] = CHANNELS,
    time_col: str = "timestamp",
) -> DataFrame:
    """Serving features ``max, p2p, rms`` per snapshot (D1, D3-D5), with one
    published timestamp per snapshot (D2): the smallest, which is the same as
    the first where, as published, a snapshot has a single one.  Works on batch
    and streaming DataFrames alike."""
    aggs = FX.feature_aggs(channels, STREAM_FEATURES, FX.STREAM_BUILDERS)
    out = rows.groupBy(*keys).agg(F.min(time_col).alias(time_col), *aggs)
    return out.select(*keys, *[c for c in out.columns if c not in keys])


def feature_table(
    rows: DataFrame,
    keys: Sequence[str] = SNAPSHOT_KEY,
    channels: Sequence[str] = CHANNELS,
    file_col: str = "file",
    checkpoint: bool = True,
    bins: int = ENTROPY_BINS,
) -> DataFrame:
    """Full batch feature table (D18): 12 features x channels per snapshot,
    plus ``event_ts`` parsed from the file name.

    Two passes over the samples:

    1. one aggregation per snapshot with the plain features (mean of
       ``|x|``, rms, max, peak-to-peak, clearance and the ratios) and the
       per-channel count, sum, min and max; this table (one row per
       snapshot) is numbered and written, so that its size is known;
    2. the wide sample rows meet its ranges and sums once more, for the central
       sums ``(x - mean)^2..4`` of all channels (the two-pass moments std, skew
       and kurtosis as pandas computes them) in one aggregation per snapshot,
       and for the histograms: only (snapshot number, channel and bin in one
       integer) is exploded and counted, at most ``bins`` rows per channel and
       task after partial aggregation.

    The join of the samples to (1) is a broadcast while that table measures
    small, else a shuffle of the samples on the snapshot key, which AQE splits
    where a snapshot is hot.  The results are joined per snapshot.
    """
    keys = list(keys)
    plain = [f for f in BATCH_FEATURES if f not in ("entropy", "std", "skew", "kurtosis")]
    moments = rows.groupBy(*keys).agg(*FX.feature_aggs(channels, plain), *channel_range_aggs(channels))
    ident = keys
    if checkpoint:
        moments = stage(moments.withColumn("_id", F.monotonically_increasing_id()), "moments")
        ident = ["_id"]
    stats = moments.select(*dict.fromkeys([*keys, *ident]), *[f"_{s}_{ch}" for ch in channels for s in ("n", "sx")], *[
        c.alias(n) for ch in channels
        for n, c in zip((f"_lo_{ch}", f"_hi_{ch}"), widened(F.col(f"_lo_{ch}"), F.col(f"_hi_{ch}")), strict=True)
    ])
    wide = join_null_safe(rows.select(*keys, *channels), stats, keys)
    central = []
    for ch in channels:
        d = F.col(ch) - F.try_divide(F.col(f"_sx_{ch}"), F.col(f"_n_{ch}"))
        central += [F.sum(p).alias(f"_m{i}_{ch}") for i, p in ((2, d * d), (3, d * d * d), (4, d * d * d * d))]
    central = wide.groupBy(*ident).agg(*central)
    binned = with_bins(wide, {f"_bin_{ch}": (ch, f"_lo_{ch}", f"_hi_{ch}") for ch in channels}, bins)
    codes = F.array(*[F.col(f"_bin_{ch}") + i * bins for i, ch in enumerate(channels)])
    counted = binned.select(*ident, F.explode(codes).alias("_code")).where("_code IS NOT NULL")
    counted = counted.groupBy(*ident, "_code").agg(F.count(F.lit(1)).alias("_c"))
    clogc = F.col("_c") * F.log(F.col("_c"))
    hists = counted.groupBy(*ident).agg(
        *[F.sum(F.when(F.floor(F.col("_code") / bins) == i, clogc)).alias(f"_clogc_{ch}") for i, ch in enumerate(channels)]
    )
    out = join_null_safe(join_null_safe(moments, central, ident, "left"), hists, ident, "left")
    select = [*keys]
    if file_col in keys:
        select.append(snapshot_time(file_col).alias("event_ts"))
    cols = []
    for ch in channels:
        derived = _two_pass_features(ch)
        for f in BATCH_FEATURES:
            cols.append(derived[f].alias(f"{ch}_{f}") if f in derived else F.col(f"{ch}_{f}"))
    return out.select(*select, *cols)


def _two_pass_features(ch: str) -> dict:
    """std, skew, kurtosis and entropy of one channel from its count, range,
    central sums and the sum of ``c * ln(c)`` over its bin counts."""
    n = F.col(f"_n_{ch}").cast("double")
    rows = F.col("_rows").cast("double")
    flat = F.col(f"_hi_{ch}") == F.col(f"_lo_{ch}")
    m2, m3, m4 = (F.when(flat, F.lit(0.0)).otherwise(F.col(f"_m{i}_{ch}")) for i in (2, 3, 4))
    return {
        "std": F.when(n >= 2, F.sqrt(m2 / (n - 1))),
        "skew": FX.skew_from_sums(n, m2, m3),
        "kurtosis": FX.kurtosis_from_sums(n, m2, m4),
        "entropy": F.when((n == rows) & (n > 0), F.log(n) - F.col(f"_clogc_{ch}") / n + 0.0),
    }
