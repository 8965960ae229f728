"""Remaining-useful-life training table.

From one feature row per snapshot:

* order snapshots of a test set by their parsed time; if any file name of
  the set does not parse, the whole set falls back to name order (G2);
* ``cycle`` = 1..N in that order, ``rul = N - cycle + 1`` (E1, E2);
* keep the failing bearing's ``max, p2p, rms`` per set (H3, B14), align the
  sets on the sorted union of their columns with absent columns as 0.0 —
  NULL values stay NULL (B16) — and stack them (H1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.functions.timestamps import snapshot_time
from condmon.operators.keys import join_null_safe
from condmon.operators.ordinal import ordinal_within
from condmon.schemas import FAILING_BEARING, RUL_FEATURES
from condmon.session import materialize


def rul_cycles(
    feats: DataFrame,
    set_col: str = "test_set",
    file_col: str = "file",
    time_col: str | None = None,
) -> DataFrame:
    """Add ``event_ts`` (if absent), ``cycle`` and ``rul`` per test set.

    The input (one row per snapshot) is checkpointed first: it feeds both
    the per-set parse check and the ordinal pass.
    """
    feats = materialize(feats)
    if time_col is None:
        if "event_ts" not in feats.columns:
            feats = feats.withColumn("event_ts", snapshot_time(file_col))
        time_col = "event_ts"
    bad = feats.groupBy(set_col).agg(
        F.sum(F.col(time_col).isNull().cast("long")).alias("_bad_in_set")
    )
    with_bad = join_null_safe(feats, bad, [set_col])
    sort_time = F.when(F.col("_bad_in_set") == 0, F.col(time_col))
    out = ordinal_within(
        with_bad.withColumn("_sort_t", sort_time),
        [set_col],
        ["_sort_t", file_col],
        name="cycle",
        total_name="_n",
    )
    return out.withColumn("rul", F.col("_n") - F.col("cycle") + 1).drop("_n", "_sort_t", "_bad_in_set")


def aligned_columns(
    present_sets: Sequence[str],
    mapping: Mapping[str, str] = FAILING_BEARING,
    features: Sequence[str] = RUL_FEATURES,
    available: Sequence[str] | None = None,
) -> list[str]:
    """Sorted union of the feature columns of the present sets."""
    cols = set()
    for s in present_sets:
        if s in mapping:
            for f in features:
                c = f"{mapping[s]}{f}"
                if available is None or c in available:
                    cols.add(c)
    return sorted(cols)


def rul_supervised(
    cycles: DataFrame,
    mapping: Mapping[str, str] = FAILING_BEARING,
    features: Sequence[str] = RUL_FEATURES,
    set_col: str = "test_set",
    present_sets: Sequence[str] | None = None,
    keep: Sequence[str] = ("test_set", "file"),
) -> DataFrame:
    """Aligned supervised table: sorted feature columns, then ``rul``.

    One pass over all sets: each output column takes the set's own value
    where the column belongs to the set's failing bearing, 0.0 otherwise.
    ``present_sets`` defaults to the sets found in the data (a distinct
    over at most ``len(mapping)`` names).
    """
    rows = cycles.where(F.col(set_col).isin(list(mapping)))
    if present_sets is None:
        present_sets = [r[0] for r in rows.select(set_col).distinct().collect()]
    cols = aligned_columns(present_sets, mapping, features, cycles.columns)
    out = []
    for c in cols:
        owners = [s for s, p in mapping.items() if c.startswith(p) and s in present_sets]
        out.append(F.when(F.col(set_col).isin(owners), F.col(c)).otherwise(F.lit(0.0)).alias(c))
    return rows.select(*[k for k in keep if k in cycles.columns], *out, F.col("rul"))
