"""Histogram Shannon entropy per group and channel.

Equal-width bins over ``[min, max]`` of the group (``[v-0.5, v+0.5]`` for
a constant group), natural log, NumPy's bin rule including its edge fix-up:

    i = min(floor((x - lo) / (hi - lo) * bins), bins - 1)
    i -= 1            if x <  edge(i)
    i += 1            if x >= edge(i + 1) and i != bins - 1
    edge(k) = k * ((hi - lo) / bins) + lo

Plan (no UDF, no window over a whole group):

1. ``key -> lo, hi, n, rows`` (one partially aggregated pass, small);
2. the samples join (1) on the key — AQE broadcasts (1) when it measures
   small and splits a hot key otherwise — and get their bin;
3. ``(key, bin) -> count``: partial aggregation leaves at most ``bins`` rows
   per key and task, so the samples are not shuffled again;
   ``H = -sum(p ln p)`` per key.

A group with a NULL (NaN) sample gets NULL: the histogram of a series with
NaN is undefined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from condmon.operators.keys import join_null_safe
from condmon.schemas import ENTROPY_BINS


def widened(lo: Column, hi: Column) -> tuple[Column, Column]:
    """The range of a histogram over ``lo..hi``: one wide if it is a point."""
    flat = lo == hi
    return F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi)


def with_bins(df: DataFrame, bins_of: dict, bins: int = ENTROPY_BINS) -> DataFrame:
    """Adds, per name in ``bins_of``, the bin number of a sample ``x`` in the
    ``widened`` range ``lo..hi``, all three given as columns' names.

    The first guess may be one off by rounding and is compared with the edges
    of its bin.  It is a column of its own, as an expression in which it stood
    several times would be evaluated as often.
    """
    first, down, last = {}, {}, {}
    for name, (x, lo, hi) in bins_of.items():
        x, lo, hi = F.col(x), F.col(lo), F.col(hi)
        step = (hi - lo) / bins
        guess = F.col(f"_first_{name}")
        first[f"_first_{name}"] = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
        down[f"_down_{name}"] = guess - (x < guess * step + lo).cast("int")
        low = F.col(f"_down_{name}")
        last[name] = low + ((low != bins - 1) & (x >= (low + 1) * step + lo)).cast("int")
    return df.withColumns(first).withColumns(down).withColumns(last).drop(*first, *down)


def plogp(count: Column, n: Column) -> Column:
    p = count / n
    return p * F.log(p)


def histogram_entropy(
    long_df: DataFrame, keys: Sequence[str], value: str = "x", bins: int = ENTROPY_BINS
) -> DataFrame:
    """Entropy per ``keys`` of the samples in column ``value``.

    ``long_df`` holds one sample per row; ``keys`` usually ends with the
    channel column.  Returns ``(keys..., entropy)``.
    """
    keys = list(keys)
    x = F.col(value)
    stats = long_df.groupBy(*keys).agg(
        F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    lo, hi = widened(F.col("_lo"), F.col("_hi"))
    stats = stats.withColumns({"_lo": lo, "_hi": hi})
    binned = with_bins(join_null_safe(long_df, stats, keys), {"_bin": (value, "_lo", "_hi")}, bins)
    hist = binned.groupBy(*keys, "_n", "_rows", "_bin").agg(F.count(F.lit(1)).alias("_cnt"))
    # NULL samples are a NULL bin, so that every group keeps a row
    ent = hist.groupBy(*keys).agg(
        (-F.sum(F.when(F.col("_bin").isNotNull(), plogp(F.col("_cnt"), F.col("_n")))) + 0.0).alias("entropy"),
        F.max("_n").alias("_n"),
        F.max("_rows").alias("_rows"),
    )
    return ent.select(
        *keys,
        F.when(F.col("_n") < F.col("_rows"), F.lit(None).cast("double")).otherwise(F.col("entropy")).alias("entropy"),
    )


def channel_range_aggs(channels: Sequence[str]) -> list:
    """Per-channel range statistics as aggregate expressions, to ride along
    in a wide ``groupBy(key).agg(...)``."""
    out = [F.count(F.lit(1)).alias("_rows")]
    for ch in channels:
        out += [
            F.min(ch).alias(f"_lo_{ch}"),
            F.max(ch).alias(f"_hi_{ch}"),
            F.count(ch).alias(f"_n_{ch}"),
            F.sum(ch).alias(f"_sx_{ch}"),
        ]
    return out
