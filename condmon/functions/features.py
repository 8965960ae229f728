"""Time-domain vibration features as aggregate Column builders.

Every builder returns an aggregate expression over one channel column, to
be used inside ``groupBy(...).agg(...)`` with any group key (a snapshot
file, a test set, a window).  All are built-in Spark aggregates, so they
run with partial (map-side) aggregation and whole-stage codegen; a hot
group costs no more than a cold one.

NULL rules follow the batch code being reproduced:

* ``mean``/``std``/``skew``/``kurtosis``/``max``/``p2p``/``clearance`` skip
  NULL samples (pandas skipna);
* batch ``rms`` is NULL when any sample of the channel is NULL (NumPy sum)
  and divides by the number of rows, NULLs included;
* ratios whose denominator is 0 are NULL (``try_divide``; plain division
  raises under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def n_rows() -> Column:
    """Rows in the group, NULL samples included."""
    return F.count(F.lit(1))


def mean_abs(x) -> Column:
    """``mean`` feature: the mean of absolute values."""
    return F.avg(F.abs(_c(x)))


def std(x) -> Column:
    """Sample standard deviation (ddof 1); NULL for one sample."""
    return F.stddev_samp(_c(x))


def _zero_small(c: Column) -> Column:
    """pandas' guard against rounding: sums below 1e-14 count as zero."""
    return F.when(F.abs(c) < 1e-14, F.lit(0.0)).otherwise(c)


def skew_from_sums(n: Column, m2: Column, m3: Column) -> Column:
    """Bias-corrected sample skewness as pandas computes it, from the count
    and the sums of squared and cubed deviations; NULL below 3 samples, 0
    where the squares count as zero."""
    m2, m3 = _zero_small(m2), _zero_small(m3)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(m2 == 0, F.lit(0.0))
        .otherwise(F.try_divide(n * F.sqrt(n - 1), n - 2) * F.try_divide(m3, F.pow(m2, 1.5)))
    )


def kurtosis_from_sums(n: Column, m2: Column, m4: Column) -> Column:
    """Bias-corrected excess kurtosis as pandas computes it, from the count
    and the sums of squares and fourth powers of the deviations; NULL below 4
    samples, 0 where the denominator counts as zero."""
    top = _zero_small(n * (n + 1) * (n - 1) * m4)
    bottom = _zero_small((n - 2) * (n - 3) * m2 * m2)
    adjust = F.try_divide(3 * (n - 1) * (n - 1), (n - 2) * (n - 3))
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(bottom == 0, F.lit(0.0))
        .otherwise(F.try_divide(top, bottom) - adjust)
    )


def _squares(x: Column, n: Column) -> Column:
    """Sum of squared deviations; exactly 0 for a constant channel."""
    return F.when(F.max(x) == F.min(x), F.lit(0.0)).otherwise(F.var_pop(x) * n)


def skew(x) -> Column:
    x = _c(x)
    n = F.count(x).cast("double")
    m2 = _squares(x, n)
    return skew_from_sums(n, m2, F.skewness(x) * n * F.pow(F.var_pop(x), 1.5))


def kurtosis(x) -> Column:
    x = _c(x)
    n = F.count(x).cast("double")
    m2 = _squares(x, n)
    return kurtosis_from_sums(n, m2, (F.kurtosis(x) + 3) * n * F.var_pop(x) * F.var_pop(x))


def rms_batch(x) -> Column:
    """``sqrt(sum(x^2) / rows)``; NULL if any sample is NULL."""
    x = _c(x)
    return F.when(F.count(x) < n_rows(), F.lit(None).cast("double")).otherwise(
        F.sqrt(F.sum(x * x) / n_rows())
    )


def rms_stream(x) -> Column:
    """``sqrt(avg(x^2))`` — NULL samples are skipped."""
    x = _c(x)
    return F.sqrt(F.avg(x * x))


def max_abs(x) -> Column:
    """``max`` feature: largest absolute value."""
    return F.max(F.abs(_c(x)))


def p2p_batch(x) -> Column:
    """Batch peak-to-peak as computed in training: ``|max| + |min|``."""
    x = _c(x)
    return F.abs(F.max(x)) + F.abs(F.min(x))


def p2p_stream(x) -> Column:
    """Serving peak-to-peak: ``max(|x|) + |min(x)|``."""
    x = _c(x)
    return F.max(F.abs(x)) + F.abs(F.min(x))


def crest(x) -> Column:
    return F.try_divide(max_abs(x), rms_batch(x))


def clearance(x) -> Column:
    """``(sum(sqrt|x|) / rows)^2`` — the sum skips NULLs, rows do not."""
    x = _c(x)
    return F.pow(F.coalesce(F.sum(F.sqrt(F.abs(x))), F.lit(0.0)) / n_rows(), 2)


def shape(x) -> Column:
    return F.try_divide(rms_batch(x), mean_abs(x))


def impulse(x) -> Column:
    return F.try_divide(max_abs(x), mean_abs(x))


# feature name -> builder; entropy is not a single aggregate (see
# ``operators.entropy``) and is absent here.
BATCH_BUILDERS = {
    "mean": mean_abs,
    "std": std,
    "skew": skew,
    "kurtosis": kurtosis,
    "rms": rms_batch,
    "max": max_abs,
    "p2p": p2p_batch,
    "crest": crest,
    "clearance": clearance,
    "shape": shape,
    "impulse": impulse,
}

STREAM_BUILDERS = {
    "max": max_abs,
    "p2p": p2p_stream,
    "rms": rms_stream,
}


def feature_aggs(channels, features, builders=None) -> list[Column]:
    """Aggregate expressions ``{channel}_{feature}`` for each pair."""
    builders = builders or BATCH_BUILDERS
    out = []
    for ch in channels:
        for f in features:
            if f in builders:
                out.append(builders[f](ch).alias(f"{ch}_{f}"))
    return out


def nan_to_null(x) -> Column:
    """NaN samples become NULL at ingest so Spark aggregates skip them."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
