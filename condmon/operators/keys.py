"""Key helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with ``<=>``, keeping one copy of each key.

    NULL keys match each other, and the optimizer infers no ``isnotnull``
    filter into one branch only — so two branches that aggregate the same
    rows stay identical and Spark reuses their shuffle instead of scanning
    the input twice.
    """
    keys = list(keys)
    r = right.select(
        *[F.col(k).alias(f"_rk_{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    cond = [left[k].eqNullSafe(r[f"_rk_{i}"]) for i, k in enumerate(keys)]
    return left.join(r, cond, how).drop(*[f"_rk_{i}" for i in range(len(keys))])
