"""Experiment metadata joins.

* ``lookup_join`` — key lookup: the metadata's key column is its first
  column named in ``METADATA_KEY_CANDIDATES``; a sample matches when the
  key, cast to string, equals its experiment id; the first metadata row per
  key wins (by ``No``); unmatched samples keep going with NULL metadata.
  ``key_rule="suffix"`` instead builds ``experiment_<No zero-padded>``, the
  pairing the shipped data needs (its key column ``No`` is not a
  candidate, so the exact rule matches nothing).
* ``ordinal_join`` — the i-th experiment by name gets the i-th metadata row
  by ``No``, up to the shorter side; metadata columns overwrite sample
  columns of the same name.  Sides of different length give a warning, and
  ``unpaired`` names what is past the shorter one.

No side is hinted: AQE broadcasts the metadata when it measures small (in
bytes) at run time, and splits a hot experiment when it does not.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.operators.ordinal import ordinal_within
from condmon.schemas import METADATA_KEY_CANDIDATES

def metadata_key_column(meta: DataFrame, candidates: Sequence[str] = METADATA_KEY_CANDIDATES) -> str | None:
    """First metadata column (in column order) whose name is a candidate."""
    for c in meta.columns:
        if c in candidates:
            return c
    return None


def metadata_keys(meta: DataFrame, key_rule: str = "exact", pad: int = 2, no_col: str = "No") -> DataFrame | None:
    """Metadata with a string ``_key``; ``None`` when no key can be formed."""
    if key_rule == "exact":
        key_col = metadata_key_column(meta)
        if key_col is None:
            return None
        key = F.col(key_col).cast("string")
    elif key_rule == "suffix":
        key = F.concat(F.lit("experiment_"), F.lpad(F.col(no_col).cast("string"), pad, "0"))
    else:
        raise ValueError("key_rule must be 'exact' or 'suffix'")
    return meta.withColumn("_key", key)


def first_per_key(keyed: DataFrame, order_col: str | None = "No", key_col: str = "_key") -> DataFrame:
    """One metadata row per key: the lowest ``order_col`` (E3), ties and a
    missing ``order_col`` settled by the other columns.

    ``min_by`` over a struct is an ordinary aggregate, so duplicates of a
    key are reduced with partial aggregation rather than a window.
    """
    cols = [c for c in keyed.columns if c != key_col]
    first = [order_col] if order_col and order_col in cols else []
    order = F.struct(*first, *[c for c in cols if c not in first])
    return keyed.groupBy(key_col).agg(F.min_by(F.struct(*cols), order).alias("metadata"))


def lookup_join(
    samples: DataFrame,
    meta: DataFrame,
    experiment_col: str = "experiment",
    key_rule: str = "exact",
    pad: int = 2,
) -> DataFrame:
    """Samples plus a ``metadata`` struct column (NULL when unmatched)."""
    keyed = metadata_keys(meta, key_rule, pad)
    struct_type = F.struct(*[F.col(c) for c in meta.columns])
    if keyed is None:
        # no key column: nothing matches, every sample goes on without metadata
        empty = meta.select(struct_type.alias("metadata")).limit(0)
        return samples.withColumn("metadata", F.lit(None).cast(empty.schema["metadata"].dataType))
    firsts = first_per_key(keyed)
    joined = samples.join(firsts, samples[experiment_col] == firsts["_key"], "left")
    return joined.drop("_key")


def ordinal_join(
    samples: DataFrame,
    meta: DataFrame,
    experiment_col: str = "experiment",
    order_col: str = "No",
) -> DataFrame:
    """Attach the i-th metadata row (by ``order_col``) to the samples of the
    i-th experiment (by name); experiments past the shorter side drop out.

    Both ordinal sides are distinct experiments and metadata rows, numbered
    with ``ordinal_within`` (no single-task window); the pairing is then a
    join on the ordinal, and the samples join the pairing on the
    experiment.  Sides of different length give a warning, as the longer
    one's last rows are not used.
    """
    exps, meta_ord = _ordinal_sides(samples, meta, experiment_col, order_col)
    n_exps, n_meta = exps.count(), meta_ord.count()
    if n_exps != n_meta:
        warnings.warn(
            f"{n_exps} experiments and {n_meta} metadata rows: only the first {min(n_exps, n_meta)} are paired",
            stacklevel=2,
        )
    pairing = exps.join(meta_ord, "_ord").drop("_ord")
    overlap = [c for c in meta.columns if c in samples.columns and c != experiment_col]
    base = samples.drop(*overlap)
    pairing = pairing.drop(*[c for c in pairing.columns if c != experiment_col and c not in meta.columns])
    return base.join(pairing, experiment_col)


def _ordinal_sides(
    samples: DataFrame, meta: DataFrame, experiment_col: str, order_col: str
) -> tuple[DataFrame, DataFrame]:
    """Experiments and metadata rows, each numbered in ``_ord`` from 1."""
    exps = ordinal_within(samples.select(experiment_col).distinct(), [], [experiment_col], name="_ord")
    return exps, ordinal_within(meta, [], [order_col], name="_ord")


def unpaired(
    samples: DataFrame, meta: DataFrame, experiment_col: str = "experiment", order_col: str = "No"
) -> DataFrame:
    """What ``ordinal_join`` leaves out: ``ordinal``, ``side``
    (``'experiment'`` or ``'metadata'``), the experiment's name or the metadata
    row's ``order_col``.  A full outer pairing of the two numbered sides."""
    exps, meta_ord = _ordinal_sides(samples, meta, experiment_col, order_col)
    left = exps.select(F.col("_ord").alias("ordinal"), F.col(experiment_col), F.lit(True).alias("_e"))
    right = meta_ord.select(F.col("_ord").alias("ordinal"), F.col(order_col), F.lit(True).alias("_m"))
    both = left.join(right, "ordinal", "full_outer")
    return both.where("_e IS NULL OR _m IS NULL").select(
        "ordinal", F.when(F.col("_m").isNull(), "experiment").otherwise("metadata").alias("side"), experiment_col, order_col
    )


def flatten_metadata(df: DataFrame, meta_cols: Sequence[str], struct_col: str = "metadata") -> DataFrame:
    """``metadata`` struct to columns (metadata wins on a name clash)."""
    base = [c for c in df.columns if c != struct_col and c not in meta_cols]
    return df.select(*base, *[F.col(f"{struct_col}.{c}").alias(c) for c in meta_cols])
