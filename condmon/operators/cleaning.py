"""Row and column hygiene."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.schemas import ACTIVE_STAGES, SAMPLE_PERIOD_S


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column (B15) — all columns, metadata
    included, before narrowing to features."""
    return df.na.drop("any")


def add_absent_columns(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Add each missing column as a constant (B16).  Existing columns —
    and their NULLs — are untouched; this is not ``fillna``."""
    for c in columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(value).cast("double"))
    return df


def existing_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates present in ``df``, in candidate order."""
    cols = [c for c in candidates if c in df.columns]
    if not cols:
        raise ValueError("no candidate feature column is present in the data")
    return cols


def unreliable(df: DataFrame) -> DataFrame:
    """Rows flagged as unreliable by the dataset notes (L1)."""
    cond = F.lit(False)
    if "M1_CURRENT_FEEDRATE" in df.columns:
        cond = cond | (F.col("M1_CURRENT_FEEDRATE") == 50)
    if "X1_ActualPosition" in df.columns:
        cond = cond | (F.col("X1_ActualPosition") == 198)
    if "M1_CURRENT_PROGRAM_NUMBER" in df.columns:
        cond = cond | (F.col("M1_CURRENT_PROGRAM_NUMBER") != 0)
    return F.coalesce(cond, F.lit(False))


def active_machining(df: DataFrame, stage_col: str = "Machining_Process") -> DataFrame:
    """Only samples of active cutting stages (L2)."""
    return df.where(F.col(stage_col).isin(*ACTIVE_STAGES))


def elapsed_time(df: DataFrame, seq_col: str = "seq", period: float = SAMPLE_PERIOD_S) -> DataFrame:
    """Elapsed seconds from the sample number at the fixed sampling period
    (L3); ``seq`` is the 0-based row number within the experiment file."""
    return df.withColumn("elapsed_s", F.col(seq_col).cast("double") * period)
