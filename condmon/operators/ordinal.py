"""Dense 1..N ordinals within groups, without a whole-group window.

``row_number().over(Window.partitionBy(g).orderBy(o))`` puts every row of
a group in one task.  When a group can hold a large share of all rows (a
test set holds a third of all snapshots), ``ordinal_within`` instead:

1. range-partitions the rows by ``(group, order)`` — a hot group spreads
   over many partitions — and sorts inside each partition;
2. tags each row with its partition id and a position
   (``monotonically_increasing_id`` is consecutive within a partition) and
   checkpoints the result, so the tags are fixed even if a task reruns;
3. aggregates per ``(partition, group)`` block the first position and the
   row count (at most partitions + groups rows), and turns them into a
   per-block offset with a running sum over the blocks of each group;
4. joins the offsets back (a small side) — ``ordinal = offset + position
   - first + 1``.  The group total ``N`` comes from the same blocks.

The order columns must make rows unique within a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from condmon.operators.keys import join_null_safe
from condmon.session import materialize


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def ordinal_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence,
    name: str = "ordinal",
    total_name: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1..N in ``order_cols`` order within ``group_cols``
    (and ``total_name`` = N when given)."""
    group_cols = list(group_cols)
    order = _cols(order_cols)
    sort_key = [F.col(c) for c in group_cols] + order
    parts = [num_partitions] if num_partitions else []
    tagged = (
        df.repartitionByRange(*parts, *sort_key)
        .sortWithinPartitions(*sort_key)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    tagged = materialize(tagged)
    blocks = tagged.groupBy("_pid", *group_cols).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
    if total_name:
        blocks = blocks.withColumn("_total", F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    out = join_null_safe(tagged, blocks, ["_pid", *group_cols])  # a NULL group is a group
    out = out.withColumn(name, (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("long"))
    if total_name:
        out = out.withColumn(total_name, F.col("_total").cast("long"))
    return out.drop("_pid", "_pos", "_first", "_cnt", "_before", "_total")


def first_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of each group in ``order_cols`` order.

    Rows are cut to ``k`` per group inside slices of the group first (slices
    by a hash of the whole row, so a hot group has as many as the shuffle has
    partitions), then to ``k`` of at most ``k`` per slice.
    """
    group_cols, order = list(group_cols), _cols(order_cols)
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
    few = sliced.withColumn(
        "_k_ord", F.row_number().over(Window.partitionBy(*group_cols, "_slice").orderBy(*order))
    ).where(F.col("_k_ord") <= k)
    first = few.withColumn("_k_ord", F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order)))
    return first.where(F.col("_k_ord") <= k).drop("_k_ord", "_slice")
