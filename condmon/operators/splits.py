"""Deterministic train/test splits (K1, K2).

A row's place is fixed by a hash of its key and the seed:
``h = first 32 bits of md5(key | seed)``.  The ``ceil(fraction * N)`` rows
with the lowest ``(h, key)`` of each stratum are the test set — an exact
size, independent of partitioning and reproducible in SQL.  Rows with equal
keys on the boundary are told apart by their place in a written copy.

No global sort: the hash range is cut into about ``sqrt(N)`` buckets; bucket
counts per stratum give a running total that finds the one boundary bucket
per stratum; only that bucket's rows (about ``sqrt(N)``) are ranked, to find
the last test row, and every row is then compared with it map-side.

With ``group_col`` whole groups (experiments) go to one side, so no group is
learned from and tested on.  The rows are reduced to one row per group, and the
running totals of the group sizes are taken inside hash buckets, offset by one
row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from condmon.operators.keys import join_null_safe
from condmon.session import materialize

#: Cutoffs (one row per stratum) that a split sends to its tasks; more are joined by stratum.
SENT_CUTOFFS = 100_000


def key_hash(key_cols: Sequence[str], seed: int = 42) -> Column:
    """``md5(k1|k2|...|seed)`` -> unsigned 32-bit integer as BIGINT."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_split(
    df: DataFrame,
    key_cols: Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    strata: Sequence[str] = (),
    split_col: str = "split",
    group_col: str | None = None,
) -> DataFrame:
    """Add ``split`` = ``'test'`` / ``'train'``; ``strata`` makes the split
    stratified (each stratum, NULL included, gets ``ceil(fraction *
    N_stratum)`` test rows).

    Passes, none shuffling all rows: the row count; bucket counts (partially
    aggregated); the cutoff ``(h, key)`` taken from the rows of each
    stratum's boundary bucket only; and a map-side comparison of every row
    with its stratum's cutoff (a table of one row per stratum, sent to the
    tasks: joined by a few strata, all rows would meet in as many tasks).
    Beyond ``SENT_CUTOFFS`` strata the rows are joined with it by stratum.
    When the boundary cuts through rows with equal keys, a written copy of the
    rows tells them apart.

    With ``group_col`` the rows of a group stay together and ``key_cols`` are
    not looked at: see ``group_split``.
    """
    if group_col is not None:
        sides = group_split(df, group_col, test_fraction, seed, strata, split_col)
        return join_null_safe(df, sides, [group_col])
    # without strata every row is in one stratum
    strata = list(strata)
    bits = min(32, max(1, (df.count().bit_length() + 1) // 2))
    order = F.struct(F.col("_h"), *[F.col(c) for c in key_cols])
    hb = df.withColumn("_h", key_hash(key_cols, seed)).withColumn("_b", F.shiftright("_h", 32 - bits))
    part = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    counts = hb.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    upto = part.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (
        counts.withColumn("_cum", F.sum("_c").over(upto))
        .withColumn("_n", F.sum("_c").over(part))
        .withColumn("_k", F.ceil(F.lit(test_fraction) * F.col("_n")))
    )
    # boundary bucket: the first whose running total reaches k (none if k = 0);
    # ``_take`` of its rows are test rows
    edge = counts.where(
        (F.col("_k") > 0) & (F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k"))
    ).select(*strata, "_b", (F.col("_k") - F.col("_cum") + F.col("_c")).alias("_take"))
    # count the boundary buckets by key; the cutoff is the key at which the
    # running total reaches ``_take``, and ``_need`` of its ``_same`` rows are test rows
    keyed = join_null_safe(hb, edge, [*strata, "_b"]).groupBy(*strata, "_b", "_take", order.alias("_cut"))
    keyed = keyed.agg(F.count(F.lit(1)).alias("_same"))
    upto = part.orderBy("_cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cutoff = (
        keyed.withColumn("_cum", F.sum("_same").over(upto))
        .where((F.col("_cum") >= F.col("_take")) & (F.col("_cum") - F.col("_same") < F.col("_take")))
        .select(*strata, F.col("_b").alias("_eb"), "_cut", "_same",
                (F.col("_take") - F.col("_cum") + F.col("_same")).alias("_need"))
    )
    cutoff = materialize(cutoff)
    found = cutoff.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("_need < _same")).alias("ties")).first()
    ties = bool(found["ties"])
    rows = materialize(hb.withColumn("_row", F.monotonically_increasing_id())) if ties else hb
    sent = F.broadcast(cutoff) if strata and found["n"] <= SENT_CUTOFFS else cutoff
    tagged = _with_cutoff(rows, sent, strata, key_cols)
    below = (F.col("_b") < F.col("_eb")) | ((F.col("_b") == F.col("_eb")) & (order < F.col("_cut")))
    equal = (F.col("_b") == F.col("_eb")) & order.eqNullSafe(F.col("_cut"))
    if ties:
        nth = _ordinal_of_equal(tagged.where(equal).select(*strata, "_row"), strata)
        tagged = tagged.join(nth.select("_row", "_nth"), "_row", "left")
        equal = equal & (F.col("_nth") <= F.col("_need"))
    is_test = F.coalesce(below | equal, F.lit(False))
    out = tagged.withColumn(split_col, F.when(is_test, "test").otherwise("train"))
    return out.drop("_h", "_b", "_eb", "_cut", "_same", "_need", "_row", "_nth")


def group_split(
    df: DataFrame,
    group_col: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    strata: Sequence[str] = (),
    split_col: str = "split",
) -> DataFrame:
    """``group_col, split``: the side of each group (NULL is a group), one row
    per group.

    Groups are taken in the order of their hash; a group is a test group while
    the middle of its rows, in the running total of its stratum, lies within
    ``ceil(fraction * N_stratum)`` — the whole groups whose total is nearest to
    that share.  Groups larger than the share come after all others, so a
    group with a third of all rows is tested on only where smaller ones do not
    fill the share.  A group whose rows lie in several strata counts in the
    least of them (NULLs first).
    """
    names = [f"_s{i}" for i in range(len(strata))]
    aggs = [F.count(F.lit(1)).alias("_size")]
    if names:
        aggs.append(F.min(F.struct(*[F.col(c).alias(n) for n, c in zip(names, strata, strict=True)])).alias("_least"))
    groups = df.groupBy(group_col).agg(*aggs)
    groups = materialize(groups.select(group_col, "_size", *[f"_least.{n}" for n in names]))
    target = F.ceil(F.lit(test_fraction) * F.sum("_size")).alias("_k")
    if names:
        groups = join_null_safe(groups, groups.groupBy(*names).agg(target), names)
    else:
        groups = groups.withColumn("_k", F.lit(groups.agg(target).first()["_k"]))
    bits = min(31, max(1, (groups.count().bit_length() + 1) // 2))
    late = (F.col("_size") > F.col("_k")).cast("bigint")
    groups = groups.withColumn("_h", key_hash([group_col], seed)).withColumn(
        "_b", F.shiftleft(late, bits) + F.shiftright("_h", 32 - bits)
    )
    whole = Window.partitionBy(*(names or [F.lit(0)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = groups.groupBy(*names, "_b").agg(F.sum("_size").alias("_n"))
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(whole), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*names, "_b").orderBy("_h", group_col).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    ranked = join_null_safe(groups, blocks, [*names, "_b"])
    middle = 2 * (F.col("_off") + F.col("_in")) + F.col("_size")
    return ranked.select(group_col, F.when(middle <= 2 * F.col("_k"), "test").otherwise("train").alias(split_col))


def _with_cutoff(rows: DataFrame, cutoff: DataFrame, strata: list, key_cols: Sequence[str]) -> DataFrame:
    """Every row with its stratum's cutoff; without strata the one cutoff row
    becomes literals rather than a join without a key."""
    if strata:
        return join_null_safe(rows, cutoff, strata, "left")
    row = cutoff.first()
    fields = {f.name: f.dataType for f in cutoff.schema.fields}
    if row is None:
        return rows.withColumns({c: F.lit(None).cast(t) for c, t in fields.items()})
    types = {f.name: f.dataType for f in fields["_cut"].fields}
    cut = F.struct(*[F.lit(row["_cut"][c]).cast(types[c]).alias(c) for c in ("_h", *key_cols)])
    return rows.withColumns({"_cut": cut, **{c: F.lit(row[c]).cast(fields[c]) for c in ("_eb", "_same", "_need")}})


def _ordinal_of_equal(rows: DataFrame, strata: list) -> DataFrame:
    """1-based ``_nth`` of rows within their stratum in the order of ``_row``
    (whose high bits are the partition): ranked inside a partition's share,
    with offsets from one row per partition."""
    rows = rows.withColumn("_pid", F.shiftright("_row", 33))
    part = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    before = part.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(*strata, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    per = per.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    inside = F.row_number().over(Window.partitionBy(*strata, "_pid").orderBy("_row"))
    return join_null_safe(rows.withColumn("_in", inside), per, [*strata, "_pid"]).withColumn(
        "_nth", F.col("_off") + F.col("_in")
    )
