"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation many times, each snapshot one turn longer.
Every turn gets a rolling hash of the conversation up to it: the running sum of
128-bit hashes of turn number, role and text.  A conversation whose full
hash is the prefix hash of a longer one is a snapshot of it and is dropped by
an anti-join on (turns, hash); of equal conversations the smallest id stays.
The maximal conversations are then rendered.

Scale: DataFrame functions only.  Prefix hashes are sums, so they are taken
inside blocks of turns with offsets from one pre-aggregated row per block:
a conversation that holds a third of all rows is spread over its blocks, which
are finer for such ones, as a NULL ``conv_id`` may repeat few turn numbers.
Prefixes and conversations are made distinct map-side before they meet, so a
first turn or a conversation that everybody shares is one row.  A long
conversation is rendered in parts of at most ``PART_TURNS`` turns; its parts
in order are its text.

Defined cases: turns are ordered by ``turn`` (NULL last), then role and text,
and equal only with the same number, as snapshots of one log have it;
rows that repeat conversation, turn, role and text count once; a NULL role or
text renders as empty but differs from an empty one in comparisons; rows with
a NULL ``conv_id`` form one conversation; control marks inside a role or text
are broken up so that they cannot end a turn; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import group_key, running_totals, save

#: Turns of one rendered part.
PART_TURNS = 256
#: Rows beyond which a conversation is cut into finer blocks.
HOT_ROWS = 1 << 17
#: The marks around a turn.
BEGIN, END = "<|im_start|>", "<|im_end|>"
_LANES = ("ha", "hb", "hc", "hd")


def _lanes(seed: int) -> tuple[Column, Column]:
    """Two 32-bit lanes of a hash of (turn, role, text)."""
    h = F.xxhash64(
        F.lit(seed), F.col("turn").isNull(), F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")
    )
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftrightunsigned(h, 32), low


def turns(conversations: DataFrame) -> DataFrame:
    """``g`` (conversation key), ``conv_id, pos`` (1-based), ``n_turns, role,
    text`` and the prefix hash ``ha..hd`` up to each turn."""
    rows = conversations.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumn("g", group_key(F.col("conv_id").cast("string")))
    order = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn"), F.col("role"), F.md5(F.coalesce("text", F.lit(""))).alias("t"),
        F.col("text").isNull().alias("n"),
    )
    # blocks of turn numbers; a NULL turn is in the last one.  Where a conversation
    # (such as that of all NULL ids) has very many rows, every turn number, role
    # and beginning of a text's hash is a block of its own
    hot = rows.groupBy("g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
    rows = rows.join(hot.select("g", F.lit(True).alias("_hot")), "g", "left")
    number = F.when(F.col("_hot"), F.col("turn").cast("long")).otherwise(F.floor(F.col("turn") / 1024).cast("long"))
    block = F.struct(
        F.col("turn").isNull().alias("late"),
        F.coalesce(number, F.lit(0).cast("long")).alias("turns"),
        F.when(F.col("_hot"), F.coalesce(F.concat(F.lit("1"), "role"), F.lit("0"))).otherwise("").alias("role"),
        F.when(F.col("_hot"), F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 3)).otherwise("").alias("t"),
    )
    lanes = [h.alias(x) for x, h in zip(_LANES, (*_lanes(1), *_lanes(2)), strict=True)]
    rows = rows.select("g", "conv_id", "role", "text", order.alias("o"), block.alias("b"), *lanes)
    summed = running_totals(rows, ["g"], "b", ["o"], list(_LANES), total="n_turns")
    for x in _LANES:
        summed = summed.withColumn(x, F.col(x) + F.col(f"{x}_before")).drop(f"{x}_before")
    return summed.withColumn("pos", F.col("rank") + 1).drop("b", "o", "rank")


def maximal(prefixes: DataFrame) -> DataFrame:
    """``g, n_copies`` of the conversations that are no prefix of a longer
    one, one per content."""
    keys = ["pos", *_LANES]
    full = prefixes.where("pos = n_turns").groupBy(*keys).agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "g")).alias("first"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    inner = prefixes.where("pos < n_turns").select(*keys).distinct()
    return full.join(inner, keys, "left_anti").select("first.g", "n_copies")


def _safe(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def format_chats(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, part_turns, text``: the rendered
    maximal conversations, in parts of at most ``part_turns`` turns."""
    all_turns = save(turns(conversations), "chat-prefixes")
    kept = maximal(all_turns.select("g", "conv_id", "pos", "n_turns", *_LANES))
    line = F.concat(F.lit(BEGIN), _safe(F.col("role")), F.lit("\n"), _safe(F.col("text")), F.lit(f"{END}\n"))
    part = F.floor((F.col("pos") - 1) / part_turns).cast("int")
    parts = (
        all_turns.select("g", "conv_id", "pos", "n_turns", part.alias("part"), line.alias("line"))
        .join(kept, "g")
        .groupBy("g", "conv_id", "part", "n_turns", "n_copies")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    )
    return parts.select(
        "conv_id", "part", "n_turns", "n_copies",
        F.size("lines").cast("long").alias("part_turns"),
        F.array_join("lines.line", "").alias("text"),
    )
