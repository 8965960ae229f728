"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded-shuffled order within their source; sorting all
rows by the fractional rank ``(rank + 0.5) / rows of the source`` interleaves
the sources in proportion, and cutting the sorted list into equal counts
gives shards that each match the mixture (law ``rows``: counts differ by at
most one).

Scale: ranks come from range partitions of (source, shuffled order) and of the
fractional rank, with offsets from one row per partition and source, so a
source or a ``doc_id`` with a third of all rows, and very many sources of one
row, are spread over many tasks.  Only ids, sizes and digests are shuffled.

Defined cases: a NULL source is a stratum of its own (sorted last); a NULL
text has size 1 and the checksum of no bytes; rows that repeat a ``doc_id``
are separate rows, ordered by size and checksum (rows equal in all of these
are interchangeable); an empty table gives no rows; other columns are ignored
by ``shard_plan`` and kept by ``shard_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import first_of, group_key, keyed_rows, row_keys, save, shuffle_key
from condmon.operators.ordinal import ordinal_within

SHARDS = 8
SEED = "shard-1"
#: Rows of one shard file.
FILE_ROWS = 100_000


def shard_plan(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of
    ``docs(doc_id, text, source)``, and the columns named in ``keep``."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        group_key(F.col("source")).alias("_g"),
        shuffle_key(seed, F.col("doc_id")).alias("_k"),
        *keep,
    )
    narrow = save(narrow, "shard-rows")
    total = narrow.count()
    # numbers by range partitions: a doc_id (or NULL) that very many rows share
    # and sources of one row, which have one fractional rank, spread over tasks
    ranked = ordinal_within(narrow, ["_g"], ["_k", "doc_id", "size", "text_crc32"], name="_r", total_name="_rows")
    ranked = ranked.withColumn("_r", F.col("_r") - 1)
    ranked = ranked.withColumn("_f", (F.col("_r") + F.lit(0.5)) / F.col("_rows"))
    placed = ordinal_within(ranked, [], ["_f", "_g", "_r"], name="rank").withColumn("rank", F.col("rank") - 1)
    shard = F.expr(f"rank * {n_shards}L div {max(total, 1)}L")
    start = F.expr(f"(_s * {max(total, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return placed.withColumn("_s", shard).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_s").cast("int").alias("shard"),
        (F.col("rank") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *keep,
    )


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``docs`` with their ``shard`` and ``slot`` (earlier columns of these
    names are replaced)."""
    narrow = docs.select("doc_id", "text", "source", *row_keys(docs))
    plan = shard_plan(narrow, n_shards, seed, keep=("_id", "_th"))
    # rows that repeat each other share their keys: one of them takes all their places
    out = first_of(keyed_rows(docs), ["_id", "_th"]).join(
        save(plan.select("_id", "_th", "shard", "slot"), "shard-places"), ["_id", "_th"]
    )
    cols = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return out.select(*[f"row.`{c}`" for c in cols], "shard", "slot")


def write_shards(sharded: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Write one folder per shard; files hold consecutive slots, in order, so
    a shard is read back by file and then row order without a shuffle."""
    part = F.floor(F.col("slot") / file_rows).cast("long")
    (
        sharded.withColumn("part", part)
        .repartition("shard", "part")
        .sortWithinPartitions("shard", "part", "slot")
        .write.partitionBy("shard", "part")
        .parquet(path)
    )
