"""Helpers shared by the training-data operators.

Words are maximal runs of characters other than ASCII whitespace
(``0x20``, ``0x09``-``0x0D``) unless an operator says otherwise, and lower
case means ``A-Z`` only, so both are the same on UTF-8 bytes and in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from condmon.session import work_dir

WORD = "[^\\x20\\x09-\\x0D]+"

#: Rows of one Arrow batch.  Texts may be long: a batch is held whole by a
#: Python worker, so the operators that move texts ask for small batches.
BATCH_ROWS = 1000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut,
    later branches prune columns, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_keys(docs: DataFrame) -> list[Column]:
    """``_id, _th``: a non-null key and a hash of the whole row, by which a
    decision taken on a narrow table finds its row again in a second scan.
    Rows equal in both are repeated rows."""
    kinds = [(f"`{f.name}`", f.dataType.typeName()) for f in docs.schema.fields]
    cols = [F.col(c) for c, kind in kinds if kind not in ("map", "variant")]
    nulls = F.concat(*[c.isNull().cast("int").cast("string") for c in cols])
    return [group_key(F.col("doc_id").cast("string")).alias("_id"), F.xxhash64(nulls, *cols).alias("_th")]


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as a struct, so that no name can clash), ``_id, _th``."""
    return docs.select(F.struct("*").alias("row"), *row_keys(docs))


def first_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each group of equal ``keys`` (which repeated rows share)."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def gathered(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """``df`` in as many partitions as its ``rows`` need: after a shuffle that
    was dealt for larger tables, a small result need not be many files.
    ``rows`` must count what the last stage reads, which these tasks then do."""
    return df.coalesce(rows // per_task + 1)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raise it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Words of ``text`` as a long; NULL has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def group_key(c: Column) -> Column:
    """A non-null key that sorts by code point with NULL last."""
    return F.coalesce(F.concat(F.lit("0"), c), F.lit("1"))


def shuffle_key(seed: str, doc_id: Column) -> Column:
    """Seeded pseudo-random order of documents: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def top_bits(hex_key: Column, bits: int) -> Column:
    """The first ``bits`` (at most 32) bits of a hex digest as a long."""
    return F.shiftrightunsigned(F.conv(F.substring(hex_key, 1, 8), 16, 10).cast("long"), 32 - bits)


def bucket_bits(rows: int) -> int:
    """Bits of the bucket number that splits ``rows`` ordered rows into about
    ``sqrt(rows)`` buckets, so neither a bucket nor the list of buckets that
    one task sees grows faster than the square root of the input."""
    return min(32, ((max(rows, 1)).bit_length() + 1) // 2)


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[str],
    sums: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Add ``rank`` (0-based) and ``<s>_before`` (sum over the earlier rows)
    within ``group``, ordered by ``(bucket, *order)``, and the rows of the
    group as ``total`` when named.

    ``group`` and ``bucket`` columns must not be null and ``bucket`` must grow
    with ``order``.  A hot group is spread over its buckets: rows are ranked
    inside a bucket, and bucket offsets come from a pre-aggregated table of
    one row per bucket.
    """
    keys = [*group, bucket]
    one = F.lit(1).cast("long")
    per = df.groupBy(*keys).agg(F.sum(one).alias("_n"), *[F.sum(s).alias(f"_sum_{s}") for s in sums])
    whole = Window.partitionBy(*group) if group else Window.partitionBy()
    blocks = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = per.select(
        *keys,
        F.coalesce(F.sum("_n").over(blocks), zero).alias("_off"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(blocks), zero).alias(f"_off_{s}") for s in sums],
        *([F.sum("_n").over(whole).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.select(
        "*",
        (F.row_number().over(inside) - 1).cast("long").alias("_in"),
        *[F.coalesce(F.sum(s).over(before), zero).alias(f"_in_{s}") for s in sums],
    )
    out = ranked.join(offsets, keys).withColumn("rank", F.col("_off") + F.col("_in"))
    for s in sums:
        out = out.withColumn(f"{s}_before", F.col(f"_off_{s}") + F.col(f"_in_{s}"))
    return out.drop("_in", "_off", "_n", *[f"_in_{s}" for s in sums], *[f"_off_{s}" for s in sums])


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Consecutive parts of ``data`` of about ``size`` bytes, cut only at
    ASCII whitespace, so no word is split."""
    start = 0
    while len(data) - start > size:
        cut = _SPACE.search(data, start + size)
        if cut is None:
            break
        yield data[start : cut.start()]
        start = cut.start()
    yield data[start:] if start else data


def map_texts(df: DataFrame, text: str, keep: Sequence[str], fields: Sequence[tuple[str, str]], make) -> DataFrame:
    """Apply a Python function to batches of whole texts.

    ``make()`` runs once per task and returns ``fn(texts)``, which gets a list
    of UTF-8 byte strings (None for NULL) and returns one Arrow array or list
    per entry of ``fields`` (name, SQL type).  The ``keep`` columns pass
    through unchanged; no row is added or lost.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    bound_batches(df.sparkSession)
    src = df.select(*keep, F.col(text).cast("binary").alias("_text"))
    extra = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))
    schema = T.StructType([*src.schema.fields[:-1], *extra.fields])
    arrow = to_arrow_schema(extra)

    def run(batches):
        import pyarrow as pa

        fn = make()
        for batch in batches:
            outs = fn(batch.column(batch.num_columns - 1).to_pylist())
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            cols += [o if isinstance(o, pa.Array) else pa.array(o, type=f.type) for o, f in zip(outs, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where ``crc32(doc_id as text) mod folds = fold`` (NULL: empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold
