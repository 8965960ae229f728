"""Bounded, seeded samples of labelled documents for fitting a model.

Only rows outside the held-out fold (``crc32(doc_id as text) mod 5 = 0``) are
learned from.  The sample is bounded by ``PER_CLASS`` documents per class of at
most ``MAX_CHARS`` characters each; whole texts are used.  It is drawn from the
labelled documents that have such a text, so ids without one do not thin it
out.  Statistics of the
labels (the class shares) cover all training labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import held_out, save, shuffle_key

FOLDS, HELD_OUT = 5, 0
PER_CLASS = 1500
MAX_CHARS = 20_000


def quality_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, good`` (0/1) of the training fold: the majority of a
    document's labels, ties good; NULL ids and labels are left out."""
    return (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, seed: str, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS
) -> tuple[list[tuple[bytes, int]], dict[int, float]]:
    """(text, label) pairs in seeded order, and the share of each class."""
    spark = docs.sparkSession
    known = quality_labels(labels)
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    total = sum(counts.values())
    share = {c: counts.get(c, 0) / total if total else 0.5 for c in (0, 1)}
    usable = docs.where(F.length("text").between(1, max_chars)).select("doc_id").distinct()
    there = save(known.join(usable, "doc_id", "left_semi"), "labels")
    picked = []
    for c in (0, 1):
        top = there.where(F.col("good") == c).orderBy(shuffle_key(seed, F.col("doc_id")), "doc_id").limit(per_class)
        picked += [(r["doc_id"], c) for r in top.select("doc_id").collect()]
    if not picked:
        return [], share
    ids = spark.createDataFrame(picked, known.select("doc_id", "good").schema)  # at most 2 * PER_CLASS rows
    rows = (
        docs.select("doc_id", "text")
        .where(F.length("text").between(1, max_chars))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min("text").alias("text"))
        .orderBy(shuffle_key(seed, F.col("doc_id")), "doc_id")
    )
    return [(r["text"].encode(), r["good"]) for r in rows.select("text", "good").collect()], share
