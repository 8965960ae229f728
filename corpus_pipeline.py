"""Corpus pipeline: five operators applied to ``documents`` one after another.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is all that its
predecessor kept, and returns a DataFrame.  ``run`` writes each result as
Parquet to the shared folder and rereads it as the next stage's input, so a
lost executor never costs more than one stage.

The first four stages return the columns of ``documents``:

1. ``quality``: rows that the compression classifier scores below its
   threshold go; every other row stays as it is;
2. ``near_duplicates``: one document of each SimHash component stays, that of
   the smallest ``doc_id``;
3. ``decontaminate``: documents that contain a window of a benchmark item go;
4. ``mix``: one row per pass that the mix makes over a document, so a document
   may go, stay or repeat up to three times, always whole;
5. ``shard``: adds ``shard`` and ``slot``.

NULL texts, repeated rows, an empty table and extra columns are handled as
each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from condmon.llm import decontam, mixing, quality_zstd, sharding, simhash
from condmon.llm.common import read_table, save


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_zstd.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: The classifier and the fingerprints cannot be written in SQL; the pipeline
#: is tested against a brute-force version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
