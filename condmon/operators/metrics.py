"""Model evaluation as aggregations.

Everything reduces to counts or sums first (one aggregation over the
scored rows); the per-class report then works on a table with one row per
(label, prediction) pair.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.session import materialize


def regression_metrics(df: DataFrame, label: str, prediction: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``n, mse, rmse, mae`` (per group when given)."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
    ]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)`` — the only pass over the scored rows."""
    return df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(
    df: DataFrame, label: str, prediction: str, names: Mapping | None = None
) -> DataFrame:
    """Per-class precision, recall, F1 and support, then ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows.

    Classes are the labels seen as truth or prediction; a ratio with a zero
    denominator is 0.  The accuracy row carries accuracy in ``f1_score`` and
    NULL precision/recall.  ``names`` maps class values to printed names.
    """
    # the confusion table (classes^2 rows) feeds every row of the report:
    # checkpoint it so the scored rows are read once
    conf = materialize(confusion(df, label, prediction))
    truth = conf.groupBy("y").agg(F.sum("n").alias("support")).withColumnRenamed("y", "c")
    pred = conf.groupBy("p").agg(F.sum("n").alias("predicted")).withColumnRenamed("p", "c")
    tp = conf.where(F.col("y") == F.col("p")).groupBy("y").agg(F.sum("n").alias("tp")).withColumnRenamed("y", "c")
    per = truth.join(pred, "c", "full").join(tp, "c", "left").fillna(0, ["support", "predicted", "tp"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn(
        "f1_score",
        F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0),
    )
    label_txt = F.col("c").cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(str(k)), F.lit(v))])
        label_txt = F.coalesce(m[F.col("c").cast("string")], label_txt)
    classes = per.select(
        label_txt.alias("label"), "precision", "recall", "f1_score", F.col("support").cast("long").alias("support")
    )
    total = F.sum("support")
    summary = per.agg(
        (F.sum("tp") / total).alias("acc"),
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / total).alias("wf"),
        total.cast("long").alias("n"),
    )
    null = F.lit(None).cast("double")
    acc_row = summary.select(F.lit("accuracy").alias("label"), null.alias("precision"), null.alias("recall"),
                             F.col("acc").alias("f1_score"), F.col("n").alias("support"))
    macro = summary.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                           F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), F.col("n").alias("support"))
    weighted = summary.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                              F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support"))
    return classes.unionByName(acc_row).unionByName(macro).unionByName(weighted)
