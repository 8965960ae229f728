"""Model training, evaluation, persistence and scoring with ``pyspark.ml``
(K1-K7, I8, I9, C3, D19-D21, A11-A13).

Training is distributed (``GBTRegressor`` / ``GBTClassifier`` aggregate
tree statistics across executors); scoring is ``PipelineModel.transform``,
which runs inside the executors on batch and streaming DataFrames alike —
nothing is collected to the driver.

Defaults equal the trained models being reproduced: the RUL regressor uses
500 trees, rate 0.05, depth 3, seed 42; the wear classifier 100 trees, rate
0.1, depth 3, seed 42 (Spark's own defaults differ and are overridden).
Spark's trees bin continuous features (``maxBins``), so predictions are
close to, not equal to, an exact-split implementation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.operators import cleaning as CL
from condmon.operators import metrics as ME
from condmon.operators.splits import hash_split
from condmon.schemas import TOOLWEAR_CANDIDATE_FEATURES
from condmon.session import materialize

# Model hyper-parameters of the trained models.
RUL_PARAMS = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 3, "seed": 42}
WEAR_PARAMS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "seed": 42}
TEST_FRACTION = 0.2
SPLIT_SEED = 42
#: Training rows of one partition of a fit: while there are fewer partitions
#: than task slots, and at most.
FIT_ROWS, MAX_FIT_ROWS = 100_000, 500_000


@dataclass
class Trained:
    model: PipelineModel
    feature_cols: list[str]
    metrics: DataFrame
    test_predictions: DataFrame


# ---------------------------------------------------------------------------
# label encoding
# ---------------------------------------------------------------------------
def label_indexer(input_col: str, output_col: str = "label_index") -> StringIndexer:
    """Lexically ordered codes (``unworn`` = 0, ``worn`` = 1); an unseen
    label raises."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType="alphabetAsc", handleInvalid="error")


def encode_decode(df: DataFrame, col: str) -> DataFrame:
    """Encode ``col`` to ``label_index`` and decode it back to ``decoded``."""
    idx = label_indexer(col).fit(df)
    enc = idx.transform(df)
    return IndexToString(inputCol="label_index", outputCol="decoded", labels=idx.labels).transform(enc)


# ---------------------------------------------------------------------------
# RUL regressor
# ---------------------------------------------------------------------------
def rul_pipeline(feature_cols: Sequence[str], params: dict | None = None, label: str = "rul") -> Pipeline:
    p = dict(RUL_PARAMS, **(params or {}))
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error"),
            GBTRegressor(labelCol=label, featuresCol="features", predictionCol="rul_prediction",
                         lossType="squared", **p),
        ]
    )


def train_rul(
    supervised: DataFrame,
    feature_cols: Sequence[str],
    key_cols: Sequence[str] = ("test_set", "file"),
    params: dict | None = None,
) -> Trained:
    """Hash split 80/20 (K1), fit on train, RMSE on the hold-out.

    Keys, features and label are written once: the split reads them several
    times, and every tree of the fit reads the training rows.
    """
    narrow = materialize(supervised.select(*key_cols, *feature_cols, "rul"))
    split = materialize(hash_split(narrow, key_cols, TEST_FRACTION, SPLIT_SEED))
    test = split.where(F.col("split") == "test").drop("split")
    model = rul_pipeline(feature_cols, params).fit(training_rows(split))
    pred = model.transform(test)
    metrics = ME.regression_metrics(pred, "rul", "rul_prediction")
    return Trained(model, list(feature_cols), metrics, pred)


def training_rows(split: DataFrame) -> DataFrame:
    """The train side in partitions of about ``FIT_ROWS`` rows: a boosted fit
    runs several small jobs per tree, whose cost is their number of tasks.
    Past one partition per task slot, partitions grow up to ``MAX_FIT_ROWS``
    rows, in whole rounds of the slots, so that no pass ends in a part round."""
    train = split.where(F.col("split") == "train").drop("split")
    rows = train.count()
    parts = max(1, -(-rows // FIT_ROWS))
    slots = split.sparkSession.sparkContext.defaultParallelism
    if parts > slots:
        parts = slots * -(-rows // (slots * MAX_FIT_ROWS))
    return materialize(train.coalesce(parts) if parts == 1 else train.repartition(parts))


def model_feature_cols(model: PipelineModel) -> list[str]:
    """The feature list lives in the assembler stage."""
    return list(model.stages[0].getInputCols())


def score_rul(model: PipelineModel, features: DataFrame, keep: Sequence[str] = ("test_set", "file", "timestamp")) -> DataFrame:
    """Score feature rows (batch or streaming); absent model features are
    added as 0.0 (B16)."""
    cols = model_feature_cols(model)
    df = CL.add_absent_columns(features, cols)
    out = model.transform(df)
    return out.select(*[c for c in keep if c in out.columns], "rul_prediction")


# ---------------------------------------------------------------------------
# wear classifier
# ---------------------------------------------------------------------------
def wear_pipeline(feature_cols: Sequence[str], label_col: str = "tool_condition", params: dict | None = None) -> Pipeline:
    p = dict(WEAR_PARAMS, **(params or {}))
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error"),
            label_indexer(label_col, "label"),
            GBTClassifier(labelCol="label", featuresCol="features", predictionCol="prediction", **p),
        ]
    )


def train_wear(
    data: DataFrame,
    key_cols: Sequence[str],
    label_col: str = "tool_condition",
    candidates: Sequence[str] = TOOLWEAR_CANDIDATE_FEATURES,
    params: dict | None = None,
    keep: Sequence[str] = (),
    group_col: str | None = None,
) -> Trained:
    """Drop incomplete rows (B15), pick present candidates (B13), stratified
    80/20 split (K2), fit, accuracy and per-class report (D20, D21).  With
    ``group_col`` no group (experiment) is both learned from and tested on."""
    if label_col not in data.columns:
        raise ValueError(f"expected a '{label_col}' column")
    clean = CL.drop_incomplete(data)
    feature_cols = CL.existing_columns(clean, candidates)
    # written once, without the columns that only the drop needed
    names = dict.fromkeys([*key_cols, *keep, *([group_col] if group_col else []), label_col, *feature_cols])
    clean = materialize(clean.select(*names))
    split = materialize(hash_split(clean, key_cols, TEST_FRACTION, SPLIT_SEED, strata=[label_col], group_col=group_col))
    test = split.where(F.col("split") == "test").drop("split")
    model = wear_pipeline(feature_cols, label_col, params).fit(training_rows(split))
    pred = decode_prediction(model, model.transform(test))
    labels = model.stages[1].labels
    names = {float(i): n for i, n in enumerate(labels)}
    report = ME.classification_report(pred, "label", "prediction", names)
    return Trained(model, feature_cols, report, pred)


def decode_prediction(model: PipelineModel, scored: DataFrame) -> DataFrame:
    labels = model.stages[1].labels
    return IndexToString(inputCol="prediction", outputCol="tool_condition_prediction", labels=labels).transform(scored)


def score_wear(model: PipelineModel, flat: DataFrame,
               keep: Sequence[str] = ("experiment", "timestamp", "tool_condition_true")) -> DataFrame:
    """Score flat tool-wear rows (batch or streaming); every row comes back.

    Only the assembler and the classifier run here — the label indexer
    needs the true label, which serving rows may lack.  Absent model
    features are added as 0.0.  A row with a NULL feature cannot be scored:
    its prediction is NULL and ``unscoreable`` names the missing features (NULL
    for scored rows).
    """
    cols = model_feature_cols(model)
    df = CL.add_absent_columns(flat, cols)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    df = df.withColumn("_missing", F.when(F.size(missing) > 0, F.array_join(missing, ",")))
    # the classifier sees 0.0 in place of a NULL; its answer for such a row is dropped
    kept = [c for c in keep if c in df.columns]
    ready = df.select(*[F.col(c).alias(f"_keep_{c}") for c in kept], "_missing",
                      *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    scored = decode_prediction(model, model.stages[2].transform(model.stages[0].transform(ready)))
    return scored.select(
        *[F.col(f"_keep_{c}").alias(c) for c in kept],
        F.when(F.col("_missing").isNull(), F.col("tool_condition_prediction")).alias("tool_condition_prediction"),
        F.col("_missing").alias("unscoreable"),
    )


# ---------------------------------------------------------------------------
# persistence
# ---------------------------------------------------------------------------
def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
