"""Linear classifiers on MLlib: plain logistic, the wide model, text.

Labels of the company tasks count from 1, MLlib's from 0; first_label says
where counting starts, and predictions come back in the same counting.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.operators.features import FeatureSpec, assemble_vector


def train_logistic(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    first_label: int = 0,
    max_iter: int = 100,
    reg: float = 0.0,
) -> LogisticRegressionModel:
    """Multinomial logistic regression by L-BFGS with tree aggregation."""
    shifted = train.select(
        F.col(features).alias("features"),
        (F.col(label).cast("double") - first_label).alias("label"),
    )
    learner = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg)
    return learner.fit(shifted)


def loss_series(model: LogisticRegressionModel, spark: SparkSession) -> DataFrame:
    """(step, split, metric, value) of the training objective. One row per
    iteration, so bounded by max_iter."""
    history = model.summary.objectiveHistory
    rows = [(i, "train", "loss", float(v)) for i, v in enumerate(history)]
    return spark.createDataFrame(rows, "step int, split string, metric string, value double")


def score(
    model: LogisticRegressionModel | PipelineModel, df: DataFrame, first_label: int = 0
) -> DataFrame:
    """df with `probabilities` (array by class), `prediction` (int class) and
    `probability` (of that class)."""
    out = model.transform(df)
    return (
        out.drop("rawPrediction")
        .withColumn("probabilities", vector_to_array("probability"))
        .withColumn("prediction", F.col("prediction").cast("int") + first_label)
        .withColumn("probability", F.array_max("probabilities"))
    )


def train_wide(
    rows: DataFrame,
    spec: FeatureSpec,
    label: str = "label",
    max_iter: int = 60,
    reg: float = 1e-4,
) -> LogisticRegressionModel:
    """The wide model: a softmax over multi-hot slots, labels from 1."""
    return train_logistic(
        assemble_vector(rows, spec), label=label, first_label=1, max_iter=max_iter, reg=reg
    )


def score_pairs(
    model: LogisticRegressionModel,
    rows: DataFrame,
    spec: FeatureSpec,
    user: str | None = None,
    item: str = "id",
) -> DataFrame:
    """(user_id, item_id, prediction, probability) for every row; the user is
    1 when rows have none."""
    scored = score(model, assemble_vector(rows, spec), first_label=1)
    who = F.col(user) if user else F.lit(1)
    return scored.select(
        who.cast("bigint").alias("user_id"),
        F.col(item).cast("bigint").alias("item_id"),
        "prediction",
        "probability",
    )


def train_text_classifier(
    rows: DataFrame,
    tokens: str = "tokens",
    label: str = "label",
    max_words: int = 5000,
    hashed: bool = False,
    max_iter: int = 20,
    reg: float = 1e-3,
) -> PipelineModel:
    """Token array to class probabilities, from whole texts: term counts,
    inverse document frequency, logistic regression. Labels count from 0.

    hashed=True needs no vocabulary pass and keeps nothing on the driver.
    """
    terms = (
        HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=1 << 16)
        if hashed
        else CountVectorizer(inputCol=tokens, outputCol="_tf", vocabSize=max_words)
    )
    stages = [
        terms,
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(
            featuresCol="_tfidf", labelCol=label, family="multinomial", maxIter=max_iter, regParam=reg
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def score_text(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return score(model, rows).drop("_tf", "_tfidf")
