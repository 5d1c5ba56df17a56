"""Ranking, filtering and measuring predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.operators.ids import running_sums
from marlspike.operators.relate import join_predictions

# Parts that a group is ranked in before the parts' best rows meet.
PARTS = 256


def recommend(
    predictions: DataFrame,
    by: str,
    n: int,
    item: str | None = None,
    prediction: str = "prediction",
    probability: str = "probability",
) -> DataFrame:
    """Top n rows per value of `by`: best class, then best probability, then
    the smaller id.

    A group may hold any share of the rows: it is ranked in PARTS parts first, by the
    task that a row comes from, and only the best n rows of each part meet.
    """
    tie = item or ("item_id" if by != "item_id" else "user_id")
    order = [F.desc(prediction), F.desc(probability), F.asc(tie)]
    local = Window.partitionBy(by, "_part").orderBy(*order)
    predictions = (
        predictions.withColumn("_part", F.spark_partition_id() % PARTS)
        .withColumn("_place", F.row_number().over(local))
        .where(F.col("_place") <= n)
        .drop("_place", "_part")
    )
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return predictions.withColumn("rank", place).where(F.col("rank") <= n)


def confident(df: DataFrame, above: float, probability: str = "probability") -> DataFrame:
    """Rows with a probability strictly above a threshold."""
    return df.where(F.col(probability) > above)


def mine_disagreements(
    df: DataFrame, label: int, predicted: Sequence[int], label_col: str = "label"
) -> DataFrame:
    """Rows labelled one way and predicted as one of the given other classes."""
    return df.where((F.col(label_col) == label) & F.col("prediction").isin(*predicted))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Long form: one row per (label, prediction) with its count."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def f_by_threshold(
    df: DataFrame, score: str, positive: Column, beta: float = 1.0
) -> DataFrame:
    """(threshold, f) for every distinct score, counting rows with score >=
    threshold as positive. positive is the true-class predicate.

    Rows are summed per score first; the running sums go over score ranges,
    so neither step gathers all scores in one task. Rows with a null score
    are left out.
    """
    hit = F.sum(F.when(positive, 1).otherwise(0)).alias("pos")
    per_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(hit, F.count(F.lit(1)).alias("n"))
    )
    cum = running_sums(per_score, [F.desc("threshold")], ["pos", "n"])
    b2 = beta * beta
    total = F.col("all_pos")
    precision = F.col("run_pos") / F.col("run_n")
    recall = F.when(total == 0, F.lit(0.0)).otherwise(F.col("run_pos") / F.when(total != 0, total))
    both = F.when(precision + recall > 0, b2 * precision + recall)
    f = (1 + b2) * precision * recall / both
    return cum.select("threshold", F.coalesce(f, F.lit(0.0)).alias("f"))


def evaluate(
    predictions: DataFrame,
    truth: DataFrame,
    key: str,
    positive: int | None = None,
    score: Column | None = None,
) -> dict[str, DataFrame]:
    """Join predictions back to labels and measure them.

    With a positive class, F by threshold is added. score is the probability
    of that class; by default p where it is predicted and 1 - p elsewhere,
    which is exact for two classes.
    """
    joined = join_predictions(truth.select(key, "label"), predictions, key)
    report = {
        "joined": joined,
        "accuracy": accuracy(joined),
        "confusion": confusion_matrix(joined),
    }
    if positive is not None:
        p = F.col("probability")
        if score is None:
            score = F.when(F.col("prediction") == positive, p).otherwise(1 - p)
        report["f_by_threshold"] = f_by_threshold(
            joined.withColumn("_score", score), "_score", F.col("label") == positive
        )
    return report
