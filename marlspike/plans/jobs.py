"""Whole jobs as compositions of operators.

Each step takes and returns DataFrames; reading, writing and paths are the
caller's choice, so that plans join up across steps. Errors propagate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.functions.scalar import merge_text
from marlspike.models import joint, linear
from marlspike.models.joint import JointModel
from marlspike.models.sparse import TrainConfig
from marlspike.operators import evaluate as E
from marlspike.operators import features as X
from marlspike.operators import profile as P
from marlspike.operators import relate as R
from marlspike.operators import sample as S
from marlspike.operators import text as T
from marlspike.session import materialize
from marlspike.sources.parsers import parse_label_lines, parse_predictions

STAGES = ("raw", "clean", "sample", "evaluate")


def run_stage(
    name: str, stages: Mapping[str, Callable[[], DataFrame]]
) -> dict[str, DataFrame]:
    """Run one stage, or every given stage in order for "all".

    stages maps stage names to functions without arguments.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    if name == "all":
        return {stage: stages[stage]() for stage in STAGES if stage in stages}
    if name not in stages:
        raise ValueError(f"stage is 'all' or one of {', '.join(stages)}")
    return {name: stages[name]()}


def prepare_text_job(
    base: DataFrame,
    texts: DataFrame,
    key: str,
    text_cols: Sequence[str],
    label: str,
    seed: int = 0,
    **tokenizing,
) -> dict[str, DataFrame]:
    """Labelled rows and their texts to a training corpus."""
    prepared = T.prepare_text(base, texts, key, text_cols, label)
    return T.build_text_corpus(prepared, name=key, seed=seed, **tokenizing)


def merge_text_labels(
    lines: DataFrame, key: str, *tables: DataFrame
) -> list[DataFrame]:
    """Parse classifier result lines and attach the label to each table."""
    labels = parse_label_lines(lines).withColumnRenamed("company_name", key)
    return [R.attach_label(t, labels, key) for t in tables]


def publish_results(
    lines: DataFrame, scored: DataFrame, attributes: DataFrame, key: str = "company_name"
) -> DataFrame:
    """Every prediction of a scored row with the company's attributes."""
    predictions = parse_predictions(lines)
    known = scored.withColumnRenamed("id", "item_id")
    matched = predictions.join(known, "item_id", "inner")
    return R.join_predictions(attributes, matched, key)


def publish_disagreements(
    lines: DataFrame,
    scored: DataFrame,
    attributes: DataFrame,
    label: int = 3,
    predicted: Sequence[int] = (1, 2),
    above: float = 0.6,
    key: str = "company_name",
) -> DataFrame:
    """Attributes of rows labelled one way but confidently predicted another."""
    predictions = E.confident(parse_predictions(lines), above)
    joined = R.join_predictions(scored.withColumnRenamed("id", "item_id"), predictions, "item_id")
    found = E.mine_disagreements(joined, label, predicted).select(key)
    return attributes.join(found, key, "inner")


def build_wide_text(
    base: DataFrame,
    key: str,
    text_cols: Sequence[str],
    stopwords: DataFrame,
    require: str | None = None,
    n: int = 40,
    **tokenizing,
) -> DataFrame:
    """Text columns of each row to n vocabulary-index columns.

    require names a column that must not be null. key identifies a row. The
    tokens are written once, for the vocabulary and for the lookup.
    """
    rows = base.where(F.col(f"`{require}`").isNotNull()) if require else base
    folded = rows.select(key, merge_text(list(text_cols), keep_blanks=False).alias("text"))
    cut = T.tokenize(folded, "text", **tokenizing)
    cleaned = T.remove_stopwords(cut, "tokens", stopwords).select(key, "tokens")
    cleaned = materialize(cleaned, "tokens")
    return T.tokens_to_wide(cleaned, key, "tokens", T.build_vocab(cleaned, "tokens"), n)


@dataclass(frozen=True)
class Trained:
    """Result of a training job: the model, its training series, the class
    distribution, scored validation rows and their top lists."""

    model: object
    history: DataFrame
    distribution: DataFrame
    predictions: DataFrame
    user_recs: DataFrame
    item_recs: DataFrame


def _top_lists(predictions: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    return E.recommend(predictions, "user_id", n), E.recommend(predictions, "item_id", n)


def train_job(
    rows: DataFrame,
    spec: X.FeatureSpec,
    classes: int,
    item: str,
    user: str | None = None,
    model_type: str = "joint",
    config: TrainConfig = TrainConfig(),
    train: float = 0.75,
    top: int = 5,
) -> Trained:
    """Split encoded rows by hash, train, score the held-out part, recommend.

    The columns the model reads are written once, by part, so that features
    are computed once however often training and scoring read them.
    model_type "wide" fits the linear model; others the joint network.
    """
    key = [user, item] if user else [item]
    read = [*key, "label", *spec.slot_cols, *spec.indicator_cols, *spec.embed_cols, *spec.cont_cols]
    coded = rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys(read)])
    weights = {"train": train, "valid": 1.0 - train}
    table = materialize(S.tag_split(coded, weights, key, config.seed), "coded", ["split"])
    parts = {name: table.where(F.col("split") == name).drop("split") for name in weights}
    if model_type == "wide":
        model = linear.train_wide(parts["train"], spec, max_iter=config.epochs)
        history = linear.loss_series(model, rows.sparkSession)
        predictions = linear.score_pairs(model, parts["valid"], spec, user, item)
    else:
        who = user if user else F.lit(1)
        assembled = {k: X.assemble(v, spec, who, item) for k, v in parts.items()}
        model, history = joint.train_joint(
            assembled["train"], spec, classes, config, model_type, assembled["valid"]
        )
        predictions = joint.score_pairs(model, assembled["valid"])
    return Trained(
        model, history, P.class_distribution(table), predictions, *_top_lists(predictions, top)
    )


def score_job(
    model: object,
    rows: DataFrame,
    spec: X.FeatureSpec,
    item: str,
    user: str | None = None,
    top: int = 5,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(predictions, top items per user, top users per item) of encoded rows.

    Encode the rows with the dictionaries saved at training time.
    """
    if isinstance(model, JointModel):
        who = user if user else F.lit(1)
        predictions = joint.score_pairs(model, X.assemble(rows, spec, who, item, label=None))
    else:
        predictions = linear.score_pairs(model, rows, spec, user, item)
    return (predictions, *_top_lists(predictions, top))


def logistic_job(
    data: DataFrame, key: Sequence[str], train: float = 0.75, seed: int = 11
) -> tuple[object, DataFrame, DataFrame]:
    """(model, predictions, accuracy) of a multinomial fit on label/features."""
    parts = S.split(data, {"train": train, "test": 1.0 - train}, list(key), seed)
    model = linear.train_logistic(parts["train"])
    predictions = linear.score(model, parts["test"])
    return model, predictions, E.accuracy(predictions)


def text_classifier_job(
    texts: DataFrame,
    key: str,
    text: str = "text",
    label: str = "label",
    train: float = 0.8,
    seed: int = 0,
    max_words: int = 5000,
    **tokenizing,
) -> tuple[object, DataFrame, DataFrame]:
    """(model, scored held-out texts, vocabulary)."""
    cut = T.tokenize(texts, text, **tokenizing)
    parts = S.split(cut, {"train": train, "valid": 1.0 - train}, key, seed)
    model = linear.train_text_classifier(parts["train"], label=label, max_words=max_words)
    scored = linear.score_text(model, parts["valid"])
    return model, scored, T.build_vocab(parts["train"], "tokens", max_words)
