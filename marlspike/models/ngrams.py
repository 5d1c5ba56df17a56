"""Text classifier on averaged vectors of hashed n-grams.

A text is the mean of the vectors of its words and word pairs, each of which has a row of
the weight table (see `sparse`) by its hash; a linear layer on the driver turns the mean
into classes. No vocabulary is built and nothing but that layer is held whole. A text's
n-grams are all read, as often as they occur; a text without any has the mean zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.models import sparse
from marlspike.models.sparse import Learner, Params, TrainConfig
from marlspike.session import materialize

BUCKETS = 1 << 24


def gram_keys(tokens: str, pairs: bool, buckets: int = BUCKETS) -> Column:
    """The keys of a token array's words and, if asked for, of neighbouring pairs."""
    c = F.col(tokens)
    words = F.transform(c, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)))
    both = F.zip_with(
        F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b, F.lit(2)), F.lit(buckets)),
    )
    none = F.array().cast("array<long>")
    return F.coalesce(F.concat(words, F.when(F.size(c) > 1, both).otherwise(none)) if pairs else words, none)


@dataclass(frozen=True)
class GramLearner(Learner):
    classes: int
    width: int = 8
    seed: int = 0
    pairs: bool = True

    def vector_bytes(self) -> int:
        return 8 * self.width

    def initial(self, key: int) -> np.ndarray:
        return np.random.default_rng([self.seed, key]).uniform(-1.0 / self.width, 1.0 / self.width, self.width)

    def dense(self) -> Params:
        return {"out": np.zeros((self.width, self.classes)), "bias": np.zeros(self.classes)}

    def means(self, values: list, ends: np.ndarray):
        """(mean vector of each row, owner of each vector, its share in the mean)."""
        sizes = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(ends)), sizes)
        share = 1.0 / np.maximum(sizes, 1)[owner]
        own = np.asarray(values) * share[:, None] if len(values) else np.zeros((0, self.width))
        return sparse.summed_rows(owner, own, len(ends)), owner, share

    def prepared(self, rows, keys, ends):
        sizes = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(ends)), sizes)
        distinct, place = np.unique(keys, return_inverse=True)
        # a key that occurs several times in a row is met once
        own, times = np.unique(owner * len(distinct) + place, return_counts=True)
        owner, place = np.divmod(own, max(1, len(distinct)))
        label = rows.column("label").to_numpy(zero_copy_only=False)
        made = {"label": label, "owner": owner.astype(np.int32), "place": place.astype(np.int32)}
        return distinct, made | {"share": times / sizes[owner]}

    def step(self, dense, made, values):
        label, owner, place, share = (made[x] for x in ("label", "owner", "place", "share"))
        own = values[place] * share[:, None]
        mean = sparse.narrow_sums(owner, own, len(label))
        prob = self.chances(dense, mean)
        at = np.arange(len(label))
        loss = float(-np.log(np.maximum(prob[at, label], 1e-12)).sum())
        hits = int((prob.argmax(axis=1) == label).sum())
        prob[at, label] -= 1.0
        back = prob @ dense["out"].T
        grad = sparse.narrow_sums(place, back[owner] * share[:, None], len(values))
        return loss, hits, {"out": mean.T @ prob, "bias": prob.sum(axis=0)}, grad

    def chances(self, dense: Params, mean: np.ndarray) -> np.ndarray:
        logits = mean @ dense["out"] + dense["bias"]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def outcome(self, dense, rows, keys, values, ends, gradient):
        mean, owner, share = self.means(values, ends)
        prob = self.chances(dense, mean)
        label = rows.column("label").to_numpy(zero_copy_only=False)
        at = np.arange(len(label))
        loss = float(-np.log(np.maximum(prob[at, label], 1e-12)).sum())
        hits = int((prob.argmax(axis=1) == label).sum())
        if not gradient:
            return loss, hits, {}, []
        prob[at, label] -= 1.0
        back = prob @ dense["out"].T
        distinct, place = np.unique(keys, return_inverse=True)
        own = sparse.summed_rows(place, back[owner] * share[:, None], len(distinct))
        return loss, hits, {"out": mean.T @ prob, "bias": prob.sum(axis=0)}, [(distinct, own)]


@dataclass(frozen=True)
class GramModel:
    learner: GramLearner
    dense: Params
    table: DataFrame


def train_ngrams(
    rows: DataFrame,
    classes: int,
    tokens: str = "tokens",
    label: str = "label",
    config: TrainConfig = TrainConfig(),
    width: int = 8,
    pairs: bool = True,
) -> tuple[GramModel, DataFrame]:
    """Fit on token arrays; labels count from 0."""
    learner = GramLearner(classes, width, config.seed, pairs)
    examples = rows.select(F.col(label).cast("int").alias("label"), gram_keys(tokens, pairs).alias("keys"))
    dense, table, history = sparse.train(examples, learner, learner.dense(), config)
    return GramModel(learner, dense, table), history


def score_ngrams(model: GramModel, rows: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """(key, prediction, probability, probabilities) of rows; classes count from 0."""
    shared = rows.sparkSession.sparkContext.broadcast(model.dense)
    learner = model.learner
    keyed = rows.select(F.col(key).alias("own"), gram_keys(tokens, learner.pairs).alias("keys"))
    numbered = materialize(keyed.withColumn("row", F.monotonically_increasing_id()), "scoring")

    lines, blocks = sparse.met(numbered, model.table, learner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, values, ends in blocks(batches):
            prob = learner.chances(shared.value, learner.means(values, ends)[0])
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("own"), pa.array(prob.argmax(axis=1), pa.int32()), pa.array(prob.max(axis=1)),
                    pa.array(list(prob), pa.list_(pa.float64())),
                ],
                ["own", "prediction", "probability", "probabilities"],
            )

    kind = numbered.schema["own"].dataType.simpleString()
    schema = f"own {kind}, prediction int, probability double, probabilities array<double>"
    return lines.mapInArrow(run, schema).withColumnRenamed("own", key)
