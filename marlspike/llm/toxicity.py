"""Severity of toxicity by cumulative-link ordinal regression.

A text's features are its words and their first four, five and six characters
(lower case, letters and digits only), each counted as 1 + log(occurrences). Of all
features those whose documents lean to the toxic side beyond doubt are selected: a
z-score of the log odds ratio of at least Z, the MOST with the highest.

Grades 0 to K are ordered. One weight for each feature is shared by all thresholds:
P(grade <= k) = sigmoid(threshold_k - w.x). The expected severity is the sum of
k P(grade = k); a text is toxic if a grade above 0 is more likely than not.

The model learns from a bounded sample: at most `per_class` toxic and as many other
labelled texts, by a hash of their id. Labels only tell toxic from not, so toxic
sample texts are graded by how many words with a selected feature they have: grade 1
below the median of the sample, grade 2 from there on. The sample is dealt over SHARDS fits in
Spark tasks whose parameters are averaged; the model sent to the workers has at most
MOST weights.

Defined results: a table without rows gives no rows; a null or empty text has no features and the severity that the
thresholds alone give. Rows that share an id are judged each; labels that are null or
disagree for an id count as toxic if one says so. Without toxic labels every text has
severity 0. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import ascii_words, hash_strings, mix, slices
from marlspike.session import materialize

PER_CLASS = 4000
SHARDS = 2
MOST = 20_000
Z, ODDS, LEAST_DOCS = 4.0, 10.0, 4
STEPS, RATE, DECAY = 400, 0.5, 2e-6
GRADES = 3


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, codes, hashes, words): word codes[j] of a text has the features
    hashes[codes[j]], a row of four; words counts the words of each text."""
    offsets, flat = ascii_words(texts)
    coded = flat.dictionary_encode()
    plain = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\pL\pN]+", "")
    size = pc.utf8_length(plain).to_numpy(zero_copy_only=False)
    kinds = [hash_strings(plain)]
    for length in (4, 5, 6):
        head = hash_strings(pc.utf8_slice_codeunits(plain, 0, length))
        kinds.append(np.where(size >= length, mix(head + np.uint64(length)), np.uint64(0)))
    kinds[0][size == 0] = 0
    return offsets, coded.indices.to_numpy(), np.stack(kinds, axis=1), np.diff(offsets)


def counted(texts: pa.Array, features: np.ndarray):
    """(text, feature place, 1 + log(occurrences), words with a feature) of the selected features."""
    offsets, codes, hashes, words = text_features(texts)
    count = len(offsets) - 1
    if not len(features) or not len(hashes):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0), np.zeros(count), words
    place = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    place = np.where(features[place] == hashes, place, -1)
    marked = (place >= 0).any(axis=1)
    spot = np.flatnonzero(marked[codes])
    owner = np.searchsorted(offsets, spot, side="right") - 1
    near = np.bincount(owner, minlength=count)
    own = place[codes[spot]]
    text = np.repeat(owner, own.shape[1])[own.ravel() >= 0]
    pairs, times = np.unique(text * len(features) + own.ravel()[own.ravel() >= 0], return_counts=True)
    return pairs // len(features), pairs % len(features), 1 + np.log(times), near, words


def probabilities(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade = k) for each score, a column for each grade."""
    below = 1 / (1 + np.exp(np.clip(scores[:, None] - thresholds[None, :], -500, 500)))
    below = np.column_stack([np.zeros(len(scores)), below, np.ones(len(scores))])
    return np.diff(below, axis=1)


def fit(text, place, value, grade, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that fit the grades of texts: full-batch adaptive steps.

    text, place, value: the texts' features. The first threshold is free, the gaps to
    the others are kept positive by learning their logarithms."""
    count = len(grade)
    weights, free = np.zeros(features), np.zeros(GRADES - 1)
    squares = [np.full(features, 1e-8), np.full(GRADES - 1, 1e-8)]
    rows = np.arange(count)
    for _ in range(STEPS):
        thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        score = np.bincount(text, weights[place] * value, count)
        sig = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds, -500, 500)))
        edge = np.column_stack([np.zeros(count), sig, np.ones(count)])
        slope = np.column_stack([np.zeros(count), sig * (1 - sig), np.zeros(count)])
        chance = np.maximum(edge[rows, grade + 1] - edge[rows, grade], 1e-12)
        upper, lower = slope[rows, grade + 1] / chance, slope[rows, grade] / chance
        by_score = -(upper - lower)
        by_threshold = np.array(
            [upper[grade == k].sum() - lower[grade == k + 1].sum() for k in range(GRADES - 1)]
        ) / count
        later = np.cumsum(by_threshold[::-1])[::-1]
        by_free = np.concatenate([later[:1], later[1:] * np.exp(free[1:])])
        by_weight = np.bincount(place, value * by_score[text], features) / count - DECAY * weights
        for held, step, square in ((weights, by_weight, squares[0]), (free, by_free, squares[1])):
            square += step**2
            held += RATE * step / np.sqrt(square)
    return weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc, text, toxic) of at most per_class texts of each class, by a hash of the id."""
    known = labels.filter("toxic IS NOT NULL AND doc IS NOT NULL").groupBy("doc").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    order = F.xxhash64("doc", F.lit(23))
    sizes = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"))
    part = (order.bitwiseAND(F.lit(2**31 - 1)) / F.lit(float(2**31))) * F.col("rows")
    near = known.join(sizes, "toxic").filter(part < 4.0 * per_class).withColumn("order", order)
    place = F.row_number().over(Window.partitionBy("toxic").orderBy("order", "doc"))
    chosen = near.withColumn("place", place).filter(F.col("place") <= per_class).select("doc", "toxic")
    return docs.join(F.broadcast(chosen), "doc")  # at most 2 * per_class ids


def select_features(rows: DataFrame) -> np.ndarray:
    """Hashes of the features that lean to the toxic side, of rows (text, toxic)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                toxic = part.column("toxic").to_numpy()
                offsets, codes, hashes, _ = text_features(part.column("text"))
                text = np.repeat(np.arange(len(toxic)), np.diff(offsets))
                pairs = np.unique(text * max(1, len(hashes)) + codes)
                text, word = pairs // max(1, len(hashes)), pairs % max(1, len(hashes))
                flat = hashes[word].ravel()
                text = np.repeat(text, 4)[flat != 0]
                names, place = np.unique(flat[flat != 0], return_inverse=True)
                once = np.unique(place * np.int64(len(toxic)) + text)
                place, text = once // len(toxic), once % len(toxic)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.view(np.int64)),
                        pa.array(np.bincount(place, toxic[text] == 1, len(names)).astype(np.int64)),
                        pa.array(np.bincount(place, toxic[text] == 0, len(names)).astype(np.int64)),
                    ],
                    ["feature", "yes", "no"],
                )

    size = rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows at most
    n = {r.toxic: float(r.n) for r in size}
    if not n.get(1) or not n.get(0):
        return np.zeros(0, np.uint64)
    found = rows.select("text", "toxic").mapInArrow(run, "feature long, yes long, no long")
    found = found.groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    a, b = F.col("yes") + 0.5, F.col("no") + 0.5
    c, d = F.lit(n[1]) + 1 - a, F.lit(n[0]) + 1 - b
    ratio = F.log(a) + F.log(d) - F.log(b) - F.log(c)
    found = found.withColumn("ratio", ratio).withColumn("z", F.col("ratio") / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    kept = found.filter((F.col("yes") >= LEAST_DOCS) & (F.col("ratio") >= float(np.log(ODDS))) & (F.col("z") >= Z))
    chosen = kept.orderBy(F.desc("z"), "feature").limit(MOST).select("feature").toArrow()
    return np.sort(chosen.column(0).to_numpy().view(np.uint64))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS
) -> Model:
    """A model of labels (key, toxic) of docs."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("doc"), F.col("toxic").alias("toxic"))
    rows = materialize(sample(rows, known, per_class), "sample")
    features = select_features(rows)
    if not len(features):
        return Model(features, np.zeros(0), np.full(GRADES - 1, 500.0))
    sent = docs.sparkSession.sparkContext.broadcast(features)

    def marked(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                near = counted(part.column("text"), sent.value)[3]
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int64))], ["near"])

    near = rows.filter("toxic = 1").select("text").mapInArrow(marked, "near long")
    median = near.agg(F.percentile_approx("near", 0.5, 10_000)).first()[0]

    def fit_shard(key, table):
        table = table.combine_chunks().sort_by([("doc", "ascending"), ("text", "ascending")])
        text, place, value, near, _ = counted(table.column("text").combine_chunks(), sent.value)
        toxic = table.column("toxic").to_numpy()
        grade = np.where(toxic == 1, np.where(near >= max(median, 1), 2, 1), 0)
        weights, thresholds = fit(text, place, value, grade, len(sent.value))
        return pa.table(
            {
                "kind": pa.array(np.repeat([0, 1], [len(weights), len(thresholds)]).astype(np.int32)),
                "place": pa.array(np.concatenate([np.arange(len(weights)), np.arange(len(thresholds))])),
                "value": pa.array(np.concatenate([weights, thresholds])),
            }
        )

    shard = F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(SHARDS))
    fitted = rows.withColumn("shard", shard).groupBy("shard").applyInArrow(fit_shard, "kind int, place long, value double")
    found = fitted.groupBy("kind", "place").agg(F.avg("value").alias("value")).toArrow()  # MOST rows and a few
    kind, place, value = (found.column(c).to_numpy() for c in ("kind", "place", "value"))
    model = Model(features, np.zeros(len(features)), np.zeros(GRADES - 1))
    model.weights[place[kind == 0]] = value[kind == 0]
    model.thresholds[place[kind == 1]] = value[kind == 1]
    return model


def judge(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, severity, expected_severity, p_toxic) for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))

    def run(batches):
        model = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                owner, place, value, _, _ = counted(part.column("text"), model.features)
                weights = model.weights if len(model.weights) else np.zeros(1)
                chance = probabilities(np.bincount(owner, weights[place] * value, part.num_rows), model.thresholds)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array(chance.argmax(axis=1).astype(np.int32)),
                        pa.array(chance @ np.arange(GRADES)),
                        pa.array(1 - chance[:, 0]),
                    ],
                    ["doc", "severity", "expected_severity", "p_toxic"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, severity int, expected_severity double, p_toxic double")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, train(docs, labels)).select(
        F.col("doc").alias("doc_id"), "severity", "expected_severity", "p_toxic", (F.col("p_toxic") > 0.5).alias("toxic")
    )


QUERIES = {"op9_toxicity": (op9_toxicity, None)}
