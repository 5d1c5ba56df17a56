import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marlspike.models import ngrams
from marlspike.models.sparse import TrainConfig


def test_gradient():
    """Analytic gradient against central differences."""
    learner = ngrams.GramLearner(3, 4)
    rng = np.random.default_rng(0)
    dense = {"out": rng.normal(size=(4, 3)), "bias": rng.normal(size=3)}
    keys, ends = np.array([5, 6, 5, 7, 5]), np.array([2, 2, 5])
    table = {k: rng.normal(size=4) for k in (5, 6, 7)}
    rows = pa.RecordBatch.from_arrays([pa.array([0, 2, 1])], ["label"])

    def loss(dense, table):
        return learner.outcome(dense, rows, keys, [table[k] for k in keys.tolist()], ends, False)[0]

    _, _, grads, sparse = learner.outcome(dense, rows, keys, [table[k] for k in keys.tolist()], ends, True)
    own = dict(zip(*[x.tolist() if i == 0 else x for i, x in enumerate(sparse[0])]))
    for held, found in ((dense, grads), (table, own)):
        for name, values in held.items():
            for at in np.ndindex(*values.shape):
                sides = []
                for eps in (1e-6, -1e-6):
                    moved = {k: v.copy() for k, v in held.items()}
                    moved[name][at] += eps
                    sides.append(loss(moved, table) if held is dense else loss(dense, moved))
                assert abs((sides[0] - sides[1]) / 2e-6 - found[name][at]) < 1e-4, (name, at)


def test_word_order_is_learned(spark):
    """Texts of the same words in two orders, told apart by their pairs; empty ones take part."""
    tokens = F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("a")))
    rows = spark.range(120).select("id", (F.col("id") % 2).cast("int").alias("label"), tokens.alias("tokens"))
    config = TrainConfig(batch_size=60, epochs=8, learning_rate=0.3)
    model, history = ngrams.train_ngrams(rows, 2, config=config)
    scored = ngrams.score_ngrams(model, rows, "id").join(rows, "id")
    assert scored.where("prediction = label").count() == 120
    assert {r["split"] for r in history.collect()} == {"train"}
    none = spark.createDataFrame([(1, []), (2, None)], "id long, tokens array<string>")
    assert ngrams.score_ngrams(model, none, "id").count() == 2


def test_prepared_steps_equal_outcomes():
    learner = ngrams.GramLearner(3, 4)
    rng = np.random.default_rng(0)
    dense = {"out": rng.normal(size=(4, 3)), "bias": rng.normal(size=3)}
    keys, ends = np.array([5, 6, 5, 7, 5]), np.array([2, 2, 5])
    rows = pa.RecordBatch.from_arrays([pa.array([0, 2, 1])], ["label"])
    table = {k: rng.normal(size=4) for k in (5, 6, 7)}
    loss, hits, grads, [(own, summed)] = learner.outcome(dense, rows, keys, [table[k] for k in keys.tolist()], ends, True)
    distinct, made = learner.prepared(rows, keys, ends)
    found = learner.step(dense, made, np.array([table[k] for k in distinct.tolist()]))
    assert distinct.tolist() == own.tolist() and found[1] == hits and np.isclose(found[0], loss)
    assert all(np.allclose(found[2][k], grads[k]) for k in grads) and np.allclose(found[3], summed)
