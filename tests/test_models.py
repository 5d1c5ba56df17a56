import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from marlspike.models import joint as W
from marlspike.models import linear, sparse
from marlspike.models.store import load_model, save_model
from marlspike.operators import evaluate as E
from marlspike.operators.features import FeatureSpec, assemble
from marlspike.plans import jobs
from marlspike.session import scratch_path

SPEC = FeatureSpec(
    wide_cols=["a", "b"], wide_dims=[3, 4], indicator_cols=["a"], indicator_dims=[3],
    embed_cols=["b"], embed_in=[4], embed_out=[5], cont_cols=["x"],
)


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes decided by a and b, so that a model can learn them."""
    return spark.range(1200).select(
        F.col("id"),
        (F.col("id") % 3).cast("int").alias("a"),
        (F.col("id") % 4).cast("int").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("x"),
        F.pmod(F.col("id") % 3 + F.col("id") % 4, F.lit(3)).cast("int").alias("c"),
    ).withColumn("label", F.col("c") + 1)


@pytest.fixture(scope="module")
def assembled(rows):
    return assemble(rows, SPEC, F.lit(1), "id")


def batch(n=7, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 3, n), rng.integers(0, 4, n)
    return {
        "wide": np.stack([a, b + 3], axis=1), "indicator": a[:, None], "embed": b[:, None],
        "cont": rng.normal(size=(n, 1)), "label": rng.integers(0, 3, n),
    }


@pytest.mark.parametrize("model_type", W.MODEL_TYPES)
def test_gradient(model_type):
    """Analytic gradient against central differences."""
    params = W.dense_params(SPEC, 3, model_type, (6, 4), 3)
    if model_type != "deep":
        params["wide"] = np.zeros((7, 3))
    if model_type != "wide":
        params["embed0"] = np.zeros((4, 5))
    rng = np.random.default_rng(0)
    params = {k: v + rng.normal(0, 0.1, v.shape) for k, v in params.items()}
    held = batch()
    _, _, grads = W.loss_and_gradient(params, SPEC, held)
    for name, p in params.items():
        for at in np.ndindex(*p.shape):
            sides = []
            for eps in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in params.items()}
                moved[name][at] += eps
                sides.append(W.loss_and_gradient(moved, SPEC, held, False)[0])
            assert abs((sides[0] - sides[1]) / 2e-6 - grads[name][at]) < 1e-4, (name, at)


@pytest.fixture(scope="module")
def trained(assembled):
    config = W.TrainConfig(epochs=12, steps_per_epoch=2, learning_rate=3e-2, decay=1e-5)
    return W.train_joint(assembled, SPEC, 3, config, valid=assembled)


def test_loss_falls(trained):
    held = trained[1].where("split = 'train' and metric = 'loss'").orderBy("step").collect()
    assert len(held) == 24 and held[-1]["value"] < 0.5 * held[0]["value"]


def test_accuracy_beats_majority(trained, assembled):
    last = trained[1].where("split = 'valid' and metric = 'accuracy'").orderBy(F.desc("step")).first()
    scored = W.score_pairs(trained[0], assembled).join(assembled.select("item_id", "label"), "item_id")
    share = E.accuracy(scored).first()["accuracy"]
    assert share > 0.8 and abs(share - last["value"]) < 1e-9
    assert scored.select(F.max(F.abs(F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p) - 1))).first()[0] < 1e-9


def held_weights(model):
    return {r["key"]: np.frombuffer(bytes(r["value"])) for r in model.table.collect()}


def test_weights_do_not_depend_on_partitions(assembled, monkeypatch):
    """Nor on how a gradient is cut into chunks, nor on when logs are merged."""
    config = W.TrainConfig(epochs=2, steps_per_epoch=2, learning_rate=3e-2, decay=1e-5)
    two, _ = W.train_joint(assembled.repartition(2), SPEC, 3, config)
    monkeypatch.setattr(sparse, "WEIGHT_CHUNK", 50)
    monkeypatch.setattr(sparse, "MERGE_STEPS", 3)
    eight, _ = W.train_joint(assembled.repartition(8), SPEC, 3, config)
    assert all(np.allclose(two.dense[k], eight.dense[k]) for k in two.dense)
    one, other = held_weights(two), held_weights(eight)
    assert one.keys() == other.keys() and all(np.allclose(one[k], other[k]) for k in one)


def test_training_equals_training_in_memory(assembled):
    """Against the same steps on one dense set of weights in numpy."""
    config = W.TrainConfig(epochs=3, steps_per_epoch=1, learning_rate=3e-2, decay=1e-5)
    model, history = W.train_joint(assembled, SPEC, 3, config)
    learner = W.JointLearner(SPEC, 3, "joint", config.seed)
    params = W.dense_params(SPEC, 3, "joint", config.hidden, config.seed)
    params["wide"] = np.array([learner.initial(k) for k in range(7)])
    params["embed0"] = np.array([learner.initial(k) for k in range(7, 11)])
    data = assembled.toPandas()
    held = {c: np.array(data[c].tolist()) for c in ("wide", "indicator", "embed", "cont")}
    held["label"] = data["label"].to_numpy() - 1
    flat = sparse.flatten(params)
    first, second, losses = np.zeros_like(flat), np.zeros_like(flat), []
    for step in range(1, 4):
        loss, _, grads = W.loss_and_gradient(params, SPEC, held)
        losses.append(loss / len(data))
        mean = sparse.flatten({k: grads[k] for k in params}) / len(data)
        flat, first, second = config.moved(step, mean, flat, first, second)
        params = sparse.unflatten(flat, params)
    found = [r["value"] for r in history.where("metric = 'loss'").orderBy("step").collect()]
    assert np.allclose(found, losses)
    assert all(np.allclose(model.dense[k], params[k]) for k in model.dense)
    own = held_weights(model)
    assert np.allclose([own[k] for k in range(7)], params["wide"])
    assert np.allclose([own[k] for k in range(7, 11)], params["embed0"])


def test_batch_size_is_kept(assembled):
    """As many steps as batches, however many."""
    _, history = W.train_joint(assembled, SPEC, 3, W.TrainConfig(epochs=1, batch_size=40))
    assert history.where("metric = 'loss'").count() == -(-assembled.count() // 40)


def test_save_and_load(spark, trained, assembled, monkeypatch):
    monkeypatch.setattr(sparse, "WEIGHT_CHUNK", 7)
    path = scratch_path(spark, "wnd")
    save_model(trained[0], spark, path)
    again = load_model(spark, path, "joint")
    one, two = (
        {r["item_id"]: tuple(r["probabilities"]) for r in W.score_pairs(m, assembled).collect()}
        for m in (trained[0], again)
    )
    assert one == two and again.spec == SPEC


def test_any_number_of_ids(spark):
    """A thousand million ids: the table holds those that occur."""
    big = FeatureSpec(embed_cols=["e"], embed_in=[10**9], embed_out=[4])
    ids = F.when(F.col("id") % 2 == 0, F.lit(999_999_999)).otherwise(F.lit(5)).cast("int")
    df = spark.range(200).select(F.col("id"), ids.alias("e"), (F.col("id") % 2 + 1).cast("int").alias("label"))
    rows = assemble(df, big, F.lit(1), "id")
    model, _ = W.train_joint(rows, big, 2, W.TrainConfig(epochs=20, learning_rate=0.1, hidden=(4,)), "deep")
    assert {r["key"] for r in model.table.collect()} == {5, 999_999_999}
    scored = W.score_pairs(model, rows).join(rows.select("item_id", "label"), "item_id")
    assert E.accuracy(scored).first()["accuracy"] == 1.0


def test_files_grow_with_rows_not_with_batches(assembled, monkeypatch):
    """A slice is read from one folder of many slices."""
    learner = W.JointLearner(SPEC, 3, "joint")
    examples = W._examples(assembled, learner)
    table = sparse.index_batches(examples, 300, 1200, 0)
    assert len(table.inputFiles()) == 1
    monkeypatch.setattr(sparse, "SHELF_ROWS", 400)
    table = sparse.index_batches(examples, 300, 1200, 0)
    assert len(table.inputFiles()) == 3
    assert table.select("row").distinct().count() == 1200
    part = sparse.one_slice(table, 300, 1200, 150)
    assert {r["slice"] for r in part.collect()} == {150} and len(part.inputFiles()) == 3
    plan = part._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(slice), EqualTo(slice,150)]" in plan and "PartitionFilters: [isnotnull(shelf" in plan


def test_wide_job(spark, rows):
    done = jobs.train_job(rows, SPEC, 3, "id", model_type="wide", config=W.TrainConfig(epochs=30))
    joined = done.predictions.join(rows.select(F.col("id").alias("item_id"), "label"), "item_id")
    assert E.accuracy(joined).first()["accuracy"] > 0.4
    assert {r["label"]: r["count"] for r in done.distribution.collect()} == {1: 400, 2: 400, 3: 400}
    assert done.user_recs.count() == 5
    assert done.item_recs.count() == done.predictions.count()
    path = scratch_path(spark, "lr")
    save_model(done.model, spark, path)
    again, _, _ = jobs.score_job(load_model(spark, path, "linear"), rows, SPEC, "id")
    assert again.count() == 1200


def test_joint_job(rows):
    config = W.TrainConfig(epochs=2, steps_per_epoch=2, learning_rate=1e-2)
    done = jobs.train_job(rows, SPEC, 3, "id", config=config)
    predictions, user_recs, _ = jobs.score_job(done.model, rows.drop("label"), SPEC, "id")
    assert predictions.count() == 1200 and user_recs.count() == 5


def test_logistic_job(spark):
    df = spark.range(900).select(
        F.col("id"), (F.col("id") % 3).cast("double").alias("label"),
        (F.col("id") % 3 * 10 + F.col("id") % 2).alias("x"), F.lit(1.0).alias("y"),
    )
    data = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    model, predictions, accuracy = jobs.logistic_job(data, ["id"])
    assert accuracy.first()["accuracy"] == 1.0
    assert linear.loss_series(model, spark).count() > 1
    assert 150 < predictions.count() < 300


@pytest.mark.parametrize("hashed", [False, True])
def test_text_classifier(spark, hashed):
    df = spark.range(400).select(
        F.col("id"), (F.col("id") % 2).cast("int").alias("label"),
        F.array(F.when(F.col("id") % 2 == 0, "good").otherwise("bad"), F.lit("the")).alias("tokens"),
    )
    model = linear.train_text_classifier(df, hashed=hashed)
    assert E.accuracy(linear.score_text(model, df)).first()["accuracy"] == 1.0


def test_text_job_and_save(spark):
    df = spark.range(300).select(
        F.col("id"), (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 2 == 0, "a Good one").otherwise("a bad one").alias("text"),
    )
    model, scored, vocab = jobs.text_classifier_job(df, "id")
    assert E.accuracy(scored).first()["accuracy"] == 1.0
    assert {r["token"] for r in vocab.collect()} == {"a", "one", "good", "bad"}
    path = scratch_path(spark, "text")
    save_model(model, spark, path)
    assert load_model(spark, path, "text").stages[0].vocabulary == model.stages[0].vocabulary
    with pytest.raises(ValueError):
        load_model(spark, path, "other")


def test_few_vectors_need_no_tables(spark, assembled, monkeypatch):
    """Vectors that fit into SENT_BYTES make the same steps, without a log for each step; keys
    of held-out rows that training has not seen have their initial values."""
    config = W.TrainConfig(epochs=2, steps_per_epoch=3, learning_rate=3e-2, decay=1e-5)
    seen, unseen = assembled.where("item_id % 4 < 3"), assembled.where("item_id % 4 = 3")
    with monkeypatch.context() as patch:
        patch.setattr(sparse, "SENT_BYTES", 0)
        written, long = W.train_joint(seen, SPEC, 3, config, valid=unseen)

    def fail(*_):
        raise AssertionError("a step wrote a log")

    monkeypatch.setattr(sparse, "sums", fail)
    held, short = W.train_joint(seen, SPEC, 3, config, valid=unseen)
    assert all(np.allclose(held.dense[k], written.dense[k]) for k in written.dense)
    one, other = held_weights(held), held_weights(written)
    assert one.keys() == other.keys() and all(np.allclose(one[k], other[k]) for k in one)
    key = ["step", "epoch", "split", "metric"]
    mine, theirs = (h.toPandas().sort_values(key) for h in (short, long))
    assert (mine[key].to_numpy() == theirs[key].to_numpy()).all() and np.allclose(mine["value"], theirs["value"])
    none, _ = W.train_joint(seen.where("false"), SPEC, 3, config)
    assert none.table.count() == 0


def jobs_of(spark, name, work):
    """(result, number of Spark jobs) of work()."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")


def test_many_steps_are_few_jobs(spark, assembled):
    config = W.TrainConfig(epochs=2, steps_per_epoch=60)
    (_, history), jobs_run = jobs_of(spark, "steps", lambda: W.train_joint(assembled, SPEC, 3, config, valid=assembled))
    assert history.where("metric = 'loss' and split = 'train'").count() == 120 and jobs_run < 120


def test_runs_of_some_slices(spark, monkeypatch):
    """Vectors of all keys that no task may hold: runs of as many slices as have few enough make
    the steps that one run makes in the same order, and no log for each step."""
    big = FeatureSpec(embed_cols=["e", "f"], embed_in=[10**6, 3], embed_out=[4, 2])
    df = spark.range(240).select(
        "id", (F.col("id") * 7 % 200).cast("int").alias("e"), (F.col("id") % 3).cast("int").alias("f"),
        (F.col("id") % 2 + 1).cast("int").alias("label"),
    )
    rows = assemble(df, big, F.lit(1), "id")
    config = W.TrainConfig(epochs=3, steps_per_epoch=9, learning_rate=0.1, hidden=(4,))
    sizes, run_size, plan = [], sparse.run_size, []

    def fail(*_):
        raise AssertionError("a step wrote a log")

    monkeypatch.setattr(sparse, "sums", fail)
    with monkeypatch.context() as patch:
        patch.setattr(sparse, "SENT_BYTES", 32 * 45)
        patch.setattr(sparse, "STATE_BYTES", 32 * 7)
        patch.setattr(sparse, "PIECE_LINES", 16)
        patch.setattr(sparse, "run_size", lambda *a: sizes.append(run_size(*a)) or sizes[-1])
        some, first = W.train_joint(rows, big, 2, config, "deep", rows)
    assert 1 <= sizes[0] <= 4
    for epoch in (1, 2, 3):
        plan.append((0, [x for _, steps in sparse.schedule(config, 9, sizes[0], 1) for x in steps if x[0] == epoch]))
    assert all(sorted(slice for _, slice in steps) == list(range(9)) for _, steps in plan)
    monkeypatch.setattr(sparse, "schedule", lambda *_: plan)
    whole, second = W.train_joint(rows, big, 2, config, "deep", rows)
    assert all(np.allclose(some.dense[k], whole.dense[k]) for k in some.dense)
    one, other = held_weights(some), held_weights(whole)
    assert len(one) == 203 and one.keys() == other.keys() and all(np.allclose(one[k], other[k]) for k in one)
    key = ["step", "epoch", "split", "metric"]
    mine, theirs = (h.toPandas().sort_values(key) for h in (first, second))
    assert (mine[key].to_numpy() == theirs[key].to_numpy()).all() and np.allclose(mine["value"], theirs["value"])
