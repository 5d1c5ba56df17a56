import random

import numpy as np
import pyarrow as pa
import pytest

from marlspike.llm import toxicity
from tests.llm.support import docs, write


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for i in range(1200):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(rng.randint(3, 60))]
        bad = i % 6 == 0
        for _ in range((1 if i % 12 else 6) if bad else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["Scoundrel!", "rascal,", "VILLAINOUS", "villainy"]))
        out.append((i, " ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def model(spark, rows):
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k % 5], "doc_id long, toxic int")
    return toxicity.train(docs(spark, [(k, t) for k, t, _ in rows]), labels)


def test_held_out(spark, rows, model):
    held = [(k, t) for k, t, _ in rows if k % 5 == 0]
    truth = {k: y for k, _, y in rows}
    found = {r.doc: r for r in toxicity.judge(docs(spark, held), model).collect()}
    assert np.mean([(found[k].p_toxic > 0.5) == truth[k] for k, _ in held]) > 0.98
    heavy = [found[k].expected_severity for k, _ in held if k % 12 == 0]
    light = [found[k].expected_severity for k, _ in held if k % 6 == 0 and k % 12]
    clean = [found[k].expected_severity for k, _ in held if k % 6]
    assert min(map(np.mean, (heavy, light, clean))) == np.mean(clean)
    assert np.mean(heavy) > np.mean(light)


def test_odd_texts(spark, model):
    texts = [(1, None), (2, ""), (3, "alpha " * 100_000), (4, "rascal scoundrel " * 50), (5, "!!!"), (5, "beta"), (None, "rascal")]
    found = sorted(((r.doc, r.p_toxic > 0.5) for r in toxicity.judge(docs(spark, texts, ["doc", "severity"]), model).collect()), key=str)
    assert found == [(1, False), (2, False), (3, False), (4, True), (5, False), (5, False), (None, True)]


def test_query_and_empty_tables(spark, rows, tmp_path):
    folder = write(docs(spark, [(k, t) for k, t, _ in rows], ["toxic"]), tmp_path)
    spark.createDataFrame([(0, 1, None), (1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found = toxicity.op9_toxicity(spark, folder).collect()
    assert len(found) == len(rows) and not any(r.toxic or r.severity for r in found)
    assert toxicity.judge(docs(spark, []), toxicity.train(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_probabilities_follow_the_thresholds():
    scores, thresholds = np.array([-3.0, 0.0, 5.0]), np.array([-1.0, 2.0])
    chance = toxicity.probabilities(scores, thresholds)
    assert np.allclose(chance.sum(axis=1), 1) and (chance > 0).all()
    assert np.allclose(chance[:, 0], 1 / (1 + np.exp(scores + 1)))
    assert np.allclose(chance[:, 2], 1 / (1 + np.exp(2 - scores)))


def test_fit_recovers_an_ordinal_model():
    rng = np.random.default_rng(0)
    text = np.repeat(np.arange(4000), 3)
    place = np.concatenate([rng.permutation(5)[:3] for _ in range(4000)])
    truth = np.array([2.0, 1.0, 0.0, -1.0, 3.0])
    score = np.bincount(text, truth[place])
    grade = (score[:, None] + rng.logistic(size=(4000, 1)) > np.array([1.0, 4.0])).sum(axis=1)
    weights, thresholds = toxicity.fit(text, place, np.ones(len(text)), grade, 5)
    assert np.corrcoef(weights, truth)[0, 1] > 0.99
    assert thresholds[1] - thresholds[0] == pytest.approx(3.0, abs=0.4)


def test_features():
    _, codes, hashes, words = toxicity.text_features(pa.array(["Rascal, rascal! é", None, "ras"]))
    assert words.tolist() == [3, 0, 1]
    assert hashes[codes[0]].tolist() == hashes[codes[1]].tolist()
    assert (hashes[codes[3]][1:] == 0).all()
