import pytest
from pyspark.sql import functions as F

from marlspike.operators import evaluate as E
from marlspike.plans import jobs


def test_f_matches_the_published_curve(spark):
    """Scores 1,2,2,2 with labels 2,2,2,0, positive above 0.5."""
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (2.0, 2.0), (2.0, 0.0)], "s double, label double")
    found = {r["threshold"]: round(r["f"], 4) for r in E.f_by_threshold(df, "s", F.col("label") > 0.5).collect()}
    assert found == {2.0: 0.6667, 1.0: 0.8571}


def test_f_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (None, 1)], "s double, label int")
    assert {r["f"] for r in E.f_by_threshold(df, "s", F.col("label") == 1).collect()} == {0.0}


def test_f_against_brute_force(spark):
    df = spark.range(2000).select(
        (F.pmod(F.xxhash64("id"), F.lit(300)) / 300).alias("s"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).cast("int").alias("label"),
    )
    rows = [(r["s"], r["label"]) for r in df.collect()]
    total = sum(y for _, y in rows)
    for r in E.f_by_threshold(df, "s", F.col("label") == 1).collect():
        chosen = [y for s, y in rows if s >= r["threshold"]]
        tp = sum(chosen)
        p, q = tp / len(chosen), tp / total
        assert abs(r["f"] - (2 * p * q / (p + q) if p + q else 0.0)) < 1e-12


@pytest.mark.parametrize("parts", [256, 2])
def test_recommend(spark, monkeypatch, parts):
    monkeypatch.setattr(E, "PARTS", parts)
    rows = [(1, i, i % 2 + 1, (i % 7) / 10) for i in range(50)] + [(2, 5, 1, 0.3)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, prediction int, probability double")
    found = [(r["user_id"], r["item_id"]) for r in E.recommend(df, "user_id", 5).orderBy("user_id", "rank").collect()]
    best = sorted((r for r in rows if r[0] == 1), key=lambda r: (-r[2], -r[3], r[1]))[:5]
    assert found == [(1, r[1]) for r in best] + [(2, 5)]


def test_groups_are_limited_before_the_shuffle(spark, data, capsys):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    cols = ("o_orderkey AS item_id", "1 AS prediction", "o_totalprice AS probability")
    E.recommend(orders.selectExpr("o_custkey AS user_id", *cols), "user_id", 5).explain()
    plan = capsys.readouterr().out
    assert "row_number(), 5, Partial" in plan.split("Exchange")[1]


def test_strict_threshold_and_disagreements(spark):
    df = spark.createDataFrame([(3, 1, 0.6), (3, 2, 0.7), (3, 3, 0.9), (1, 2, 0.9)], "label int, prediction int, probability double")
    assert E.confident(df, 0.6).count() == 3
    assert [tuple(r) for r in E.mine_disagreements(E.confident(df, 0.6), 3, [1, 2]).collect()] == [(3, 2, 0.7)]


def test_evaluate_report(spark):
    truth = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "item_id int, label int")
    predictions = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.6), (3, 2, 0.8)], "item_id int, prediction int, probability double")
    report = E.evaluate(predictions, truth, "item_id", positive=1)
    assert abs(report["accuracy"].first()["accuracy"] - 2 / 3) < 1e-12
    assert {tuple(r) for r in report["confusion"].collect()} == {(1, 1, 1), (2, 1, 1), (2, 2, 1)}
    assert max(r["f"] for r in report["f_by_threshold"].collect()) == 1.0


def test_publishing(spark):
    lines = spark.createDataFrame(
        [("UserItemPrediction(1,1,2,0.9)",), ("UserItemPrediction(1,2,1,0.6)",), ("UserItemPrediction(1,3,3,0.9)",)], "value string"
    )
    scored = spark.createDataFrame([("a", 1, 3), ("b", 2, 3), ("c", 3, 3)], "company_name string, id long, label int")
    attributes = spark.createDataFrame([("a", "x"), ("b", "y")], "company_name string, supplier string")
    assert [tuple(r) for r in jobs.publish_disagreements(lines, scored, attributes).collect()] == [("a", "x")]
    found = jobs.publish_results(lines, scored, attributes).collect()
    assert {(r["company_name"], r["supplier"], r["prediction"]) for r in found} == {("a", "x", 2), ("b", "y", 1), ("c", None, 3)}


def test_stages():
    calls = []
    stages = {name: (lambda name=name: calls.append(name)) for name in ("clean", "raw", "sample")}
    jobs.run_stage("all", stages)
    jobs.run_stage("clean", stages)
    assert calls == ["raw", "clean", "sample", "clean"]
    for bad in ("other", "evaluate"):
        with pytest.raises(ValueError):
            jobs.run_stage(bad, stages)
    with pytest.raises(ValueError):
        jobs.run_stage("all", {"odd": lambda: None})


def test_wide_text_job(spark):
    base = spark.createDataFrame([("a", "the cat", "x", "u"), ("b", "cat dog", None, "u"), ("c", "z", "z", None)], "name string, t string, u string, url string")
    stop = spark.createDataFrame([("the",)], "w string")
    found = jobs.build_wide_text(base, "name", ["t", "u"], stop, require="url", n=3).collect()
    # Folded text has the last column first: "x,the cat," and "cat dog,".
    assert {tuple(r) for r in found} == {("a", 3, 1, 0), ("b", 1, 2, 0)}
