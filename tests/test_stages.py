import pytest
from pyspark.sql import functions as F

from marlspike.plans.stages import fingerprint, run_stages
from marlspike.sources.versions import read_version, versions


@pytest.fixture
def numbers(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(100).write.parquet(path)
    return path


def test_fingerprint_follows_the_files(spark, numbers):
    first = fingerprint(spark.read.parquet(numbers))
    assert first == fingerprint(spark.read.parquet(numbers))
    spark.range(5).write.mode("append").parquet(numbers)
    assert fingerprint(spark.read.parquet(numbers)) != first


def test_run_resumes_behind_the_last_committed_stage(spark, tmp_path, numbers):
    path, calls = str(tmp_path / "run"), []

    def run(broken=False, **revisions):
        def even(held):
            calls.append("even")
            return held["numbers"].where("id % 2 = 0")

        def doubled(held):
            calls.append("doubled")
            value = F.raise_error(F.lit("on purpose")).cast("bigint") if broken else F.col("id") * 2
            return held["even"].select(value.alias("id"))

        stages = [("even", even), ("doubled", doubled)]
        return run_stages(spark, path, {"numbers": spark.read.parquet(numbers)}, stages, revisions)

    with pytest.raises(Exception, match="on purpose"):
        run(broken=True)
    assert versions(spark, f"{path}/even").count() == 1 and versions(spark, f"{path}/doubled").count() == 0
    assert run()["doubled"].agg(F.sum("id")).first()[0] == 2 * sum(range(0, 100, 2))
    assert calls == ["even", "doubled", "doubled"]
    run()
    assert len(calls) == 3
    # a failure after a first success leaves the version before in place
    with pytest.raises(Exception, match="on purpose"):
        run(broken=True, doubled="2")
    assert read_version(spark, f"{path}/doubled").count() == 50
    run(doubled="2")
    assert calls[3:] == ["doubled", "doubled"]
    spark.range(100, 110).write.mode("append").parquet(numbers)
    assert run(doubled="2")["doubled"].count() == 55
    assert calls[5:] == ["even", "doubled"]


def test_stages_without_rows_and_wrong_names(spark, tmp_path):
    empty = str(tmp_path / "empty")
    spark.range(0).write.parquet(empty)
    tables = {"t": spark.read.parquet(empty)}
    out = run_stages(spark, str(tmp_path / "run"), tables, [("same", lambda held: held["t"])])
    assert out["same"].count() == 0 and out["same"].columns == ["id"]
    with pytest.raises(ValueError, match="names of their own"):
        run_stages(spark, str(tmp_path / "run"), tables, [("t", lambda held: held["t"])])
    with pytest.raises(ValueError, match="unknown stages: odd"):
        run_stages(spark, str(tmp_path / "run"), tables, [], {"odd": "1"})
