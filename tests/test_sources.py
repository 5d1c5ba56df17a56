import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import types as T

from marlspike.session import scratch_path
from marlspike.sources import parsers, readers, schemas, sinks, versions


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_predictions(spark):
    found = parsers.parse_predictions(
        lines(spark, "UserItemPrediction(1,12,2,0.6)", "UserItemPrediction(1,x,2,1.0E-4)", "junk")
    ).collect()
    assert [tuple(r) for r in found] == [(1, 12, 2, 0.6), (1, None, 2, 1e-4), (None,) * 4]


def test_labels_with_commas_and_spaces(spark):
    found = parsers.parse_label_lines(
        lines(spark, "(12,A, B公司) __label__2 0.9", "(3,C (x),(y))\t__label__10", "no label", "(4,) __label__1")
    ).collect()
    assert [tuple(r) for r in found] == [("A, B公司", "2"), ("C (x),(y)", "10"), ("", "1")]


def test_bind_schema(spark):
    df = spark.createDataFrame([("x", "7", "junk")], "name string, s string, id string")
    want = T.StructType.fromDDL("company string, score int, id bigint")
    bound = readers.bind_schema(df, want, rename={"name": "company", "s": "score"})
    assert bound.dtypes == [("company", "string"), ("score", "int"), ("id", "bigint")]
    assert tuple(bound.first()) == ("x", 7, None)
    with pytest.raises(ValueError, match="missing columns: score"):
        readers.bind_schema(df, want, rename={"name": "company"})


def test_libsvm(spark):
    path = scratch_path(spark, "svm")
    made = [f"{c} 1:{c + 1} 2:{v}" for c, v in ((0, 10), (1, 50), (2, 100)) for _ in range(6)]
    sinks.save(lines(spark, *made), path, "text")
    df = readers.read_libsvm(spark, path, 2).withColumn("v", vector_to_array("features"))
    assert df.count() == 18
    assert {(r["label"], *r["v"]) for r in df.collect()} == {(0.0, 1.0, 10.0), (1.0, 2.0, 50.0), (2.0, 3.0, 100.0)}


def test_delimited(spark):
    path = scratch_path(spark, "star")
    sinks.save(lines(spark, "2::cloud::IT", "3::云::服务"), path, "text", files=1)
    found = readers.read_delimited(spark, path, schemas.STAR_TAG).collect()
    assert {tuple(r) for r in found} == {(2, "cloud", "IT"), (3, "云", "服务")}


def test_stopwords(spark):
    path = scratch_path(spark, "stop")
    sinks.save(lines(spark, "的", "the", "", "the", "。"), path, "text")
    assert {r["token"] for r in readers.load_stopwords(spark, path).collect()} == {"的", "the", "。"}


def test_save(spark):
    path = scratch_path(spark, "out")
    df = spark.range(100)
    sinks.save(df, path, files=1)
    sinks.save(df.limit(7), path, files=1)
    assert spark.read.parquet(path).count() == 7
    assert len(spark.read.parquet(path).inputFiles()) == 1
    with pytest.raises(ValueError):
        sinks.save(df, path, "text")
    with pytest.raises(ValueError):
        sinks.save(df, path, "xlsx")
    with pytest.raises(ValueError):
        sinks.save(df)


def test_jdbc_options():
    held = sinks.jdbc_options("jdbc:x", "db.t", "u", "p", "driver.Class", 2)
    assert held == {
        "url": "jdbc:x", "dbtable": "db.t", "user": "u", "password": "p",
        "driver": "driver.Class", "fetchsize": "2",
    }


def test_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError, match="no version"):
        versions.read_version(spark, path)
    assert versions.publish(spark.range(3), path) == 1
    failing = spark.range(5).selectExpr("CAST(raise_error('on purpose') AS BIGINT) AS id")
    with pytest.raises(Exception, match="on purpose"):
        versions.publish(failing, path)
    assert versions.read_version(spark, path).count() == 3
    # the version before is read while the next one is written
    assert versions.publish(versions.read_version(spark, path).where("id > 0"), path) == 2
    assert versions.read_version(spark, path).count() == 2
    assert versions.read_version(spark, path, 1).count() == 3
    with pytest.raises(ValueError, match="no version 9"):
        versions.read_version(spark, path, 9)
