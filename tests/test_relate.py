import statistics

import pytest
from pyspark.sql import functions as F

from marlspike.operators import relate


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle with one task a partition, as large tables meet."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def facts(spark, rows=40_000):
    """Half of the rows share one key, an eighth has no key."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 8 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(rows).select(key.cast("int").alias("k"), (F.col("id") % 3).alias("v"))


def dimension(spark):
    return spark.range(4000).select("id", F.concat(F.lit("n"), "id").alias("name")).withColumnRenamed("id", "k")


def rows_of(df):
    return sorted(map(tuple, df.select("k", "v", "name").collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_spread_equals_join(spark, how):
    df, dim = facts(spark, 8000), dimension(spark)
    dim = dim.unionByName(dim.where("k = 7 OR k = 11").withColumn("name", F.lit("again")))
    found, plain = relate.join_spread(df, dim, "k", how), df.join(dim, "k", how)
    assert found.columns == plain.columns and rows_of(found) == rows_of(plain)


def test_join_spread_on_two_keys_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 2), ("a", 2, 3)] + [("b", 1, 4)] * 50, "s string, i int, v int")
    dim = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), (None, 1, "z")], "s string, i bigint, name string")
    for left, right in ((df, dim), (df.limit(0), dim), (df, dim.limit(0))):
        found = relate.join_spread(left, right, ["s", "i"])
        plain = left.join(right, ["s", "i"], "left")
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError, match="left"):
        relate.join_spread(df, dim, ["s", "i"], "full")


def test_no_task_gets_much_more_than_another(spark, shuffled):
    def sizes(joined):
        return [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]

    df, dim = facts(spark), dimension(spark)
    spread = sizes(relate.join_spread(df, dim, "k"))
    plain = sizes(df.join(dim, "k", "left"))
    assert sum(spread) == sum(plain) == 40_000
    assert max(plain) > 5 * statistics.median(plain)
    assert max(spread) < 2 * statistics.median(spread)


def test_heavy_keys_are_those_that_hold_a_part_of_a_partition(spark):
    found = relate.heavy_keys(facts(spark), "k", ["int"], 8).collect()
    assert len(found) == 1 and 60 <= found[0]["_pieces"] <= 90
    assert relate.heavy_keys(facts(spark).limit(0), "k", ["int"], 8).count() == 0


def test_join_predictions_keeps_the_order_of_columns(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "name string, k int, v string")
    predictions = spark.createDataFrame([(0.5, 1, "p"), (0.2, 9, "q"), (0.1, None, "r")], "score double, k int, v string")
    found, plain = relate.join_predictions(base, predictions, "k"), base.join(predictions, ["k"], "right")
    assert found.columns == plain.columns == ["k", "name", "v", "score", "v"]
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("limit", [0, 20_000])
def test_exclude_keeps_rows_without_a_key(spark, monkeypatch, limit):
    """The same rows by the plain join and by the one that splits heavy keys."""
    monkeypatch.setattr(relate, "LOCAL_ROWS", limit)
    df, known = facts(spark, 8000), dimension(spark).unionByName(dimension(spark))
    for some in (known.where("k != 7"), known, known.limit(0)):
        found = relate.exclude(df, some, "k")
        keys = {r["k"] for r in some.select("k").distinct().collect()}
        want = sorted((tuple(r) for r in df.collect() if r["k"] not in keys), key=str)
        assert found.columns == ["k", "v"] and sorted(map(tuple, found.collect()), key=str) == want


def test_exclude_spreads_a_heavy_key(spark, shuffled):
    found = relate.join_spread(facts(spark), dimension(spark).where("k != 7").select("k"), "k", "left_anti")
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * statistics.median(sizes)
