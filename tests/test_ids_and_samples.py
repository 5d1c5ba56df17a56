import pytest
from pyspark.sql import functions as F

from marlspike.functions.hashing import row_hash
from marlspike.operators import ids, profile, relate, sample


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("label"),
    )


def test_ids_equal_simple_form(spark, rows):
    for desc in (False, True):
        found = ids.assign_ids(rows, "key", desc=desc).collect()
        expected = {r["key"]: (5000 - r["key"] if desc else r["key"] + 1) for r in found}
        assert {r["key"]: r["id"] for r in found} == expected
        assert len(found) == 5000


def test_ids_with_a_hot_value(spark):
    """A third of the rows share one value, some rows are exact copies."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("name"),
        (F.col("id") % 5).alias("v"),
    )
    found = ids.assign_ids(df, "name").collect()
    assert sorted(r["id"] for r in found) == list(range(1, 3001))
    by_id = [r["name"] for r in sorted(found, key=lambda r: r["id"])]
    assert by_id == sorted(by_id)


def test_ids_with_null_key(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, v int")
    found = {r["v"]: r["id"] for r in ids.assign_ids(df, "k", as_string=True).collect()}
    assert found == {2: "1", 3: "2", 1: "3"}


def test_running_sums(spark, rows):
    found = ids.running_sums(rows.select("key"), [F.asc("key")], ["key"]).collect()
    assert all(r["run_key"] == r["key"] * (r["key"] + 1) // 2 for r in found)
    assert {r["all_key"] for r in found} == {4999 * 5000 // 2}


def lowest(rows, seed, key="key"):
    """Brute force: keys of each class by hash."""
    held = rows.select("label", key, row_hash([key], seed).alias("h")).collect()
    out = {}
    for r in sorted(held, key=lambda r: r["h"]):
        out.setdefault(r["label"], []).append(r[key])
    return out


def test_balance(rows):
    found = sample.balance_classes(rows, "label", "key", 3).collect()
    expected = {c: set(keys[:500]) for c, keys in lowest(rows, 3).items()}
    assert {c: {r["key"] for r in found if r["label"] == c} for c in "abc"} == expected
    assert len(found) == 1500


def test_balance_with_classes_beyond_the_broadcast_check(rows, monkeypatch):
    monkeypatch.setattr(sample, "SMALL_CLASSES", 1)
    found = sample.balance_classes(rows, "label", "key", 3).collect()
    assert sorted(r["key"] for r in found) == sorted(
        k for keys in lowest(rows, 3).values() for k in keys[:500]
    )


def test_counts_with_a_hot_key(spark):
    """Exact counts although one key holds a third of a class."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("key"), F.lit("x").alias("label")
    )
    for n in (1, 500, 999, 1500, 2999, 5000):
        assert sample.sample_counts(df, "label", {"x": n}, "key", 1).count() == min(n, 3000)


def test_sample_counts_keeps_other_classes(rows):
    found = sample.sample_counts(rows, "label", {"a": 100}, "key", 1).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in found} == {"a": 100, "b": 1000, "c": 500}


def test_take_n(rows):
    whole = rows.withColumn("h", row_hash(["key"], 5)).orderBy("h").limit(300).collect()
    assert {r["key"] for r in sample.take_n(rows, 300, "key", 5).collect()} == {r["key"] for r in whole}
    assert sample.take_n(rows, 10**6, "key", 5).count() == 5000


def test_ties_do_not_depend_on_partitions(spark):
    """One key on many rows: the same rows are taken however they are dealt out."""
    df = spark.range(400).select((F.col("id") % 3).alias("key"), F.col("id").alias("v"), F.lit("x").alias("label"))
    taken = [
        {r["v"] for r in sample.take_n(dealt, 150, "key", 2).collect()}
        for dealt in (df.coalesce(1), df.repartition(13), df.repartition(7, "v"))
    ]
    assert taken[0] == taken[1] == taken[2] and len(taken[0]) == 150


def test_split_is_disjoint_and_whole(rows):
    parts = sample.split(rows, {"train": 0.8, "valid": 0.1, "test": 0.1}, "key", 2)
    keys = {name: {r["key"] for r in df.collect()} for name, df in parts.items()}
    assert sum(map(len, keys.values())) == 5000
    assert len(set.union(*keys.values())) == 5000
    assert abs(len(keys["train"]) - 4000) < 150


def test_samples_do_not_depend_on_partitions(rows):
    one = sample.stratified_sample(rows.coalesce(1), "label", {"a": 0.3}, "key", 4)
    many = sample.stratified_sample(rows.repartition(13), "label", {"a": 0.3}, "key", 4)
    assert {r["key"] for r in one.collect()} == {r["key"] for r in many.collect()}
    assert one.where("label <> 'a'").count() == 1500


def test_negative_samples(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("u"), (F.col("id") % 37 + 1).alias("i"))
    found = sample.negative_samples(df, "u", "i", 1).collect()
    seen = {(r["u"], r["i"]) for r in df.collect()}
    drawn = [(r["u"], r["i"]) for r in found if r["label"] == 1]
    assert not seen & set(drawn) and len(drawn) == len(set(drawn))
    assert {(r["u"], r["i"]) for r in found if r["label"] == 2} == seen
    assert all(1 <= i <= 37 for _, i in drawn)


def test_dictionary(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", "a", "c", "a", None, ""]], "v string")
    fitted = profile.fit_dictionary(df, "v")
    assert {r["value"]: r["idx"] for r in fitted.collect()} == {"a": 1, "b": 2, "": 3, "c": 4}
    new = spark.createDataFrame([("c",), ("zz",), (None,)], "v string")
    applied = profile.apply_dictionary(new, fitted, "v", "i").collect()
    assert {r["v"]: r["i"] for r in applied} == {"c": 4, "zz": 0, None: 0}
    assert {r["i"] for r in profile.apply_dictionary(new, fitted, "v", "i", 9).collect()} == {4, 9}
    assert profile.dictionary_size(fitted) == 5 and profile.dictionary_size(fitted.limit(0)) == 1


def test_dictionary_grows_and_keeps_its_ids(spark):
    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "v string")

    def held(dictionary):
        return {r["value"]: (r["count"], r["idx"], r["since"]) for r in dictionary.collect()}

    one = profile.extend_dictionary(None, rows("b", "b", "a", None), "v", 1)
    assert held(one) == {"b": (2, 1, 1), "a": (1, 2, 1)}
    two = profile.extend_dictionary(one, rows("a", "a", "a", "z", "z", "c", "", None), "v", 2)
    assert held(two) == {"b": (2, 1, 1), "a": (4, 2, 1), "z": (2, 3, 2), "": (1, 4, 2), "c": (1, 5, 2)}
    assert held(profile.extend_dictionary(two, rows(None), "v", 3)) == held(two)
    assert held(profile.extend_dictionary(one.limit(0), rows("q"), "v", 2)) == {"q": (1, 1, 2)}


def test_ranked_join_beyond_the_limit(spark, monkeypatch):
    """Head broadcast and tail shuffled give what one join gives."""
    ranked = spark.range(1, 101).select(F.concat(F.lit("t"), F.col("id")).alias("t"), F.col("id").cast("int").alias("i"))
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "t1").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("t"), F.col("id") % 130)).alias("t"),
        F.col("id").alias("n"),
    )
    one = {(r["n"], r["t"], r["i"]) for r in relate.join_ranked(df, ranked, "t", "i", 1000).collect()}
    two = {(r["n"], r["t"], r["i"]) for r in relate.join_ranked(df, ranked, "t", "i", 5).collect()}
    assert one == two and len(two) == 1000
    monkeypatch.setattr(relate, "LOCAL_ROWS", 1)
    three = {(r["n"], r["t"], r["i"]) for r in relate.join_ranked(df, ranked, "t", "i", 100).collect()}
    assert one == three


def test_relations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    known = spark.createDataFrame([("a",), ("a",)], "k string")
    assert {r["v"] for r in relate.exclude(df, known, "k").collect()} == {3, 4}
    assert {(r["k"], r["v"]) for r in relate.dedup(df, "k", "v").collect()} == {("a", 1), ("b", 3), (None, 4)}
    last = relate.dedup(df, "k", "v", keep="last").collect()
    assert {(r["k"], r["v"]) for r in last} == {("a", 2), ("b", 3), (None, 4)}
    population = relate.build_population(df, known, df.select("k"), "k", "v").collect()
    assert {(r["k"], r["label"]) for r in population} == {("a", 1), ("b", 2)}


def test_profile_states_unite_like_one_pass(spark):
    df = spark.range(20_000).select(
        F.col("id"), (F.col("id") % 4).cast("int").alias("day"), F.concat(F.lit("v"), F.col("id") % 9000).alias("name"),
        F.lit(None).cast("string").alias("none"), F.when(F.col("id") % 2 == 0, "").alias("blank"),
    )
    cols = ["id", "name", "none", "blank"]
    saved = profile.profile_state(df, cols, ["day"])
    assert saved.count() == 16
    states = {r["name"]: r for r in profile.read_states(profile.unite_states(saved)).collect()}
    once = {r["name"]: r for r in profile.read_states(profile.profile_state(df, cols)).collect()}
    exact = {"id": 20_000, "name": 9000, "none": 0, "blank": 1}
    for name, n in exact.items():
        assert states[name]["at_least"] <= n <= states[name]["at_most"]
        assert once[name]["at_least"] <= n <= once[name]["at_most"]
    assert states["id"]["largest"] == 19_999 and states["name"]["largest"] is None
    assert states["none"]["n"] == 0 and states["blank"]["n"] == 10_000
    assert profile.unite_states(saved.limit(0)).count() == 0


def test_a_sample_reads_the_rows_twice(spark, rows):
    """Once for the table of keys, once for the sample, whatever the number of histograms."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    kept = sample.balance_classes(rows.mapInArrow(counted, rows.schema), "label", "key", 3)
    assert kept.groupBy("label").count().where("count = 500").count() == 3
    assert read.value == 2 * 5000
