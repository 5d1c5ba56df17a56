"""Reproducible sampling and splitting by a hash of the row key.

A row's fate depends on its key and the seed only, so samples do not change
with partitioning, retries or engine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.functions.hashing import HASH_BITS, row_hash, threshold
from marlspike.operators.ids import number_rows
from marlspike.session import localize, materialize

# Each histogram looks at this many more bits of the hash (32768 ranges).
RANGE_BITS = 15
# Tables with one row per class are checked against this before a broadcast.
SMALL_CLASSES = 10_000

Key = str | Sequence[str]


def _names(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def stratified_sample(
    df: DataFrame, label: str, fractions: Mapping, key: Key, seed: int = 0, default: float = 1.0
) -> DataFrame:
    """Keep each class at its own rate; unlisted classes at the default rate.
    No shuffle: one predicate per row."""
    h = row_hash(_names(key), seed)
    limit = F.lit(threshold(default))
    for value, rate in fractions.items():
        limit = F.when(F.col(label) == F.lit(value), F.lit(threshold(rate))).otherwise(limit)
    return df.where(h < limit)


def split(
    df: DataFrame, weights: Mapping[str, float], key: Key, seed: int = 0
) -> dict[str, DataFrame]:
    """Disjoint parts that together hold every row, by ranges of one hash draw."""
    tagged = tag_split(df, weights, key, seed)
    return {name: tagged.where(F.col("split") == name).drop("split") for name in weights}


def tag_split(
    df: DataFrame, weights: Mapping[str, float], key: Key, seed: int = 0, out: str = "split"
) -> DataFrame:
    """The part of each row as a column; one scan for all parts."""
    total = sum(weights.values())
    h = row_hash(_names(key), seed)
    names = list(weights)
    passed = 0.0
    part = F.lit(names[-1])
    cuts: list[tuple[str, int]] = []
    for name in names[:-1]:
        passed += weights[name] / total
        cuts.append((name, threshold(passed)))
    for name, cut in reversed(cuts):
        part = F.when(h < F.lit(cut), F.lit(name)).otherwise(part)
    return df.withColumn(out, part)


def take_n(df: DataFrame, n: int, key: Key, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all, if fewer), those with the smallest key hash."""
    whole = df.withColumn("_all", F.lit(1))
    keys, sizes, small = _keys(whole, "_all", _names(key), seed)
    needs = sizes.select("_c", F.least("_size", F.lit(n)).alias("_need"))
    return _lowest(whole, "_all", keys, needs, small, _names(key), seed).drop("_all")


def sample_counts(
    df: DataFrame, label: str, counts: Mapping, key: Key, seed: int = 0
) -> DataFrame:
    """At most the given number of rows of each listed class; other classes whole."""
    keys, sizes, small = _keys(df, label, _names(key), seed)
    quota = F.col("_size")
    for value, n in counts.items():
        quota = F.when(F.col("_c") == F.lit(value), F.least("_size", F.lit(n))).otherwise(quota)
    needs = sizes.select("_c", quota.alias("_need"))
    return _lowest(df, label, keys, needs, small, _names(key), seed)


def balance_classes(df: DataFrame, label: str, key: Key, seed: int = 0) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    keys, sizes, small = _keys(df, label, _names(key), seed)
    smallest = sizes.agg(F.min("_size").alias("n")).first()["n"]
    needs = sizes.select("_c", F.lit(smallest).cast("bigint").alias("_need"))
    return _lowest(df, label, keys, needs, small, _names(key), seed)


def _keys(
    df: DataFrame, label: str, names: list[str], seed: int
) -> tuple[DataFrame, DataFrame, bool]:
    """(class and key hash of each row, rows of each class, whether these are few).

    The hashes are written once: what the caller's plan costs, and the hashing, is not paid
    again by every histogram.
    """
    hashed = df.select(F.col(label).alias("_c"), row_hash(names, seed).alias("_h"))
    keys = materialize(hashed, "keys")
    sizes = keys.groupBy("_c").agg(F.count(F.lit(1)).alias("_size"))
    return keys, *localize(sizes, SMALL_CLASSES)


def _per_class(rows: DataFrame, facts: DataFrame, small: bool) -> DataFrame:
    """Join facts held once per class; broadcast only when their number was checked."""
    facts = facts.withColumnRenamed("_c", "_class")
    facts = F.broadcast(facts) if small else facts
    return rows.join(facts, F.col("_c").eqNullSafe(F.col("_class"))).drop("_class")


def _cut_point(counts: DataFrame, by: str) -> DataFrame:
    """Per class, the first value of `by` at which the running count reaches
    _need, its own count _n, and how many of it complete the need."""
    up_to = Window.partitionBy("_c").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("_cum") - F.col("_n")
    return (
        counts.withColumn("_cum", F.sum("_n").over(up_to))
        .where((before < F.col("_need")) & (F.col("_cum") >= F.col("_need")))
        .select("_c", by, "_n", (F.col("_need") - before).alias("_take"))
    )


def _lowest(
    df: DataFrame,
    label: str,
    keys: DataFrame,
    needs: DataFrame,
    small: bool,
    names: list[str],
    seed: int,
) -> DataFrame:
    """Per class, exactly _need rows: those with the smallest key hash.

    Found by counting, not by ranking. A histogram of hash ranges finds the
    range that holds the cut, the next one looks inside that range, and so on
    to the cut value; the rows then come from a plain filter. Only the written
    keys are read before that filter, each task sends at most one count per
    class and range, and no class is gathered in one task.
    """
    h = row_hash(names, seed)
    inside = keys
    shift = HASH_BITS
    while shift:
        shift = shift - RANGE_BITS
        ranges = inside.groupBy("_c", F.shiftright("_h", shift).alias("_b")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        cuts, small = localize(_cut_point(_per_class(ranges, needs, small), "_b"), SMALL_CLASSES)
        if not shift:
            break
        needs = cuts.select("_c", F.col("_take").alias("_need"))
        place = cuts.select("_c", F.col("_b").alias("_range"))
        held = _per_class(keys, place, small)
        inside = held.where(F.shiftright("_h", shift) == F.col("_range")).select("_c", "_h")

    cuts = cuts.select("_c", F.col("_b").alias("_cut"), "_n", "_take")
    marked = df.withColumns({"_c": F.col(label), "_h": h})
    marked = _per_class(marked, cuts, small)
    shared = cuts.where(F.col("_n") > F.col("_take")).agg(F.max("_n").alias("n")).first()["n"]
    if shared is None:
        return marked.where(F.col("_h") <= F.col("_cut")).select(*df.columns)

    # Some hash value at a cut is shared by more rows than fit (a repeated key):
    # they are taken in the order of the key and a hash of the caller's columns.
    below = marked.where(F.col("_h") < F.col("_cut")).select(*df.columns)
    tied = marked.where(F.col("_h") == F.col("_cut")).select(*df.columns, "_c", "_take")
    tied = materialize(tied.withColumn("_tie", F.monotonically_increasing_id()), "tied")
    order = ["_c", *names, F.xxhash64(*[f"`{c}`" for c in df.columns]), "_tie"]
    numbered = number_rows(tied, [F.col(c) if isinstance(c, str) else c for c in order], "_id")
    first = numbered.groupBy("_c").agg((F.min("_id") - 1).alias("_first"))
    ranked = _per_class(numbered, *localize(first, SMALL_CLASSES)).withColumn(
        "_place", F.col("_id") - F.col("_first")
    )
    chosen = ranked.where(F.col("_place") <= F.col("_take")).select(*df.columns)
    return below.unionByName(chosen)


def negative_samples(
    df: DataFrame, user: str, item: str, seed: int = 0, positive_label: int = 2
) -> DataFrame:
    """Observed pairs relabelled positive, plus unseen pairs labelled 1.

    Each observed pair draws one item in 1..max(item) from its hash; drawn
    pairs that were observed are dropped, repeats count once.
    """
    observed = df.select(user, item).distinct()
    top = df.agg(F.max(item)).scalar()
    drawn = (F.pmod(row_hash([user, item], seed), top) + 1).cast(df.schema[item].dataType)
    unseen = (
        observed.select(user, drawn.alias(item))
        .distinct()
        .join(observed, [user, item], "left_anti")
        .withColumn("label", F.lit(1))
    )
    return unseen.unionByName(observed.withColumn("label", F.lit(positive_label)))
