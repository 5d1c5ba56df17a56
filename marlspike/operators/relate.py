"""Enrichment, exclusion and one-row-per-key over equal keys.

A dimension of few rows is left to Spark, which broadcasts it if its bytes allow; for a
larger one the keys that many rows share are found first and split over many tasks.
No side is broadcast by assumption.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.session import at_most, localize

# Lookup entries that pass through the driver; larger tables stay in Spark.
LOCAL_ROWS = 20_000
# A key is heavy when it holds this part of a mean shuffle partition, and is cut into
# pieces of that part, so that no task gets much more than another.
HEAVY_PART = 1 / 4
PIECE_PART = 1 / 16
# Counters of the sketch for each key that can be heavy: the more, the nearer its counts.
COUNTERS = 8

Key = str | Sequence[str]


def _names(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def heavy_keys(df: DataFrame, key: Key, kinds: Sequence[str], partitions: int) -> DataFrame:
    """(_hash, _pieces): the keys that hold more than HEAVY_PART of a mean partition, by
    hash, and the number of pieces to cut each into.

    Counted by a frequent-items sketch in each task, merged; only the key is read. There
    are at most partitions / HEAVY_PART such keys, so the table that passes through the
    driver is bounded by that, with 12 bytes a row, whatever the keys are.
    """
    most = min(int(partitions / HEAVY_PART), 100_000)
    counters = min(most * COUNTERS, 1_000_000)
    hashed = df.select(_key_hash(_names(key), kinds).alias("_h")).where("_h IS NOT NULL")
    found = hashed.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {most}, {counters})").alias("top")
    )
    mean = F.col("n") / partitions
    pieces = F.ceil(F.col("i.count") / (mean * PIECE_PART)).cast("int")
    listed = (
        found.select("n", F.explode("top").alias("i"))
        .where(F.col("i.count") > mean * HEAVY_PART)
        .select(F.col("i.item").alias("_hash"), pieces.alias("_pieces"))
    )
    return localize(listed, most)[0]


def _key_hash(names: Sequence[str], kinds: Sequence[str]) -> Column:
    """Hash of a key, null if a part is null; both sides hash the type that they share."""
    parts = [F.col(f"`{n}`").cast(k) for n, k in zip(names, kinds)]
    whole = F.lit(True)
    for part in parts:
        whole = whole & part.isNotNull()
    return F.when(whole, F.xxhash64(*parts))


def join_spread(df: DataFrame, dim: DataFrame, key: Key, how: str = "left") -> DataFrame:
    """df.join(dim, key, how) for how "left", "inner" or "left_anti", without a hot task.

    Rows of a heavy key (heavy_keys) are cut into pieces by a hash of the row and of its
    partition, both the same when a task is repeated, and the dimension's rows of that key
    are copied once for each piece: at most partitions / PIECE_PART copies beyond one for
    each heavy key, for a unique key. Rows without a key meet nothing, so they are spread too.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError("how is 'left', 'inner' or 'left_anti'")
    names = _names(key)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = df.select(*names).unionByName(dim.select(*names)).schema
    kinds = [shared[n].dataType.simpleString() for n in names]
    heavy = F.broadcast(heavy_keys(df, names, kinds, partitions))
    hashable = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    row = F.xxhash64(*hashable, F.spark_partition_id())
    piece = (
        F.when(F.col("_hash").isNull(), -1 - F.pmod(row, F.lit(int(partitions / PIECE_PART))))
        .when(F.col("_pieces").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.pmod(row, F.col("_pieces")))
    )
    left = df.withColumn("_hash", _key_hash(names, kinds)).join(heavy, "_hash", "left")
    left = left.select(*[F.col(f"`{c}`") for c in df.columns], piece.alias("_piece"))
    copies = F.sequence(F.lit(0).cast("bigint"), (F.coalesce("_pieces", F.lit(1)) - 1).cast("bigint"))
    right = dim.withColumn("_hash", _key_hash(names, kinds)).join(heavy, "_hash", "left")
    right = right.select(*[F.col(f"`{c}`") for c in dim.columns], F.explode(copies).alias("_piece"))
    return left.join(right, [*names, "_piece"], how).drop("_piece")


def _meet(df: DataFrame, dim: DataFrame, key: Key, how: str) -> DataFrame:
    """A plain join with a dimension of few rows, else one that splits heavy keys."""
    if at_most(dim, LOCAL_ROWS):
        return df.join(dim, _names(key), how)
    return join_spread(df, dim, key, how)


def enrich(df: DataFrame, *dims: tuple[DataFrame, Key, Sequence[str]]) -> DataFrame:
    """Left join each (dimension, key, columns) in turn."""
    for dim, key, cols in dims:
        df = _meet(df, dim.select(*_names(key), *cols), key, "left")
    return df


def attach_label(df: DataFrame, labels: DataFrame, key: Key, label: str = "text_label") -> DataFrame:
    """Keep the rows that have a label and add it as an int."""
    labels = labels.select(*_names(key), F.col(label).try_cast("int").alias(label))
    return _meet(df, labels, key, "inner")


def join_predictions(base: DataFrame, predictions: DataFrame, key: Key) -> DataFrame:
    """Every prediction, with base columns where the key is known."""
    names = _names(key)
    joined = _meet(predictions, base, names, "left")
    # names may clash, so columns are put in order by place: key, base, predictions
    n_own, numbered = len(predictions.columns), [f"_{i}" for i in range(len(joined.columns))]
    order = [*range(len(names)), *range(n_own, len(numbered)), *range(len(names), n_own)]
    moved = joined.toDF(*numbered).select(*[numbered[i] for i in order])
    return moved.toDF(*[joined.columns[i] for i in order])


def assemble_star(fact: DataFrame, *dims: tuple[DataFrame, Key]) -> DataFrame:
    """Inner join of a fact table with its dimensions."""
    for dim, key in dims:
        fact = _meet(fact, dim, key, "inner")
    return fact


def join_ranked(
    df: DataFrame, ranked: DataFrame, key: str, idx: str, limit: int
) -> DataFrame:
    """Left join to a table (key, idx) whose idx count its keys from the most
    frequent one, such as a vocabulary or a dictionary.

    A table of at most limit entries is broadcast. Of a larger one the first
    limit entries are broadcast and the rest joins by shuffle; rows already
    matched are spread there by row hash under keys that match nothing, so no
    frequent key meets in one task.
    """
    held, small = localize(ranked, min(limit, LOCAL_ROWS))
    if small:
        return df.join(F.broadcast(held), key, "left")
    head = ranked.where(F.col(idx) <= limit)
    if not ranked.where(F.col(idx) > limit).take(1):
        return df.join(F.broadcast(head), key, "left")
    head = head.select(F.col(key).alias("_hk"), F.col(idx).alias("_hi"))
    tail = ranked.where(F.col(idx) > limit).select(
        F.col(key).alias("_tk"), F.col(idx).alias("_ti"), F.lit(0).alias("_tm")
    )
    met = df.join(F.broadcast(head), F.col(key) == F.col("_hk"), "left")
    done = F.col("_hi").isNotNull() | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 20)) + 1
    probed = met.withColumn("_spread", F.when(done, spread).otherwise(F.lit(0)))
    return (
        probed.join(
            tail, (F.col(key) == F.col("_tk")) & (F.col("_spread") == F.col("_tm")), "left"
        )
        .withColumn(idx, F.coalesce("_hi", "_ti"))
        .drop("_hk", "_hi", "_tk", "_ti", "_tm", "_spread")
    )


def exclude(df: DataFrame, known: DataFrame, key: Key) -> DataFrame:
    """Rows of df whose key is not among the known ones; a null key is kept."""
    names = _names(key)
    once = known.select(*names).distinct()
    if at_most(known, LOCAL_ROWS):
        return df.join(once, names, "left_anti")
    return join_spread(df, once, names, "left_anti")


def dedup(df: DataFrame, keys: Key, order_by: Key = (), keep: str = "first") -> DataFrame:
    """One row per key: the first or last by order_by, then by all columns.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key with very many copies costs no more than another.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    names = _names(keys)
    order = _names(order_by)
    rest = [c for c in df.columns if c not in names and c not in order]
    row = F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])
    if not order and not rest:
        return df.distinct()
    pick = F.min(row) if keep == "first" else F.max(row)
    picked = df.groupBy(*names).agg(pick.alias("_row"))
    held = {c: F.col(f"`{c}`") if c in names else F.col(f"_row.`{c}`") for c in df.columns}
    return picked.select(*[col.alias(c) for c, col in held.items()])


def build_population(
    base: DataFrame, positives: DataFrame, negatives: DataFrame, key: str, order_by: Key = ()
) -> DataFrame:
    """Labelled population: known positives are 1, candidate negatives that
    are not positives are 2, joined to the base table, one row per key.

    The labelled keys are distinct before the join, so copies cannot multiply.
    """
    known = positives.select(key).distinct()
    other = exclude(negatives.select(key).distinct(), known, key)
    labelled = known.withColumn("label", F.lit(1)).unionByName(other.withColumn("label", F.lit(2)))
    return dedup(base.join(labelled, key, "inner"), key, order_by)
