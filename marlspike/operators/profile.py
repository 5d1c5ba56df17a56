"""Counts, cardinalities and frequency dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.operators.ids import number_rows
from marlspike.operators.relate import join_ranked
from marlspike.session import materialize

# Sketches of 2^14 registers: 16 KiB a column and group, standard error 0.8 %.
SKETCH_BITS = 14
# Dictionary entries joined by broadcast; the rarer rest joins by shuffle.
SMALL_DICTIONARY = 100_000


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def profile_cardinality(
    df: DataFrame, id_col: str, cols: Sequence[str], approx: bool = False
) -> DataFrame:
    """One row: count of id_col and the distinct count of each column.

    approx=True uses sketches: one small state per column instead of a
    shuffle of all distinct values.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(
        F.count(id_col).alias(id_col),
        *[distinct(F.col(c)).alias(c) for c in cols],
    )


def embedding_dims(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the largest id of each column."""
    return df.agg(*[F.max(c).alias(c) for c in cols])


def profile_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, name, n, largest, sketch): what is worth saving of each column's rows.

    n counts the values that are not null, largest is the largest of a column of whole
    numbers (else null), sketch stands for the distinct values. One pass with partial
    aggregation. Save the states of a day once; unite_states answers for any set of days
    without reading their rows again. The empty text is a value.
    """
    whole = ("tinyint", "smallint", "int", "bigint")
    kinds = dict(df.dtypes)
    states = []
    for c in cols:
        value = F.col(f"`{c}`")
        hashed = F.when(value.isNotNull(), F.xxhash64(value))
        largest = F.max(value).cast("bigint") if kinds[c] in whole else F.lit(None).cast("bigint")
        states.append(
            F.struct(
                F.lit(c).alias("name"),
                F.count(value).alias("n"),
                largest.alias("largest"),
                F.hll_sketch_agg(hashed, SKETCH_BITS).alias("sketch"),
            )
        )
    grouped = df.groupBy(*by).agg(F.array(*states).alias("_states"))
    return grouped.select(*by, F.explode("_states").alias("_s")).select(*by, "_s.*")


def unite_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of larger groups, or of several saved tables put together."""
    return states.groupBy(*by, "name").agg(
        F.sum("n").alias("n"),
        F.max("largest").alias("largest"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def read_states(states: DataFrame, sigmas: float = 4.0) -> DataFrame:
    """States with n_distinct, and the bounds at_least and at_most around it, in place of
    the sketch. The standard error of 2^b registers is at most 1.04 / sqrt(2^b)."""
    error = sigmas * 1.04 / (1 << SKETCH_BITS) ** 0.5
    found = states.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
    return found.withColumns(
        {
            "at_least": F.floor(F.col("n_distinct") / (1 + error)),
            "at_most": F.ceil(F.col("n_distinct") / (1 - error)),
        }
    )


def fit_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, count, idx): index from 1 by falling count, ties by value.

    Null is not indexed: 0 stands for null and for unseen values. The result is a table: save it and apply the same
    one when scoring.
    """
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return number_rows(counts, [F.desc("count"), F.asc("value")], "idx")


def extend_dictionary(saved: DataFrame | None, df: DataFrame, col: str, since: int) -> DataFrame:
    """(value, count, idx, since): a saved dictionary with the values of new rows.

    Counts are summed. A saved value keeps its idx, whatever its count is now; a new one
    gets the next after the largest, by falling count in the new rows, ties by value. So
    rows that were coded with the saved dictionary stay right, and old rows are not read
    again. since is the number of the batch that brought a value; without a saved
    dictionary this is fit_dictionary. Null is not indexed.
    """
    if saved is None:
        return fit_dictionary(df, col).withColumn("since", F.lit(since))
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("_new"))
    )
    merged = materialize(saved.join(counts, "value", "full"), "dictionary")
    total = F.col("count") + F.coalesce("_new", F.lit(0))
    known = merged.where(F.col("idx").isNotNull()).select("value", total.alias("count"), "idx", "since")
    unseen = merged.where(F.col("idx").isNull()).select("value", F.col("_new").alias("count"))
    fresh = number_rows(unseen, [F.desc("count"), F.asc("value")], "idx")
    following = (F.col("idx") + (dictionary_size(saved) - 1)).alias("idx")
    return known.unionByName(fresh.select("value", "count", following, F.lit(since).alias("since")))


def dictionary_size(dictionary: DataFrame) -> int:
    """The number of codes of a fitted dictionary, 0 included."""
    return int(dictionary.agg(F.coalesce(F.max("idx"), F.lit(0)) + 1).first()[0])


def apply_dictionary(
    df: DataFrame, dictionary: DataFrame, col: str, out: str, unseen: int | Column = 0
) -> DataFrame:
    """Add the dictionary index of a column. A value outside the dictionary,
    null too, gets unseen."""
    lookup = dictionary.select(F.col("value").alias(col), F.col("idx").alias("_idx"))
    unseen = unseen if isinstance(unseen, Column) else F.lit(unseen)
    joined = join_ranked(df, lookup, col, "_idx", SMALL_DICTIONARY)
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    return joined.select(*kept, F.coalesce("_idx", unseen).cast("bigint").alias(out))
