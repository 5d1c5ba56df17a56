"""Words of unsegmented text, found by how they hold together and what stands beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.session import materialize

HAN_RUNS = r"\p{IsHan}+"


def gram_counts(df: DataFrame, col: str, longest: int) -> DataFrame:
    """(word, left, right, n): the n-grams of up to `longest` signs of all Han runs with the
    signs beside them ('' at an end of the run). Counted inside each task first."""
    runs = df.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(HAN_RUNS), F.lit(0))).alias("_run"))
    run, size = F.col("_run"), F.length("_run")

    def at(i: Column) -> Column:
        left = F.when(i > 1, F.substring(run, i - 1, F.lit(1))).otherwise("")
        sizes = F.sequence(F.lit(1), F.least(F.lit(longest), size - i + 1))
        return F.transform(
            sizes,
            lambda s: F.struct(
                F.substring(run, i, s).alias("word"), left.alias("left"), F.substring(run, i + s, F.lit(1)).alias("right")
            ),
        )

    # one sign after the other, so that a long run is not held with all its n-grams
    places = runs.select("_run", F.explode(F.sequence(F.lit(1), size)).alias("_i"))
    grams = places.select(F.explode(at(F.col("_i"))).alias("g")).select("g.*")
    return grams.groupBy("word", "left", "right").agg(F.count(F.lit(1)).alias("n"))


def _entropy(counts: DataFrame, side: str) -> DataFrame:
    """(word, entropy of the signs on a side)."""
    beside = counts.groupBy("word", side).agg(F.sum("n").alias("c"))
    c = F.col("c").cast("double")
    spread = F.log(F.sum(c)) - F.sum(c * F.log(c)) / F.sum(c)
    return beside.groupBy("word").agg(spread.alias(f"{side}_entropy"))


def discover_words(
    df: DataFrame,
    col: str,
    longest: int = 4,
    least: int = 5,
    cohesion: float = 1.0,
    entropy: float = 0.5,
) -> DataFrame:
    """(word, n, cohesion, left_entropy, right_entropy) of the n-grams that are words: they
    occur `least` times, the parts of no cut are found together as rarely as by chance
    (the least pointwise mutual information of a cut is at least `cohesion`), and what
    stands on either side varies (`entropy`, in nats)."""
    counts = materialize(gram_counts(df, col, longest), "grams")
    words = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    signs = words.where(F.length("word") == 1).agg(F.sum("n").alias("total")).first()["total"] or 0
    many = words.where((F.length("word") > 1) & (F.col("n") >= least))
    cuts = many.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("k"))
    cuts = cuts.select(
        "word", "n", F.substring(F.col("word"), F.lit(1), F.col("k")).alias("head"),
        F.substring(F.col("word"), F.col("k") + 1, F.length("word")).alias("tail"),
    )
    for part in ("head", "tail"):
        own = words.select(F.col("word").alias(part), F.col("n").cast("double").alias(f"n_{part}"))
        cuts = cuts.join(own, part)
    mutual = F.log(F.col("n") * F.lit(float(signs)) / (F.col("n_head") * F.col("n_tail")))
    held = cuts.groupBy("word").agg(F.max("n").alias("n"), F.min(mutual).alias("cohesion"))
    held = held.where(F.col("cohesion") >= cohesion)
    kept = counts.join(held.select("word"), "word", "left_semi")
    for side in ("left", "right"):
        held = held.join(_entropy(kept, side), "word").where(F.col(f"{side}_entropy") >= entropy)
    return held.select("word", "n", "cohesion", "left_entropy", "right_entropy")
