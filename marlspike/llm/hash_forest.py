"""Nearest neighbours by inner product with a hash-prefix forest.

Vectors are dealt out in blocks of about BLOCK rows by a hash of their id, queries
in blocks of TEAM, and every block of queries meets every block of vectors. A
block of vectors has a forest of its own: TREES sorted arrays of hash strings of
DEPTH bits, each bit the side of a random plane. A vector is lengthened by one
component that gives all the same norm, so that planes order them by inner product.

A query descends in every tree to its longest matching prefixes and then ascends in
all trees at the same time, one bit a step: each step widens its range in the sorted
arrays, until the ranges hold REACH times as many entries as the block has rows (an
entry counts in each tree). All rows of those ranges are scored in double precision
on the original vectors. All rows are indexed; nothing is fitted to the data but the
largest norm. REACH and TREES are set for a recall of at least 0.9 on vectors
without any clusters, the hardest case; clustered data need a smaller REACH.

Equal vectors are indexed once and stand for their smallest ids, so a vector that
many rows share makes no large group, and ties go to smaller ids.

Defined results: a table without rows gives no rows; vectors that are null, of a length other than the most frequent,
zero, or hold a null or non-finite component take no part; nor do rows without an
id. An id on several rows counts once, with the smallest of its vectors. Further
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.session import materialize

BLOCK, TEAM = 8192, 2048
TREES, DEPTH = 128, 20
REACH = 0.42


def planes(width: int) -> np.ndarray:
    """The normals of all trees' planes, for vectors of width components and one more."""
    return np.random.default_rng(1009).standard_normal((width + 1, TREES * DEPTH)).astype(np.float32)


def hash_strings(lengthened: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """The hash string of each row (second axis) in each tree (first axis), as a number."""
    sides = (lengthened.astype(np.float32) @ normals > 0).reshape(len(lengthened), TREES, DEPTH)
    return (sides @ (1 << np.arange(DEPTH - 1, -1, -1, dtype=np.int64))).T


class Forest:
    """Sorted hash strings of a block of vectors."""

    def __init__(self, vectors: np.ndarray, largest: float):
        self.vectors = vectors
        self.normals = planes(vectors.shape[1])
        rest = np.sqrt(np.maximum(largest - (vectors**2).sum(axis=1), 0))
        strings = hash_strings(np.column_stack([vectors, rest]), self.normals)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, queries: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of each query in each tree, after the ascent."""
        own = hash_strings(np.column_stack([queries, np.zeros(len(queries))]), self.normals)
        first = np.zeros(own.shape, np.int64)
        end = np.full(own.shape, len(self.vectors))
        climbing = np.arange(len(queries))
        for depth in range(DEPTH, 0, -1):
            if not len(climbing):
                break
            rest = (1 << (DEPTH - depth)) - 1
            low, high = own[:, climbing] & ~rest, own[:, climbing] | rest
            a = np.stack([np.searchsorted(s, x) for s, x in zip(self.strings, low)])
            b = np.stack([np.searchsorted(s, x, side="right") for s, x in zip(self.strings, high)])
            done = (b - a).sum(axis=0) >= enough
            first[:, climbing[done]], end[:, climbing[done]] = a[:, done], b[:, done]
            climbing = climbing[~done]
        return first, end

    def rows_of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The distinct rows in a range of each tree."""
        seen = np.zeros(len(self.vectors), bool)
        for order, a, b in zip(self.order, first.tolist(), end.tolist()):
            seen[order[a:b]] = True
        return np.flatnonzero(seen)

    def search(self, queries: np.ndarray, keys: np.ndarray, most: int, reach: float):
        """(query, row, score) of the best `most` rows found for each query; keys: the
        rows' ids, which decide ties."""
        enough = max(most, math.ceil(reach * len(self.vectors)))
        first, end = self.ranges(queries, enough)
        exact = self.vectors.astype(np.float64)
        out = []
        for q, query in enumerate(queries.astype(np.float64)):
            rows, wider = self.rows_of(first[:, q], end[:, q]), enough
            while len(rows) < min(most, len(exact)):  # the same rows in every tree: ascend further
                wider *= 2
                a, b = self.ranges(queries[q : q + 1], wider)
                rows = self.rows_of(a[:, 0], b[:, 0])
            score = np.einsum("ij,j->i", exact[rows], query)
            if len(rows) > most:
                edge = np.partition(score, len(score) - most)[len(score) - most]
                keep = score >= edge
                rows, score = rows[keep], score[keep]
            best = np.lexsort((keys[rows], -score))[:most]
            out.append((np.full(len(best), q), rows[best], score[best]))
        return [np.concatenate(x) for x in zip(*out)]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad)
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.orderBy(F.desc("rows"), F.desc("n")).limit(1).collect()
    return rows.filter(F.size("vector") == (top[0].n if top else 0))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    reach: float = REACH,
    block: int = BLOCK,
    queries: int = TEAM,
) -> DataFrame:
    """(query, rank, id, score): the k nearest found of each row that is_query holds for,
    a condition on the column `id`."""
    rows = materialize(usable(vectors, key, vector).withColumn("asks", is_query), "vectors")
    by_id = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k + 1)
    asked = rows.groupBy("vector").agg(F.min("id").alias("class"), F.max("asks").alias("asked"))
    classes = materialize(asked, "distinct")
    members = few.join(classes.select("vector", "class"), "vector").select("class", "id")
    facts = classes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("asked").cast("int")).alias("asked"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("largest"),
    ).first()
    blocks = max(1, math.ceil(facts.rows / block))
    groups = max(1, math.ceil((facts.asked or 0) / queries))
    largest = facts.largest or 0.0

    def dealt(frame: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        frame = frame.select("class", "vector", F.pmod(F.xxhash64("class", F.lit(len(own))), F.lit(count)).cast("int").alias(own))
        return frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    held = dealt(classes, "part", blocks, "team", groups)
    asking = dealt(classes.filter("asked"), "team", groups, "part", blocks)

    def matrix(table):
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        return flat.reshape(table.num_rows, -1), table.column("class").to_numpy()

    def search(left, right):
        names = ["asker", "class", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        data, keys = matrix(left)
        asks, askers = matrix(right)
        q, row, score = Forest(data, largest).search(asks, keys, k + 1, reach)
        return pa.table([pa.array(askers[q]), pa.array(keys[row]), pa.array(score)], names)

    found = held.groupBy("part", "team").cogroup(asking.groupBy("part", "team"))
    found = found.applyInArrow(search, "asker long, class long, score double")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "class")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    ids = found.join(members, "class").select("asker", "id", "score")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "id")
    ids = ids.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")
    ids = materialize(ids, "nearest")
    askers = rows.filter("asks").join(classes.select("vector", F.col("class").alias("asker")), "vector")
    pairs = askers.select(F.col("id").alias("query"), "asker").join(ids, "asker").filter("id <> query")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query", "rank", "id", "score")
    )


def op5_hash_forest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("id") % 20 == 0).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )


QUERIES = {"op5_hash_forest": (op5_hash_forest, None)}
