"""Exact deduplication by skew-safe combining.

Equal texts are merged in three steps, each of which compares whole texts and
not digests alone:

1. local: the map side of the first aggregation merges equal texts of a task;
2. salted: what the tasks found is merged per (digest, salt, text), the salt
   coming from the task, so a text that every task holds goes to `salts` tasks;
3. global: the at most `salts` winners of a text are merged per (digest, text).

The result has one narrow row per digest. Each document finds its class by its
digest; where one digest turns out to stand for several texts, those documents
find theirs by (digest, text) instead.

Defined results: a table without rows gives no rows; a null text counts as empty, and empty texts are equal. Rows
that share an id and a text are counted each and kept or dropped together. A
null id is kept only if no equal text has an id. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import ascii_lower
from marlspike.session import materialize

SALTS = 32


def sha256(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def keyed(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    body = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).alias("doc"), body.alias("body"))
    return rows.withColumn("digest", digest(F.col("body")))


def winners(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, body, keep, size) for each distinct text of rows."""
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("digest", "salt", "body").agg(
        F.max("doc").alias("keep"), F.count(F.lit(1)).alias("size")
    )
    return merged.groupBy("digest", "body").agg(
        F.max("keep").alias("keep"), F.sum("size").alias("size")
    )


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(doc, digest, keep, size) for each row of docs: the class of its text."""
    rows = keyed(docs, key, text, digest)
    found = materialize(
        winners(rows, salts)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep").alias("keep"),
            F.max("size").alias("size"),
        ),
        "exact",
    )
    single = found.filter("texts = 1").select("digest", "keep", "size")
    out = rows.select("doc", "digest").join(single, "digest")
    shared = found.filter("texts > 1").select("digest")
    if not shared.isEmpty():
        unclear = rows.join(shared, "digest", "left_semi")
        exact = unclear.join(winners(unclear, salts), ["digest", "body"])
        out = out.unionByName(exact.select("doc", "digest", "keep", "size"))
    return out.select("doc", "digest", "keep", "size")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS
) -> DataFrame:
    """docs, all columns, without the rows whose text a kept row has too."""
    rows = keyed(docs, key, text, sha256)
    kept = winners(rows, salts).select(F.col("keep"), F.col("digest").alias("sha"))
    own = sha256(ascii_lower(F.coalesce(docs[text], F.lit(""))))
    same = docs[key].eqNullSafe(kept["keep"]) & (own == kept["sha"])
    return docs.join(kept, same, "left_semi")


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = classes(docs)
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = """
WITH d AS (
  SELECT doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""

QUERIES = {"op10_exact_dedup": (op10_exact_dedup, SQL)}
