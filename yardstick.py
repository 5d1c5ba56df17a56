"""Literal forms of a naive plan next to the forms of this package.

The naive form numbers rows in one task, collects lists and vocabularies to
the driver and runs row lambdas in Python. Both forms are timed on the same
tables (BENCH_SF_DIR) with the same cores, best of two runs.
"""

from __future__ import annotations

import os
import re
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.catalog.texts import _documents
from marlspike.functions import presets as P
from marlspike.functions.hashing import hash_cross
from marlspike.operators import ids, relate, text
from marlspike.session import build_session
from marlspike.sources.readers import load_table


def pairs(spark: SparkSession, d: str) -> dict[str, tuple]:
    orders = load_table(spark, d, "orders")
    lineitem = load_table(spark, d, "lineitem")
    documents = _documents(spark, d)
    known = orders.where(F.col("o_totalprice") > 400000).select("o_custkey")
    amounts = lineitem.select(
        F.concat(F.col("l_extendedprice").cast("string"), F.lit("万元")).alias("t"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"), "l_partkey", "l_suppkey",
    )

    def ids_naive() -> DataFrame:
        one = Window.partitionBy("zero").orderBy(F.desc("l_orderkey"), "l_partkey", "l_suppkey")
        return lineitem.withColumn("zero", F.lit(0)).withColumn("id", F.row_number().over(one))

    def ids_ours() -> DataFrame:
        return ids.assign_ids(lineitem, ["l_orderkey", "l_partkey", "l_suppkey"], desc=True)

    def exclude_naive() -> DataFrame:
        listed = [r[0] for r in known.distinct().collect()]
        absent = F.udf(lambda k: all(k != other for other in listed), "boolean")
        return orders.where(absent("o_custkey"))

    def exclude_ours() -> DataFrame:
        return relate.exclude(orders, known, "o_custkey")

    def money(t: str) -> int:
        found = re.search(r"\d+\.?\d+", t or "")
        if not found:
            return 0
        v = int(float(found.group()))
        for edge, code in zip(P.MONEY_EDGES, P.MONEY_CODES):
            if v <= edge:
                return code
        return P.MONEY_CODES[-1]

    def year(t: str) -> int:
        v = int(t[:4])
        return next((c for e, c in zip(P.REGISTERED_EDGES, P.REGISTERED_CODES) if v < e), 9)

    def encode_naive() -> DataFrame:
        return amounts.select(F.udf(money, "int")("t").alias("m"), F.udf(year, "int")("d").alias("y"))

    def encode_ours() -> DataFrame:
        return amounts.select(P.money_level("t").alias("m"), P.registered_time("d").alias("y"))

    def cross_naive() -> DataFrame:
        def fold(a: int, b: int) -> int:
            h = 0
            for ch in f"{a}_{b}":
                h = (h * 31 + ord(ch)) & 0xFFFFFFFF
            return (h - (1 << 32) if h >= 1 << 31 else h) % 100

        return amounts.select(F.udf(fold, "int")("l_partkey", "l_suppkey").alias("x"))

    def cross_ours() -> DataFrame:
        return amounts.select(hash_cross(["l_partkey", "l_suppkey"], 100).alias("x"))

    gap = re.compile(r"[\W_]+")

    def wide_naive() -> DataFrame:
        split = F.udf(lambda t: [w for w in gap.split(t.lower()) if w], "array<string>")
        cut = documents.select("doc_id", split("text").alias("tokens"))
        words = [r[0] for r in cut.select(F.explode("tokens")).distinct().collect()]
        held = spark.sparkContext.broadcast({w: i + 1 for i, w in enumerate(words)})
        first = F.udf(lambda ws: [held.value.get(w, 0) for w in ws[:40]] + [0] * (40 - len(ws)), "array<int>")
        coded = cut.select("doc_id", first("tokens").alias("a"))
        return coded.select("doc_id", *[F.get("a", F.lit(i)).alias(f"wide{i}") for i in range(40)])

    def wide_ours() -> DataFrame:
        cut = text.tokenize(documents, "text").select("doc_id", "tokens")
        return text.tokens_to_wide(cut, "doc_id", "tokens", text.build_vocab(cut, "tokens"), 40)

    return {
        "ids over lineitem": (ids_naive, ids_ours),
        "exclude known keys": (exclude_naive, exclude_ours),
        "encode money and date": (encode_naive, encode_ours),
        "hash cross": (cross_naive, cross_ours),
        "40 token columns": (wide_naive, wide_ours),
    }


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "yardstick", master=f"local[{cpus}]", spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="8g", spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, forms in pairs(spark, directory).items():
        best = []
        for form in forms:
            took = []
            for _ in range(2):
                start = time.perf_counter()
                form().write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - start)
            best.append(min(took))
        print(f"{name:24}{best[0]:8.2f}{best[1]:8.2f}", flush=True)


if __name__ == "__main__":
    main()
