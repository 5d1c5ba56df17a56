"""Queries over cleaning and encoding expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.catalog.base import Query, derive, sql_case, sql_steps, tables
from marlspike.functions import presets as P
from marlspike.functions import scalar as S
from marlspike.functions.hashing import hash_cross
from marlspike.operators.clean import apply_rules
from marlspike.operators.profile import class_distribution

PRIORITIES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "MACHINERY": 4}
TYPES = {"ECONOMY": 3, "LARGE": 1, "MEDIUM": 4, "PROMO": 2, "SMALL": 6, "STANDARD": 5}
EVENTS = ["click", "view", "purchase"]


def bucket_distribution(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    coded = orders.select(
        P.sales_level(F.col("o_totalprice").cast("int")).alias("price_level"),
        S.encode_dict("o_orderpriority", PRIORITIES).alias("priority_code"),
    )
    return coded.groupBy("price_level", "priority_code").agg(F.count(F.lit(1)).alias("n"))


def class_counts(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    return class_distribution(orders, "o_orderstatus")


# Customer fields as messy text: null, blank, wide blank, junk fragment, junk, number.
MESSY = """
SELECT c_custkey,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN '　'
    WHEN 4 THEN chr(92) || '&quot;' || CAST(c_custkey AS STRING) WHEN 5 THEN 'n/a'
    ELSE CAST(c_custkey AS STRING) END AS raw,
  CAST(c_custkey % 3 AS INT) AS grade, c_mktsegment
FROM customer
"""


def blank_clean(spark: SparkSession, d: str) -> DataFrame:
    messy = derive(spark, d, MESSY, "customer")
    rules = {
        "number_text": S.blank_to("raw", "0"),
        "plain_text": S.blank_to("raw", ""),
        "score": S.clean_int(S.blank_to("raw", "0")),
        "cast_int": S.safe_cast("raw", "int"),
        "label": S.remap("grade", {0: 3}),
        "source": F.lit("customer"),
    }
    return apply_rules(messy, rules).drop("raw", "grade")


BLANK_SQL = r"'^[\s\p{Z}]*$'"
BLANK_CLEAN = f"""
WITH m AS ({MESSY})
SELECT c_custkey, c_mktsegment,
  CASE WHEN raw IS NULL OR regexp_matches(raw, {BLANK_SQL}) THEN '0' ELSE raw END AS number_text,
  CASE WHEN raw IS NULL OR regexp_matches(raw, {BLANK_SQL}) THEN '' ELSE raw END AS plain_text,
  coalesce(try_cast(replace(CASE WHEN raw IS NULL OR regexp_matches(raw, {BLANK_SQL}) THEN '0'
    ELSE raw END, chr(92) || '&quot;', '') AS INT), 0) AS score,
  try_cast(raw AS INT) AS cast_int,
  CASE grade WHEN 0 THEN 3 ELSE grade END AS label,
  'customer' AS source
FROM m
"""


def money_level(spark: SparkSession, d: str) -> DataFrame:
    orders, documents = tables(spark, d, "orders", "documents")
    amounts = orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.round(F.col("o_totalprice") / 10).cast("int").cast("string"), F.lit("万元")).alias("t"),
    ).unionByName(
        documents.select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("t")
        )
    )
    return amounts.select(
        "id",
        P.money_level("t").alias("level"),
        P.money_level("t", P.MONEY_PATTERN_REPAIRED).alias("level_repaired"),
    )


def _money_sql(pattern: str) -> str:
    number = f"try_cast(regexp_extract(t, '{pattern}') AS DOUBLE)"
    whole = f"trunc({number})"
    return sql_steps(whole, P.MONEY_EDGES, P.MONEY_CODES, "<=")


MONEY_LEVEL = f"""
WITH a AS (
  SELECT 'o' || o_orderkey::VARCHAR AS id,
    round(o_totalprice / 10)::INT::VARCHAR || '万元' AS t FROM orders
  UNION ALL SELECT 'd' || doc_id::VARCHAR, text FROM documents)
SELECT id, {_money_sql(P.MONEY_PATTERN)} AS level,
  {_money_sql(P.MONEY_PATTERN_REPAIRED)} AS level_repaired
FROM a
"""


def date_bucket(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    # Move the order years back and forth so that every period occurs.
    year = F.year("o_orderdate") + F.pmod(F.col("o_orderkey"), F.lit(27)).cast("int")
    text = F.concat(F.lit("on "), year.cast("string"), F.date_format("o_orderdate", "-MM-dd"), F.lit("!"))
    dated = orders.select("o_orderkey", text.alias("t"))
    return dated.select(
        "o_orderkey",
        P.registered_time("t").alias("registered"),
        P.registered_time("t", "yyyymmdd").alias("registered_number"),
        P.audit_time("t").alias("audit"),
        P.audit_time("t", "yyyymmdd").alias("audit_number"),
    )


DATE_BUCKET = f"""
WITH a AS (
  SELECT o_orderkey, (year(o_orderdate) + o_orderkey % 27)::INT AS y,
    strftime(o_orderdate, '%m%d') AS md FROM orders),
b AS (SELECT o_orderkey, y, (y::VARCHAR || md)::INT AS ymd FROM a)
SELECT o_orderkey,
  {sql_steps("y", P.REGISTERED_EDGES, P.REGISTERED_CODES)} AS registered,
  {sql_steps("ymd", P.REGISTERED_EDGES, P.REGISTERED_CODES)} AS registered_number,
  {sql_steps("y", P.AUDIT_EDGES, P.AUDIT_CODES)} AS audit,
  {sql_steps("ymd", [2015, 2016, 2017, 2018], [1, 2, 3, 4, 7])} AS audit_number
FROM b
"""


def dict_encode(spark: SparkSession, d: str) -> DataFrame:
    part, customer = tables(spark, d, "part", "customer")
    left = part.select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("key"),
        S.encode_dict("p_type", TYPES).alias("code"),
    )
    right = customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"),
        S.encode_dict("c_mktsegment", SEGMENTS).alias("code"),
    )
    return left.unionByName(right)


DICT_ENCODE = f"""
SELECT 'part' AS kind, p_partkey AS key, {sql_case("p_type", TYPES)} AS code FROM part
UNION ALL
SELECT 'customer', c_custkey, {sql_case("c_mktsegment", SEGMENTS)} FROM customer
"""


def count_code(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    ok = F.count(F.when(F.col("l_returnflag") == "R", 1))
    pairs = lineitem.groupBy("l_orderkey").agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), ok.cast("string")).alias("codes")
    )
    # A few pairs are broken on purpose: one number, blank, more ok than total.
    odd = F.pmod(F.col("l_orderkey"), F.lit(11))
    codes = (
        F.when(odd == 0, F.lit("7")).when(odd == 1, F.lit(" ")).when(odd == 2, F.lit("2-4"))
        .otherwise(F.col("codes"))
    )
    return pairs.select(
        "l_orderkey",
        P.sites_ok(codes).alias("ok_code"),
        P.sites_failed(codes).alias("failed_code"),
    )


def _count_sql(value: str) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN 0 WHEN {value} < 0 THEN 7 "
        f"WHEN {value} >= 5 THEN 6 ELSE {value} + 1 END::INT"
    )


COUNT_CODE = f"""
WITH p AS (SELECT l_orderkey, count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS ok
  FROM lineitem GROUP BY 1),
q AS (SELECT l_orderkey,
  CASE l_orderkey % 11 WHEN 0 THEN 7 WHEN 1 THEN NULL WHEN 2 THEN 2 ELSE total END AS a,
  CASE l_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 4 ELSE ok END AS b FROM p)
SELECT l_orderkey, {_count_sql("b")} AS ok_code, {_count_sql("(a - b)")} AS failed_code FROM q
"""


def range_codes(spark: SparkSession, d: str) -> DataFrame:
    (part,) = tables(spark, d, "part")
    return part.select(
        "p_partkey",
        P.member_years("p_size").alias("years"),
        P.medal("p_size").alias("medal"),
        P.sales_level((F.col("p_retailprice") * F.col("p_size")).cast("int").cast("string")).alias("sales"),
    )


RANGE_CODES = f"""
SELECT p_partkey,
  CASE WHEN p_size BETWEEN 1 AND 9 THEN p_size WHEN p_size BETWEEN 10 AND 13 THEN 10
    WHEN p_size BETWEEN 14 AND 16 THEN 11 WHEN p_size > 16 THEN 12 ELSE 0 END AS years,
  CASE WHEN p_size BETWEEN 1 AND 5 THEN p_size ELSE 0 END AS medal,
  {sql_steps("trunc(p_retailprice * p_size)", P.SALES_EDGES, P.SALES_CODES, "<", "NULL")} AS sales
FROM part
"""


def crossed(spark: SparkSession, d: str) -> DataFrame:
    (part,) = tables(spark, d, "part")
    return part.select("p_partkey", hash_cross(["p_brand", "p_size"], 100).alias("bucket"))


HASH_CROSS = """
WITH h AS (
  SELECT p_partkey, list_reduce(
    list_transform(string_split(p_brand || '_' || p_size::VARCHAR, ''), lambda c: unicode(c)::BIGINT),
    lambda a, c: (a * 31 + c) & 4294967295) AS u FROM part),
s AS (SELECT p_partkey, CASE WHEN u > 2147483647 THEN u - 4294967296 ELSE u END AS h FROM h)
SELECT p_partkey, (((h % 100) + 100) % 100)::INT AS bucket FROM s
"""


def vocab_position(spark: SparkSession, d: str) -> DataFrame:
    (events,) = tables(spark, d, "events")
    return events.select("event_id", S.vocab_index("event_type", EVENTS).alias("idx"))


VOCAB_INDEX = f"""
SELECT event_id, coalesce(list_position({EVENTS}, event_type), 0)::INT AS idx FROM events
"""


def merged_text(spark: SparkSession, d: str) -> DataFrame:
    (part,) = tables(spark, d, "part")
    odd = F.pmod(F.col("p_partkey"), F.lit(5))
    held = part.withColumn("p_type", F.when(odd == 0, None).when(odd == 1, " ").otherwise(F.col("p_type")))
    cols = [c for c in ("p_name", "p_type", "p_brand")]
    lines = F.concat(F.col("p_name"), F.lit("\r\n"), F.col("p_brand"))
    return held.select(
        "p_partkey",
        S.merge_text(cols).alias("joined"),
        S.merge_text(cols, keep_blanks=False).alias("folded"),
        S.strip_newlines(lines).alias("one_line"),
    )


MERGE_TEXT = """
WITH h AS (SELECT p_partkey, p_name, p_brand,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE p_type END AS p_type FROM part)
SELECT p_partkey,
  p_name || ',' || CASE WHEN p_type IS NULL OR p_type = ' ' THEN '' ELSE p_type END || ',' || p_brand AS joined,
  concat_ws(',', p_brand, p_type, p_name, '') AS folded,
  p_name || p_brand AS one_line
FROM h
"""


def unpacked(spark: SparkSession, d: str) -> DataFrame:
    (part,) = tables(spark, d, "part")
    words = part.withColumn("words", F.split("p_name", " "))
    return words.select(
        "p_partkey", *[c.alias(n) for n, c in S.unpack_array("words", 3, "word").items()]
    )


UNPACK = """
SELECT p_partkey, w[1] AS word0, w[2] AS word1, w[3] AS word2
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
"""

QUERIES = {
    "q_bucket_distribution": Query(
        bucket_distribution,
        f"""SELECT {sql_steps("trunc(o_totalprice)", P.SALES_EDGES, P.SALES_CODES)} AS price_level,
        {sql_case("o_orderpriority", PRIORITIES)} AS priority_code, count(*) AS n
        FROM orders GROUP BY 1, 2""",
    ),
    "q_class_distribution": Query(
        class_counts, "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY 1"
    ),
    "q_blank_clean": Query(blank_clean, BLANK_CLEAN),
    "q_money_level": Query(money_level, MONEY_LEVEL),
    "q_date_bucket": Query(date_bucket, DATE_BUCKET),
    "q_dict_encode": Query(dict_encode, DICT_ENCODE),
    "q_count_code": Query(count_code, COUNT_CODE),
    "q_range_codes": Query(range_codes, RANGE_CODES),
    "q_hash_cross": Query(crossed, HASH_CROSS),
    "q_vocab_index": Query(vocab_position, VOCAB_INDEX),
    "q_merge_text": Query(merged_text, MERGE_TEXT),
    "q_unpack_array": Query(unpacked, UNPACK),
}
