"""Queries over predictions: parsing, ranking, measuring, publishing; and
round trips through the file formats."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.catalog.base import Query, derive, tables
from marlspike.operators import evaluate
from marlspike.plans import jobs
from marlspike.session import scratch_path
from marlspike.sources import parsers, readers, schemas, sinks

# One prediction per order. The rule stands for a model, so that SQL can follow.
SCORED = """
SELECT o_custkey AS user_id, o_orderkey AS item_id,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS label,
  CAST((o_orderkey * 7 + o_custkey) % 3 + 1 AS INT) AS prediction,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS probability
FROM orders
"""
# One prediction per customer and part that were ordered together.
PAIRS = """
SELECT o_custkey AS user_id, l_partkey AS item_id,
  CAST(least(count(*), 5) AS INT) AS prediction, sum(l_quantity) / 1000 AS probability
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey
"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, SCORED, "orders")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, PAIRS, "orders", "lineitem")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    fields = ("user_id", "item_id", "prediction", "probability")
    return _scored(spark, d).select(parsers.format_prediction_line(*fields).alias("value"))


def parse_predictions(spark: SparkSession, d: str) -> DataFrame:
    return parsers.parse_predictions(_lines(spark, d))


LINES_SQL = f"""(SELECT 'UserItemPrediction(' || concat_ws(',', user_id, item_id, prediction, probability)
  || ')' AS value FROM ({SCORED}))"""
_FIELD = r"'^UserItemPrediction\(([^,]*),([^,]*),([^,]*),([^)]*)\)$'"
PARSE_PREDICTIONS = f"""
SELECT regexp_extract(value, {_FIELD}, 1)::BIGINT AS user_id,
  regexp_extract(value, {_FIELD}, 2)::BIGINT AS item_id,
  regexp_extract(value, {_FIELD}, 3)::INT AS prediction,
  regexp_extract(value, {_FIELD}, 4)::DOUBLE AS probability
FROM {LINES_SQL}
"""


def parse_label_lines(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = tables(spark, d, "documents", "labels")
    name = F.concat(F.col("source"), F.lit(", "), F.col("lang"), F.lit(" ("), F.col("doc_id").cast("string"), F.lit(")"))
    lines = documents.join(labels, "doc_id").select(
        F.concat(
            F.lit("("), F.col("doc_id").cast("string"), F.lit(","), name, F.lit(")\t__label__"),
            F.col("quality").cast("string"), F.lit(" 0.9"),
        ).alias("value")
    )
    return parsers.parse_label_lines(lines)


PARSE_LABEL_LINES = """
SELECT source || ', ' || lang || ' (' || doc_id || ')' AS company_name, quality::VARCHAR AS text_label
FROM documents JOIN labels USING (doc_id)
"""


def merge_labels(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = tables(spark, d, "documents", "labels")
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    lines = labels.select(
        F.concat(
            F.lit("("), F.col("doc_id").cast("string"), F.lit(","), name, F.lit(") __label__"),
            (F.col("toxic") + 1).cast("string"),
        ).alias("value")
    )
    table = documents.select(name.alias("name"), "lang", "n_chars")
    train = table.where(F.col("lang") == "en")
    merged_train, merged_all = jobs.merge_text_labels(lines, "name", train, table)
    return merged_train.withColumn("part", F.lit("train")).unionByName(
        merged_all.withColumn("part", F.lit("all"))
    )


_MERGED = """SELECT 'doc ' || doc_id AS name, lang, n_chars, (toxic + 1)::INT AS text_label
  FROM documents JOIN labels USING (doc_id)"""
MERGE_LABELS = f"""
SELECT *, 'train' AS part FROM ({_MERGED}) WHERE lang = 'en' UNION ALL SELECT *, 'all' FROM ({_MERGED})
"""


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion_matrix(_scored(spark, d))


def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.accuracy(_scored(spark, d)).select(F.round("accuracy", 9).alias("accuracy"))


def f_threshold(spark: SparkSession, d: str) -> DataFrame:
    curve = evaluate.f_by_threshold(_scored(spark, d), "probability", F.col("label") == 1)
    return curve.select("threshold", F.round("f", 9).alias("f"))


def _f_sql(rows: str, score: str, positive: str) -> str:
    return f"""
    WITH s AS (SELECT {score} AS threshold, count(*) FILTER ({positive}) AS pos, count(*) AS n
      FROM ({rows}) WHERE {score} IS NOT NULL GROUP BY 1),
    c AS (SELECT threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS chosen, sum(pos) OVER () AS total
      FROM s WINDOW w AS (ORDER BY threshold DESC)),
    m AS (SELECT threshold, tp / chosen AS p, CASE WHEN total = 0 THEN 0 ELSE tp / total END AS r FROM c)
    SELECT threshold, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9)::DOUBLE AS f FROM m
    """


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Predictions joined back to labels, as a long report."""
    scored = _scored(spark, d)
    report = evaluate.evaluate(scored.drop("label"), scored.select("item_id", "label"), "item_id", positive=1)
    matrix = report["confusion"].select(
        F.concat_ws(" as ", "label", "prediction").alias("what"), F.col("count").cast("double").alias("value")
    )
    share = report["accuracy"].select(F.lit("accuracy").alias("what"), F.round("accuracy", 9).alias("value"))
    best = report["f_by_threshold"].agg(F.round(F.max("f"), 9).alias("value"))
    best = best.select(F.lit("best f").alias("what"), "value")
    return matrix.unionByName(share).unionByName(best)


_CLASS_1 = "(CASE WHEN prediction = 1 THEN probability ELSE 1 - probability END)"
EVALUATE = f"""
SELECT label || ' as ' || prediction AS what, count(*)::DOUBLE AS value FROM ({SCORED}) GROUP BY 1
UNION ALL SELECT 'accuracy', round(avg((label = prediction)::INT), 9) FROM ({SCORED})
UNION ALL SELECT 'best f', round(max(f), 9) FROM ({_f_sql(SCORED, _CLASS_1, "label = 1")})
"""


def disagreements(spark: SparkSession, d: str) -> DataFrame:
    sure = evaluate.confident(_scored(spark, d), 0.6)
    return evaluate.mine_disagreements(sure, 3, [1, 2])


DISAGREEMENTS = f"""
SELECT * FROM ({SCORED}) WHERE probability > 0.6 AND label = 3 AND prediction IN (1, 2)
"""


def recommend_user(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recommend(_pairs(spark, d), "user_id", 5)


def recommend_item(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recommend(_pairs(spark, d), "item_id", 5)


def recommend_one_user(spark: SparkSession, d: str) -> DataFrame:
    """All rows belong to one user, as in the company tasks."""
    one = _scored(spark, d).withColumn("user_id", F.lit(1).cast("bigint"))
    return evaluate.recommend(one, "user_id", 2000)


def _recommend_sql(by: str, tie: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by}
      ORDER BY prediction DESC, probability DESC, {tie})::INT AS rank FROM ({PAIRS})) WHERE rank <= 5"""


RECOMMEND_ONE = f"""
SELECT * FROM (SELECT 1::BIGINT AS user_id, item_id, label, prediction, probability,
  row_number() OVER (ORDER BY prediction DESC, probability DESC, item_id)::INT AS rank FROM ({SCORED}))
WHERE rank <= 2000
"""


def _published_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    (orders,) = tables(spark, d, "orders")
    name = F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("company_name")
    # some scored orders have ids without a prediction, some attributes names that none has
    low = F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    scored = orders.select(
        name, low.alias("id"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END").alias("label"),
    )
    cheap = F.when(F.col("o_totalprice") > 100000, "").otherwise("other ")
    attributes = orders.select(F.concat(cheap, name).alias("company_name"), "o_totalprice")
    return _lines(spark, d), scored, attributes


_SCORED_NAMES = """(SELECT 'order ' || o_orderkey AS company_name,
  CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS item_id,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS label FROM orders)"""
_ATTRIBUTES = """(SELECT CASE WHEN o_totalprice > 100000 THEN '' ELSE 'other ' END || 'order ' || o_orderkey AS company_name,
  o_totalprice FROM orders)"""


def publish_results(spark: SparkSession, d: str) -> DataFrame:
    """Written as one headed CSV folder and read back."""
    path = scratch_path(spark, "results")
    published = jobs.publish_results(*_published_inputs(spark, d))
    sinks.save(published, path, "csv", header="true")
    return spark.read.csv(path, header=True, schema=published.schema)


PUBLISH_RESULTS = f"""
SELECT p.company_name, o_totalprice, item_id, user_id, prediction, probability, p.label
FROM (SELECT item_id, user_id, prediction, probability, n.company_name, n.label
  FROM ({SCORED}) JOIN {_SCORED_NAMES} n USING (item_id)) p
LEFT JOIN {_ATTRIBUTES} a ON a.company_name = p.company_name
"""


def publish_disagreements(spark: SparkSession, d: str) -> DataFrame:
    return jobs.publish_disagreements(*_published_inputs(spark, d))


PUBLISH_DISAGREEMENTS = f"""
SELECT company_name, o_totalprice FROM {_ATTRIBUTES} JOIN {_SCORED_NAMES} USING (company_name)
JOIN (SELECT item_id, prediction, probability FROM ({SCORED})) USING (item_id)
WHERE probability > 0.6 AND label = 3 AND prediction IN (1, 2)
"""


def libsvm(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    vectors = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features")
    rows = vectors.transform(lineitem).select(flag.alias("label"), "features")
    path = scratch_path(spark, "libsvm")
    rows.write.format("libsvm").save(path)
    read = readers.read_libsvm(spark, path, 2).withColumn("v", vector_to_array("features"))
    return read.groupBy("label", F.get("v", F.lit(0)).alias("x0"), F.get("v", F.lit(1)).alias("x1")).agg(
        F.count(F.lit(1)).alias("n")
    )


LIBSVM = """
SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END::DOUBLE AS label,
  l_quantity AS x0, l_discount AS x1, count(*) AS n FROM lineitem GROUP BY 1, 2, 3
"""


def delimited(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    lines = lineitem.select(
        F.concat_ws("::", "l_orderkey", "l_partkey", "l_linenumber").alias("value")
    )
    path = scratch_path(spark, "ratings")
    sinks.save(lines, path, "text")
    return readers.read_delimited(spark, path, schemas.STAR_RATING)


DELIMITED = """
SELECT l_orderkey::INT AS "companyId", l_partkey::INT AS "tagId", l_linenumber AS label FROM lineitem
"""


def round_trips(spark: SparkSession, d: str) -> DataFrame:
    (customer,) = tables(spark, d, "customer")
    path = scratch_path(spark, "formats")
    sinks.save(customer, f"{path}/parquet", "parquet")
    sinks.save(customer, f"{path}/headed", "csv", files=1, header="true")
    sinks.save(customer, f"{path}/plain", "csv")
    sinks.save(customer.select("c_name"), f"{path}/lines", "text")
    held = [
        spark.read.parquet(f"{path}/parquet"),
        spark.read.csv(f"{path}/headed", header=True, schema=customer.schema),
        spark.read.csv(f"{path}/plain", schema=customer.schema),
        customer.join(readers.read_lines(spark, f"{path}/lines", "c_name"), "c_name"),
    ]
    kinds = ("parquet", "headed", "plain", "lines")
    named = [df.withColumn("kind", F.lit(kind)) for df, kind in zip(held, kinds)]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


ROUND_TRIPS = "SELECT customer.*, kind FROM customer, (SELECT unnest(['parquet', 'headed', 'plain', 'lines']) AS kind)"

QUERIES = {
    "q_parse_predictions": Query(parse_predictions, PARSE_PREDICTIONS),
    "q_parse_label_lines": Query(parse_label_lines, PARSE_LABEL_LINES),
    "q_merge_labels": Query(merge_labels, MERGE_LABELS),
    "q_confusion": Query(
        confusion, f"SELECT label, prediction, count(*) AS count FROM ({SCORED}) GROUP BY 1, 2"
    ),
    "q_accuracy": Query(
        accuracy, f"SELECT round(avg((label = prediction)::INT), 9) AS accuracy FROM ({SCORED})"
    ),
    "q_f_threshold": Query(f_threshold, _f_sql(SCORED, "probability", "label = 1")),
    "q_evaluate": Query(evaluated, EVALUATE),
    "q_disagreements": Query(disagreements, DISAGREEMENTS),
    "q_recommend_user": Query(recommend_user, _recommend_sql("user_id", "item_id")),
    "q_recommend_item": Query(recommend_item, _recommend_sql("item_id", "user_id")),
    "q_recommend_one_user": Query(recommend_one_user, RECOMMEND_ONE),
    "q_publish_results": Query(publish_results, PUBLISH_RESULTS),
    "q_publish_disagreements": Query(publish_disagreements, PUBLISH_DISAGREEMENTS),
    "q_libsvm": Query(libsvm, LIBSVM),
    "q_delimited": Query(delimited, DELIMITED),
    "q_save_roundtrip": Query(round_trips, ROUND_TRIPS),
}
