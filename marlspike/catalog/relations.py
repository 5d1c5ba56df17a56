"""Queries over joins, profiles, ids and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.catalog.base import Query, sql_hash, tables
from marlspike.functions.hashing import threshold
from marlspike.operators import ids, profile, relate, sample
from marlspike.plans.stages import run_stages
from marlspike.session import scratch_path
from marlspike.sources.versions import publish, read_version, versions

SEED = 7


def enrich_left(spark: SparkSession, d: str) -> DataFrame:
    customer, nation, orders = tables(spark, d, "customer", "nation", "orders")
    names = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    urgent = (
        orders.where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_urgent"))
    )
    return relate.enrich(
        customer.select("c_custkey", "c_nationkey"),
        (names, "c_nationkey", ["n_name"]),
        (urgent, "c_custkey", ["n_urgent"]),
    )


ENRICH_LEFT = """
SELECT c_custkey, c_nationkey, n_name, n_urgent FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_urgent FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey
"""


def join_right(spark: SparkSession, d: str) -> DataFrame:
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    # open orders get keys that no line has
    key = F.when(F.col("o_orderstatus") == "O", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    base = orders.select(key.alias("key"), "o_orderpriority")
    predictions = lineitem.select(F.col("l_orderkey").alias("key"), "l_partkey", "l_quantity")
    return relate.join_predictions(base, predictions, "key")


JOIN_RIGHT = """
SELECT l_orderkey AS key, o_orderpriority, l_partkey, l_quantity
FROM (SELECT CASE WHEN o_orderstatus = 'O' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_orderpriority FROM orders)
RIGHT JOIN lineitem ON o_orderkey = l_orderkey
"""


def star_join(spark: SparkSession, d: str) -> DataFrame:
    lineitem, part, supplier = tables(spark, d, "lineitem", "part", "supplier")
    joined = relate.assemble_star(
        lineitem.select(
            F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), "l_quantity"
        ),
        (part.select(F.col("p_partkey").alias("part"), "p_brand"), "part"),
        (supplier.select(F.col("s_suppkey").alias("supplier"), "s_nationkey"), "supplier"),
    )
    return joined.groupBy("p_brand", "s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


STAR_JOIN = """
SELECT p_brand, s_nationkey, count(*) AS n, sum(l_quantity) AS quantity
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY 1, 2
"""


def hot_join(spark: SparkSession, d: str) -> DataFrame:
    """Lines joined to orders, where one order has half of all lines and a part has none."""
    lineitem, orders = tables(spark, d, "lineitem", "orders")
    first = orders.agg(F.min("o_orderkey")).first()[0]
    key = (
        F.when(F.col("l_linenumber") % 2 == 1, F.lit(first))
        .when(F.col("l_linenumber") == 2, F.lit(None))
        .otherwise(F.col("l_orderkey"))
    )
    lines = lineitem.select(key.cast("bigint").alias("o_orderkey"), "l_orderkey", "l_linenumber", "l_quantity")
    return relate.join_spread(lines, orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderkey")


HOT_JOIN = """
WITH f AS (SELECT min(o_orderkey) AS first FROM orders),
l AS (SELECT CASE WHEN l_linenumber % 2 = 1 THEN first WHEN l_linenumber = 2 THEN NULL ELSE l_orderkey END::BIGINT AS o_orderkey,
  l_orderkey, l_linenumber, l_quantity FROM lineitem, f)
SELECT l.*, o_orderpriority, o_totalprice FROM l LEFT JOIN orders USING (o_orderkey)
"""


def attach_label(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = tables(spark, d, "documents", "labels")
    held = labels.select("doc_id", F.col("quality").cast("string").alias("text_label"))
    return relate.attach_label(documents.select("doc_id", "lang", "n_chars"), held, "doc_id")


ATTACH_LABEL = """
SELECT doc_id, lang, n_chars, quality::INT AS text_label
FROM documents JOIN labels USING (doc_id)
"""


def population(spark: SparkSession, d: str) -> DataFrame:
    customer, orders = tables(spark, d, "customer", "orders")
    # Known positives: customers with a large order. Candidates: two segments.
    known = orders.where(F.col("o_totalprice") > 480000).select(F.col("o_custkey").alias("c_custkey"))
    candidates = customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    copies = customer.unionByName(
        customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    )
    return relate.build_population(copies, known, candidates, "c_custkey", "c_acctbal")


POPULATION = """
WITH known AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 480000)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  CASE WHEN k IS NULL THEN 2 ELSE 1 END AS label
FROM customer LEFT JOIN known ON k = c_custkey
WHERE k IS NOT NULL OR c_mktsegment IN ('BUILDING', 'MACHINERY')
"""


def excluded(spark: SparkSession, d: str) -> DataFrame:
    customer, orders = tables(spark, d, "customer", "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    return relate.exclude(
        customer.select("c_custkey", "c_name"),
        urgent.select(F.col("o_custkey").alias("c_custkey")),
        "c_custkey",
    )


EXCLUDE = """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
"""


def dedup(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    rows = lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    one = relate.dedup(rows, "l_partkey", ["l_shipdate", "l_orderkey"], keep="last")
    return one.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


DEDUP = """
SELECT l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_orderkey, l_linenumber, l_quantity
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY lineitem.l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1
"""


def cardinality(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    return profile.profile_cardinality(
        lineitem, "l_orderkey", ["l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]
    )


CARDINALITY = """
SELECT count(l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
  count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag,
  count(DISTINCT l_shipdate) AS l_shipdate FROM lineitem
"""


def cardinality_sketch(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    cols = ["l_partkey", "l_suppkey"]
    sketch = profile.profile_cardinality(lineitem, "l_orderkey", cols, approx=True)
    exact = profile.profile_cardinality(lineitem, "l_orderkey", cols).toDF("n", *[f"exact_{c}" for c in cols])
    near = [(F.abs(F.col(c) / F.col(f"exact_{c}") - 1) < 0.15).alias(f"{c}_near") for c in cols]
    # two rows of one each, side by side
    return sketch.join(exact, F.col("l_orderkey") == F.col("n")).select("l_orderkey", *near)


STATE_COLS = ["l_partkey", "l_suppkey", "l_returnflag"]


def profile_states(spark: SparkSession, d: str) -> DataFrame:
    """States by month, saved in two batches and united by year, next to exact counts."""
    (lineitem,) = tables(spark, d, "lineitem")
    rows = lineitem.select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), *STATE_COLS)
    early = F.coalesce(F.col("month") < "1995-01", F.lit(False))
    path = scratch_path(spark, "states")
    publish(profile.profile_state(rows.where(early), STATE_COLS, ["month"]), path)
    later = profile.profile_state(rows.where(~early), STATE_COLS, ["month"])
    publish(read_version(spark, path).unionByName(later), path)
    year = F.substring("month", 1, 4).alias("year")
    saved = read_version(spark, path).select(year, "name", "n", "largest", "sketch")
    found = profile.read_states(profile.unite_states(saved, ["year"]))
    exact = rows.groupBy(year).agg(*[F.count_distinct(F.col(c)).alias(c) for c in STATE_COLS])
    exact = exact.unpivot("year", STATE_COLS, "name", "n_exact")
    within = F.col("n_exact").between(F.col("at_least"), F.col("at_most")).alias("within")
    met = found.alias("f").join(
        exact.alias("e"), F.expr("f.year <=> e.year AND f.name = e.name"), "full"
    )
    return met.select("f.year", "f.name", "n", "largest", "n_exact", within)


PROFILE_STATES = "\nUNION ALL ".join(
    f"""SELECT strftime(l_shipdate, '%Y') AS year, '{c}' AS name, count({c}) AS n,
  {"NULL::BIGINT" if c == "l_returnflag" else f"max({c})::BIGINT"} AS largest,
  count(DISTINCT {c}) AS n_exact, true AS within FROM lineitem GROUP BY 1"""
    for c in STATE_COLS
)


def embedding_dims(spark: SparkSession, d: str) -> DataFrame:
    (lineitem,) = tables(spark, d, "lineitem")
    return profile.embedding_dims(lineitem, ["l_partkey", "l_suppkey"])


def dictionary_index(spark: SparkSession, d: str) -> DataFrame:
    part, customer = tables(spark, d, "part", "customer")
    names = profile.fit_dictionary(part, "p_name").withColumn("kind", F.lit("p_name"))
    segments = profile.fit_dictionary(customer, "c_mktsegment").withColumn("kind", F.lit("segment"))
    return names.unionByName(segments)


def _dictionary_sql(table: str, col: str) -> str:
    return f"""SELECT {col} AS value, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, {col}) AS idx
      FROM {table} WHERE {col} IS NOT NULL GROUP BY 1"""


DICTIONARY_INDEX = f"""
SELECT *, 'p_name' AS kind FROM ({_dictionary_sql("part", "p_name")})
UNION ALL SELECT *, 'segment' FROM ({_dictionary_sql("customer", "c_mktsegment")})
"""


def dictionary_apply(spark: SparkSession, d: str) -> DataFrame:
    (part,) = tables(spark, d, "part")
    fitted = profile.fit_dictionary(part, "p_name")
    # Every seventh name is changed into one that the dictionary lacks.
    changed = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit("?"))).otherwise(F.col("p_name"))
    rows = part.select("p_partkey", changed.alias("p_name"))
    return profile.apply_dictionary(rows, fitted, "p_name", "name_id")


DICTIONARY_APPLY = f"""
WITH f AS ({_dictionary_sql("part", "p_name")}),
p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN p_name || '?' ELSE p_name END AS p_name FROM part)
SELECT p_partkey, p_name, coalesce(idx, 0) AS name_id FROM p LEFT JOIN f ON value = p_name
"""


def dictionary_versions(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of customers, published after the orders of 1992 and again after the rest."""
    (orders,) = tables(spark, d, "orders")
    early = F.coalesce(F.col("o_orderdate").cast("date") < F.lit("1993-01-01").cast("date"), F.lit(False))
    rows = orders.select(F.col("o_custkey").cast("string").alias("customer"), early.alias("early"))
    path = scratch_path(spark, "versions")
    first = publish(profile.extend_dictionary(None, rows.where("early"), "customer", 1), path)
    second = publish(profile.extend_dictionary(read_version(spark, path), rows.where("NOT early"), "customer", 2), path)
    both = [read_version(spark, path, v).withColumn("version", F.lit(v)) for v in (first, second)]
    return both[0].unionByName(both[1])


DICTIONARY_VERSIONS = """
WITH o AS (
  SELECT o_custkey::VARCHAR AS value, coalesce(o_orderdate::DATE < DATE '1993-01-01', false) AS early
  FROM orders WHERE o_custkey IS NOT NULL
), v1 AS (
  SELECT value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, value) AS idx FROM o WHERE early GROUP BY 1
), late AS (SELECT value, count(*) AS n FROM o WHERE NOT early GROUP BY 1)
SELECT value, count, idx, 1 AS since, 1 AS version FROM v1
UNION ALL SELECT v1.value, count + coalesce(n, 0), idx, 1, 2 FROM v1 LEFT JOIN late ON late.value = v1.value
UNION ALL SELECT value, n, (SELECT coalesce(max(idx), 0) FROM v1) + row_number() OVER (ORDER BY n DESC, value), 2, 2
FROM late WHERE value NOT IN (SELECT value FROM v1)
"""


def staged_run(spark: SparkSession, d: str) -> DataFrame:
    """Three stages that fail in the last one, are taken up again, and run once more after
    the second one was revised: how often each was computed, and what its table holds."""
    customer, orders = tables(spark, d, "customer", "orders")
    path = scratch_path(spark, "stages")
    started = {"placed": 0, "totals": 0, "labelled": 0}

    def run(fail: bool = False, least: int = 1, **revisions: str) -> None:
        def placed(held):
            started["placed"] += 1
            return held["orders"].select("o_custkey", "o_totalprice").where("o_custkey IS NOT NULL")

        def totals(held):
            started["totals"] += 1
            n = F.count(F.lit(1)).alias("n")
            return held["placed"].groupBy("o_custkey").agg(n, F.max("o_totalprice").alias("top")).where(n >= least)

        def labelled(held):
            started["labelled"] += 1
            if fail:
                raise InterruptedError("on purpose")
            joined = held["customer"].join(held["totals"], F.col("c_custkey") == F.col("o_custkey"), "left")
            return joined.select("c_custkey", "n", "top", F.when(F.col("n").isNull(), 2).otherwise(1).alias("label"))

        stages = [("placed", placed), ("totals", totals), ("labelled", labelled)]
        run_stages(spark, path, {"customer": customer, "orders": orders}, stages, revisions)

    try:
        run(fail=True)
    except InterruptedError:
        run()
    run()
    run(least=10, totals="10")
    sizes = {"placed": F.lit(0), "totals": F.sum("n"), "labelled": F.sum("label")}
    listed = None
    for name, size in sizes.items():
        for version in [r["version"] for r in versions(spark, f"{path}/{name}").collect()]:
            held = read_version(spark, f"{path}/{name}", version)
            row = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).cast("bigint").alias("total"))
            row = row.select(
                F.lit(name).alias("stage"), F.lit(version).alias("version"), F.lit(started[name]).alias("computed"), "n", "total"
            )
            listed = row if listed is None else listed.unionByName(row)
    return listed


_TOTALS = "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1"
STAGED_RUN = f"""
WITH t1 AS ({_TOTALS}), t2 AS ({_TOTALS} HAVING count(*) >= 10)
SELECT 'placed' AS stage, 1 AS version, 1 AS computed, count(*) AS n, 0::BIGINT AS total FROM orders WHERE o_custkey IS NOT NULL
UNION ALL SELECT 'totals', 1, 2, count(*), coalesce(sum(n), 0)::BIGINT FROM t1
UNION ALL SELECT 'totals', 2, 2, count(*), coalesce(sum(n), 0)::BIGINT FROM t2
UNION ALL SELECT 'labelled', 1, 3, count(*), coalesce(sum(CASE WHEN n IS NULL THEN 2 ELSE 1 END), 0)::BIGINT
  FROM customer LEFT JOIN t1 ON o_custkey = c_custkey
UNION ALL SELECT 'labelled', 2, 3, count(*), coalesce(sum(CASE WHEN n IS NULL THEN 2 ELSE 1 END), 0)::BIGINT
  FROM customer LEFT JOIN t2 ON o_custkey = c_custkey
"""


def ids_up(spark: SparkSession, d: str) -> DataFrame:
    (customer,) = tables(spark, d, "customer")
    return ids.assign_ids(customer.select("c_name", "c_custkey"), "c_name", as_string=True)


def ids_down(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    rows = orders.select("o_orderdate", "o_orderkey", "o_totalprice")
    placed = ids.assign_ids(rows, ["o_orderdate", "o_orderkey"], desc=True)
    return placed.drop("o_orderdate")


def ids_shared_key(spark: SparkSession, d: str) -> DataFrame:
    """Ids over a key that many rows share: only the id range of each key is
    determined, so that is what is reported."""
    (orders,) = tables(spark, d, "orders")
    placed = ids.assign_ids(orders.select("o_orderpriority", "o_totalprice"), "o_orderpriority")
    return placed.groupBy("o_orderpriority").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("n_ids"),
    )


IDS_SHARED_KEY = """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT *, sum(n) OVER (ORDER BY o_orderpriority) AS up FROM c)
SELECT o_orderpriority, (up - n + 1)::BIGINT AS first_id, up::BIGINT AS last_id, n AS n_ids FROM s
"""


def stratified(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    return sample.stratified_sample(
        orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"O": 0.317}, "o_orderkey", SEED
    )


ORDER_HASH = sql_hash("o_orderkey::VARCHAR", SEED)
STRATIFIED = f"""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus <> 'O' OR {ORDER_HASH} < {threshold(0.317)}
"""


def counted(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    rows = orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sample.sample_counts(rows, "o_orderstatus", {"F": 3000}, "o_orderkey", SEED)


SAMPLE_COUNTS = f"""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY o_orderstatus <> 'F'
  OR row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER_HASH}, o_orderkey) <= 3000
"""


def balanced(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    return sample.balance_classes(
        orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey", SEED
    )


BALANCE = f"""
WITH c AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus))
SELECT o_orderkey, o_orderstatus FROM orders, c
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER_HASH}, o_orderkey) <= c.n
"""


def balanced_copies(spark: SparkSession, d: str) -> DataFrame:
    """Balancing where one key is shared by whole classes of rows, so that the
    cut falls inside a group of equal hashes."""
    (lineitem,) = tables(spark, d, "lineitem")
    rows = lineitem.select("l_returnflag", "l_suppkey", "l_quantity")
    kept = sample.balance_classes(rows, "l_returnflag", "l_suppkey", SEED)
    return kept.groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))


BALANCE_COPIES = f"""
WITH c AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)),
k AS (SELECT l_returnflag, l_suppkey FROM lineitem, c
  QUALIFY row_number() OVER (PARTITION BY l_returnflag
    ORDER BY {sql_hash("l_suppkey::VARCHAR", SEED)}) <= c.n)
SELECT l_returnflag, l_suppkey, count(*) AS n FROM k GROUP BY 1, 2
"""


def first_n(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    negatives = orders.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice")
    positives = orders.where(F.col("o_orderstatus") != "O").select("o_orderkey", "o_totalprice")
    return sample.take_n(negatives, 3000, "o_orderkey", SEED).unionByName(positives)


TAKE_N = f"""
(SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
  ORDER BY {ORDER_HASH}, o_orderkey LIMIT 3000)
UNION ALL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O')
"""


def parts(spark: SparkSession, d: str) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    weights = {"train": 0.75, "valid": 0.25}
    return sample.tag_split(orders.select("o_orderkey"), weights, "o_orderkey", SEED)


SPLIT = f"""
SELECT o_orderkey, CASE WHEN {ORDER_HASH} < {threshold(0.75)} THEN 'train' ELSE 'valid' END AS split
FROM orders
"""


def negatives(spark: SparkSession, d: str) -> DataFrame:
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    facts = orders.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")
    )
    return sample.negative_samples(facts, "user", "item", SEED)


NEGATIVES = f"""
WITH f AS (SELECT DISTINCT o_custkey AS "user", l_partkey AS item
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
m AS (SELECT max(item) AS top FROM f),
n AS (SELECT DISTINCT "user",
  {sql_hash("\"user\"::VARCHAR || '|' || item::VARCHAR", SEED)} % top + 1 AS item FROM f, m)
SELECT "user", item, 1 AS label FROM n
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE f."user" = n."user" AND f.item = n.item)
UNION ALL SELECT "user", item, 2 FROM f
"""

QUERIES = {
    "q_enrich_left": Query(enrich_left, ENRICH_LEFT),
    "q_join_right": Query(join_right, JOIN_RIGHT),
    "q_star_join": Query(star_join, STAR_JOIN),
    "q_hot_join": Query(hot_join, HOT_JOIN),
    "q_attach_label": Query(attach_label, ATTACH_LABEL),
    "q_population": Query(population, POPULATION),
    "q_exclude": Query(excluded, EXCLUDE),
    "q_dedup": Query(dedup, DEDUP),
    "q_cardinality": Query(cardinality, CARDINALITY),
    "q_cardinality_sketch": Query(
        cardinality_sketch,
        "SELECT count(l_orderkey) AS l_orderkey, true AS l_partkey_near, true AS l_suppkey_near FROM lineitem",
    ),
    "q_profile_states": Query(profile_states, PROFILE_STATES),
    "q_embedding_dims": Query(
        embedding_dims,
        "SELECT max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey FROM lineitem",
    ),
    "q_dictionary_index": Query(dictionary_index, DICTIONARY_INDEX),
    "q_dictionary_versions": Query(dictionary_versions, DICTIONARY_VERSIONS),
    "q_dictionary_apply": Query(dictionary_apply, DICTIONARY_APPLY),
    "q_staged_run": Query(staged_run, STAGED_RUN),
    "q_assign_ids": Query(
        ids_up,
        """SELECT c_name, c_custkey, (row_number() OVER (ORDER BY c_name))::VARCHAR AS id
        FROM customer""",
    ),
    "q_assign_ids_desc": Query(
        ids_down,
        """SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS id FROM orders""",
    ),
    "q_assign_ids_shared_key": Query(ids_shared_key, IDS_SHARED_KEY),
    "q_stratified_sample": Query(stratified, STRATIFIED),
    "q_sample_counts": Query(counted, SAMPLE_COUNTS),
    "q_balance": Query(balanced, BALANCE),
    "q_balance_copies": Query(balanced_copies, BALANCE_COPIES),
    "q_take_n": Query(first_n, TAKE_N),
    "q_split": Query(parts, SPLIT),
    "q_negative_samples": Query(negatives, NEGATIVES),
}
