"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). A token budget is shared out from the root
down: a node's budget goes to its children by weight, no child gets more than it
can hold (its tokens times the number of epochs allowed), and what it can't hold
goes to its siblings; only when all of a node's children are full does the
shortage reach the node's own siblings, that is, one level up. All amounts are
whole tokens and add up to the budget exactly.

A leaf's documents form one stream of epochs, each in the order of a hash of the
id, the seed and the epoch, and the leaf takes the first tokens of that stream: so
many whole epochs and a prefix of the next, of whose last document only the first
tokens are taken. The place of the cut is found by sums over 1024 ranges of the
hash; only the range that the cut falls into is added up row by row, so a leaf
with a large part of all rows is never in one task.

Weights are whole numbers from 1 to 10,000. A budget beyond what the tree can hold
takes everything. Defined results: tokens are runs of characters other than space
and 0x09-0x0D; a null or empty text has none and is never taken; a null name of a
domain, language or source is the node `(none)`; repeated rows count each. Further
columns are kept by take_documents() and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.session import materialize

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]
RANGES = 10  # bits of the hash
SEED = 7
NONE = "(none)"


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weight(level: str, weights: dict[str, int]) -> Column:
    """The weight of a node by its name; 1 where none is given."""
    found = F.lit(1)
    for name, value in weights.items():
        found = F.when(F.col(level) == name, F.lit(value)).otherwise(found)
    return found.cast("long")


def order_key(key: Column, seed: int, epoch: Column) -> Column:
    """A 60-bit hash of the id, the seed and the epoch."""
    name = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed)), epoch.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes (parent columns, name, weight, room, budget of the parent) with `share`.

    Children in order of room by weight: a child is full if its room is at most its
    part of what the fuller ones before it have left. The others share the rest by
    weight, rounded down, and the tokens left by rounding go one each to the first.
    """
    ratio = F.col("room") / F.col("weight")
    by = Window.partitionBy(*parent).orderBy(ratio, name)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    big = "decimal(19,0)"
    rows = nodes.withColumn("given", F.coalesce(F.sum("room").over(before), F.lit(0))).withColumn(
        "heavy", F.sum("weight").over(after)
    )
    full = F.col("room").cast(big) * F.col("heavy").cast(big) <= (F.col("budget") - F.col("given")).cast(
        big
    ) * F.col("weight").cast(big)
    rows = rows.withColumn("full", F.min(full).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    open_ = Window.partitionBy(*parent, "full")
    rows = rows.withColumn("left_", F.col("budget") - F.min("given").over(open_)).withColumn(
        "weights", F.max("heavy").over(open_)
    )
    part = F.expr(f"(cast(left_ as {big}) * cast(weight as {big})) div cast(weights as {big})").cast("long")
    rows = rows.withColumn("part", part)
    spare = F.col("left_") - F.sum("part").over(open_)
    place = F.row_number().over(open_.orderBy(F.desc("weight"), name))
    rows = rows.withColumn("spare", spare).withColumn("place", place)
    share = F.when(F.col("full"), F.col("room")).otherwise(
        F.col("part") + (F.col("place") <= F.col("spare")).cast("long")
    )
    return rows.withColumn("share", share).drop(
        "given", "heavy", "full", "left_", "weights", "part", "spare", "place"
    )


def leaf_budgets(
    leaves: DataFrame, weights: dict[str, dict[str, int]], percent: int, epochs: int
) -> DataFrame:
    """(domain, lang, source, tokens, share): the tokens to take of each leaf.

    leaves: (domain, lang, source, tokens); percent: the budget, of all tokens."""
    nodes = {3: leaves.withColumn("room", F.col("tokens") * epochs)}
    for depth in (2, 1):
        nodes[depth] = nodes[depth + 1].groupBy(*LEVELS[:depth]).agg(F.sum("room").alias("room"))
    # a root's room is its tokens times the epochs
    budget = F.expr(f"(sum(room) OVER () div {epochs}) * {percent} div 100")
    rows = nodes[1].withColumn("budget", budget)
    for depth in (1, 2, 3):
        name = LEVELS[depth - 1]
        rows = rows.withColumn("weight", weight(name, weights.get(name, {})))
        rows = rows.withColumn("budget", F.least("budget", F.sum("room").over(Window.partitionBy(*LEVELS[: depth - 1]))))
        given = share_out(rows, LEVELS[: depth - 1], name)
        if depth < 3:
            above = given.select(*LEVELS[:depth], F.col("share").alias("budget"))
            rows = nodes[depth + 1].join(above, LEVELS[:depth])
    return given.select(*LEVELS, "tokens", "share")


def take(
    rows: DataFrame,
    weights: dict[str, dict[str, int]],
    percent: int,
    epochs: int = 1,
    seed: int = SEED,
) -> DataFrame:
    """(doc, domain, lang, source, tokens, epoch, taken) for each document and epoch
    of which tokens are taken. rows: (doc, domain, lang, source, tokens)."""
    rows = materialize(rows.filter("tokens > 0").select("doc", *LEVELS, "tokens"), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, weights, percent, epochs)
    budgets = materialize(
        budgets.select(
            *LEVELS,
            F.expr("cast(share div tokens as int)").alias("whole"),
            (F.col("share") % F.col("tokens")).alias("rest"),
        ),
        "budgets",
    )
    dealt = rows.join(budgets, LEVELS)
    full = dealt.filter("whole > 0").select(
        "doc", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"),
        F.col("tokens").alias("taken"),
    )
    part = (
        dealt.filter("rest > 0")
        .withColumn("epoch", F.col("whole"))
        .withColumn("place", order_key(F.col("doc"), seed, F.col("epoch")))
        .withColumn("range", F.shiftright("place", 60 - RANGES))
    )
    by_range = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        part.groupBy(*LEVELS, "range")
        .agg(F.sum("tokens").alias("held"))
        .withColumn("begin", F.coalesce(F.sum("held").over(by_range), F.lit(0)))
    )
    part = part.join(sums, [*LEVELS, "range"]).filter("begin < rest")
    inside = part.filter("begin + held <= rest").withColumn("taken", F.col("tokens"))
    by_row = Window.partitionBy(*LEVELS).orderBy("place", "doc", "tokens")
    cut = part.filter("begin + held > rest").withColumn(
        "before",
        F.col("begin") + F.coalesce(F.sum("tokens").over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    cut = cut.filter("before < rest").withColumn("taken", F.least(F.col("tokens"), F.col("rest") - F.col("before")))
    names = ["doc", *LEVELS, "tokens", "epoch", "taken"]
    return full.select(names).unionByName(inside.select(names)).unionByName(cut.select(names))


def domain_of(source: Column) -> Column:
    """The domain of a source: four domains, by the number at the end of its name."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (F.substring(number, -6, 6).cast("int") % 4).cast("string")))


def leafed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, domain, lang, source, tokens) of documents."""
    return docs.select(
        F.col(key).alias("doc"),
        F.coalesce(domain_of(F.col("source")), F.lit(NONE)).alias("domain"),
        F.coalesce(F.col("lang"), F.lit(NONE)).alias("lang"),
        F.coalesce(F.col("source"), F.lit(NONE)).alias("source"),
        count_tokens(F.col(text)).alias("tokens"),
    )


def first_tokens(text: Column, count: Column) -> Column:
    """The text up to the end of its count-th token."""
    units = F.regexp_extract_all(text, F.lit(f"({SPACE}*{WORD})"), F.lit(1))
    return F.array_join(F.slice(units, F.lit(1), count.cast("int")), "")


def take_documents(
    docs: DataFrame,
    weights: dict[str, dict[str, int]],
    percent: int,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """docs, all columns, without the documents of which no token is taken in one
    epoch; a document of which a part is taken has its text (and n_chars) cut.

    Rows that share an id are one document here: all of them are kept if one is
    taken, uncut if one is taken whole."""
    chosen = (
        take(leafed(docs, key, text), weights, percent, 1, seed)
        .groupBy("doc")
        .agg(F.max(F.col("taken") >= F.col("tokens")).alias("uncut"), F.max("taken").alias("taken"))
    )
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    joined = docs.select(row, docs[key].alias("key")).join(chosen, F.col("key").eqNullSafe(F.col("doc")))
    cut = F.when(F.col("uncut"), F.col(f"row.{text}")).otherwise(first_tokens(F.col(f"row.{text}"), F.col("taken")))
    out = joined.select("row", cut.alias("cut"), "uncut")
    columns = [
        F.col("cut").alias(c) if c == text
        else F.when(F.col("uncut"), F.col(f"row.{c}")).otherwise(F.length("cut").cast("long")).alias(c) if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return out.select(columns)


WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
PERCENT, EPOCHS = 70, 2


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return take(leafed(docs), WEIGHTS, PERCENT, EPOCHS).select(
        F.col("doc").alias("doc_id"),
        *LEVELS,
        F.col("tokens").alias("n_tokens"),
        F.col("epoch").cast("long").alias("epoch"),
        F.col("taken").alias("taken_tokens"),
    )


def _level_sql(depth: int, source: str) -> str:
    name, parent = LEVELS[depth - 1], ", ".join(LEVELS[: depth - 1])
    by = f"PARTITION BY {parent}" if parent else ""
    by_open = f"PARTITION BY {parent}, isfull" if parent else "PARTITION BY isfull"
    case = "CASE " + name + "".join(f" WHEN '{k}' THEN {v}" for k, v in WEIGHTS[name].items()) + " ELSE 1 END"
    if not WEIGHTS[name]:
        case = "1"
    return f"""
a{depth} AS (SELECT *, ({case})::BIGINT AS weight, least(budget0, sum(room) OVER ({by}))::BIGINT AS budget FROM {source}),
b{depth} AS (SELECT *,
  coalesce(sum(room) OVER ({by} ORDER BY room / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
  sum(weight) OVER ({by} ORDER BY room / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM a{depth}),
c{depth} AS (SELECT *, bool_and(room * heavy <= (budget - given) * weight)
  OVER ({by} ORDER BY room / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isfull FROM b{depth}),
d{depth} AS (SELECT *, budget - min(given) OVER ({by_open}) AS rest0, max(heavy) OVER ({by_open}) AS weights FROM c{depth}),
e{depth} AS (SELECT *, (rest0 * weight) // weights AS part FROM d{depth}),
f{depth} AS (SELECT *, rest0 - sum(part) OVER ({by_open}) AS spare,
  row_number() OVER ({by_open} ORDER BY weight DESC, {name}) AS place FROM e{depth}),
g{depth} AS (SELECT * EXCLUDE (budget0, weight, budget, given, heavy, isfull, rest0, weights, part, spare, place),
  (CASE WHEN isfull THEN room ELSE part + (place <= spare)::INT END)::BIGINT AS share FROM f{depth})"""


SQL = rf"""
WITH docs AS (
  SELECT doc_id,
    coalesce('domain' || CAST(CAST(right(nullif(regexp_extract(source, '(\d+)$', 1), ''), 6) AS INT) % 4 AS VARCHAR), '(none)') AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents),
l AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, (sum(n_tokens) * {EPOCHS})::HUGEINT AS room
  FROM docs WHERE n_tokens > 0 GROUP BY ALL),
n2 AS (SELECT domain, lang, sum(room)::HUGEINT AS room FROM l GROUP BY ALL),
n1 AS (SELECT domain, sum(room)::HUGEINT AS room, (SELECT sum(tokens) * {PERCENT} // 100 FROM l) AS budget0 FROM l GROUP BY ALL),
{_level_sql(1, "n1")},
m2 AS (SELECT n2.*, g1.share AS budget0 FROM n2 JOIN g1 USING (domain)),
{_level_sql(2, "m2")},
m3 AS (SELECT l.*, g2.share AS budget0 FROM l JOIN g2 USING (domain, lang)),
{_level_sql(3, "m3")},
k AS (
  SELECT docs.*, (share // tokens)::BIGINT AS whole, (share % tokens)::BIGINT AS rest
  FROM docs JOIN g3 USING (domain, lang, source) WHERE n_tokens > 0),
p AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{SEED}|' || whole), 1, 15))::BIGINT, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(0, whole)) AS epoch, n_tokens AS taken_tokens FROM k
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, whole, least(n_tokens, rest - before)::BIGINT FROM p WHERE before < rest
"""

QUERIES = {"op7_mixing": (op7_mixing, SQL)}
