"""Queries over text: tokens, vocabularies, corpora, pooled embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.catalog.base import Query, sql_hash, tables
from marlspike.functions.hashing import threshold
from marlspike.operators import discover, text
from marlspike.plans import jobs
from marlspike.session import materialize, scratch_path
from marlspike.sources.readers import load_stopwords, spread
from marlspike.sources.sinks import save

SEED = 7
TOKENS_SQL = r"""list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"""


def _tokens_sql(column: str) -> str:
    return TOKENS_SQL.format(c=column)


CUT = f"cut AS (SELECT doc_id, {_tokens_sql('text')} AS tokens FROM documents)"
WORDS = "words AS (SELECT doc_id, unnest(tokens) AS token FROM cut)"
COUNTS = "counts AS (SELECT token, count(*) AS count FROM words GROUP BY 1)"


def _vocab_sql(where: str = "TRUE", shift: int = 0) -> str:
    return f"""vocab AS (SELECT token, count, (rn - {shift})::INT AS idx FROM
      (SELECT *, row_number() OVER (ORDER BY count DESC, token) AS rn FROM counts) WHERE {where})"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    (documents,) = tables(spark, d, "documents")
    return spread(documents, "doc_id")


def _cut_documents(spark: SparkSession, d: str) -> DataFrame:
    return text.tokenize(_documents(spark, d), "text").select("doc_id", "tokens")


def tokens(spark: SparkSession, d: str) -> DataFrame:
    cut = _cut_documents(spark, d)
    return cut.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("joined")
    )


TOKENIZE = f"""
WITH {CUT} SELECT doc_id, len(tokens)::INT AS n_tokens, array_to_string(tokens, ' ') AS joined FROM cut
"""


def conversation_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Pair and sub-word modes leave text without Han letters as it is."""
    (conversations,) = tables(spark, d, "conversations")
    cut = text.tokenize(conversations, "text", mode="cjk_bigram", search=True)
    return cut.select("conv_id", "turn", F.array_join("tokens", " ").alias("joined"))


def stopwords(spark: SparkSession, d: str) -> DataFrame:
    cut = _cut_documents(spark, d)
    frequent = text.build_vocab(cut, "tokens", max_words=50).select("token")
    kept = text.remove_stopwords(cut, "tokens", frequent)
    return kept.select("doc_id", F.array_join("tokens", " ").alias("joined"))


STOPWORDS = f"""
WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql("rn <= 50")},
s AS (SELECT list(token) AS stop FROM vocab)
SELECT doc_id, array_to_string(list_filter(tokens, lambda t: NOT list_contains(stop, t)), ' ') AS joined
FROM cut, s
"""


def stopword_file(spark: SparkSession, d: str) -> DataFrame:
    """Words seen at most three times, read from a file that replaced another list."""
    cut = _cut_documents(spark, d)
    counts = materialize(text.count_tokens(cut, "tokens"), "counts")
    path = scratch_path(spark, "stopwords")
    save(counts.where("count > 3").select("token"), path, "text")
    save(counts.where("count <= 3").select("token"), path, "text")
    kept = text.remove_stopwords(cut, "tokens", load_stopwords(spark, path))
    return kept.select("doc_id", F.array_join("tokens", " ").alias("joined"))


STOPWORD_FILE = f"""
WITH {CUT}, {WORDS}, {COUNTS},
p AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM cut),
k AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS joined FROM p JOIN counts USING (token) WHERE count > 3 GROUP BY 1)
SELECT doc_id, coalesce(joined, '') AS joined FROM cut LEFT JOIN k USING (doc_id)
"""


def vocab_top(spark: SparkSession, d: str) -> DataFrame:
    return text.build_vocab(_cut_documents(spark, d), "tokens", max_words=5000, remove_top_n=10)


def vocab_whole(spark: SparkSession, d: str) -> DataFrame:
    return text.build_vocab(_cut_documents(spark, d), "tokens")


def wide_tokens(spark: SparkSession, d: str) -> DataFrame:
    cut = _cut_documents(spark, d)
    vocab = text.build_vocab(cut, "tokens")
    return text.tokens_to_wide(cut, "doc_id", "tokens", vocab, n=40)


WIDE_COLS = ", ".join(f"coalesce(max(CASE WHEN pos = {i + 1} THEN idx END), 0)::INT AS wide{i}" for i in range(40))
TOKENS_WIDE = f"""
WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql()},
p AS (SELECT doc_id, unnest(tokens[1:40]) AS token, generate_subscripts(tokens[1:40], 1) AS pos FROM cut)
SELECT cut.doc_id, {WIDE_COLS} FROM cut
LEFT JOIN p ON p.doc_id = cut.doc_id LEFT JOIN vocab ON vocab.token = p.token GROUP BY 1
"""


def padded(spark: SparkSession, d: str) -> DataFrame:
    cut = _cut_documents(spark, d)
    vocab = text.build_vocab(cut, "tokens", max_words=5000)
    ids = text.tokens_to_ids(cut, "doc_id", "tokens", vocab)
    return ids.select(
        "doc_id",
        F.array_join(text.pad_sequence("idx", 500), ",").alias("pre"),
        F.array_join(text.pad_sequence("idx", 500, "post"), ",").alias("post"),
    )


PAD_SEQUENCE = f"""
WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql("rn <= 5000")},
p AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM cut),
g AS (SELECT doc_id, list(idx ORDER BY pos) AS ids FROM p JOIN vocab USING (token) GROUP BY 1),
a AS (SELECT doc_id, coalesce(ids, []) AS ids, list_transform(range(500), lambda x: 0) AS zeros
  FROM cut LEFT JOIN g USING (doc_id))
SELECT doc_id,
  array_to_string(list_concat(ids[greatest(len(ids) - 499, 1):len(ids)], zeros)[1:500], ',') AS pre,
  array_to_string(list_concat(ids, zeros)[1:500], ',') AS post
FROM a
"""


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    (labels,) = tables(spark, d, "labels")
    held = labels.select("doc_id", (F.col("quality") + 1).cast("int").alias("label"))
    return _documents(spark, d).select("doc_id", "source", "text").join(held, "doc_id")


def corpus(spark: SparkSession, d: str) -> DataFrame:
    made = text.build_text_corpus(_labelled(spark, d), "doc_id", "source", seed=SEED)
    train = made["train"].withColumn("split", F.lit("train"))
    valid = made["valid"].withColumn("split", F.lit("valid"))
    return train.unionByName(valid)


LABELLED_SQL = f"""
lines AS (SELECT doc_id, source, (quality + 1)::INT AS label,
  CASE WHEN len(t) = 0 THEN '' ELSE '__label__' || (quality + 1) || ' ' || array_to_string(t, ' ') END AS line
  FROM (SELECT *, {_tokens_sql('text')} AS t FROM documents JOIN labels USING (doc_id)))
"""
TEXT_CORPUS = f"""
WITH {LABELLED_SQL},
f AS (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM lines WHERE line <> ''),
m AS (SELECT min(n) AS least FROM f),
b AS (SELECT doc_id, source, label, line FROM f, m QUALIFY row_number() OVER (
  PARTITION BY label ORDER BY {sql_hash("doc_id::VARCHAR", SEED)}, doc_id) <= least)
SELECT doc_id, source, label, line,
  CASE WHEN {sql_hash("doc_id::VARCHAR", SEED + 1)} < {threshold(0.75)} THEN 'train' ELSE 'valid' END AS split
FROM b
"""


def corpus_index(spark: SparkSession, d: str) -> DataFrame:
    made = text.build_text_corpus(_labelled(spark, d), "doc_id", "source", seed=SEED)
    every = made["all"].withColumn("kind", F.lit("line"))
    return made["index"].withColumn("kind", F.lit("index")).unionByName(every)


CORPUS_INDEX = f"""
WITH {LABELLED_SQL}
SELECT '(' || doc_id || ',' || source || ')' AS value, 'index' AS kind FROM lines
UNION ALL SELECT line, 'line' FROM lines
"""


def prepared(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = tables(spark, d, "documents", "labels")
    # German texts get ids that no label has
    own = F.when(F.col("lang") == "de", -F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    held = documents.withColumn("doc_id", own)
    return text.prepare_text(labels, held, "doc_id", ["source", "lang", "text"], "toxic")


PREPARE_TEXT = f"""
SELECT doc_id, toxic AS label,
  CASE WHEN text IS NULL THEN '' ELSE source || ',' || lang || ',' ||
    CASE WHEN regexp_matches(text, '^[\\s\\p{{Z}}]*$') THEN '' ELSE text END END AS text,
  (row_number() OVER (ORDER BY doc_id))::VARCHAR AS id
FROM labels LEFT JOIN (
  SELECT CASE WHEN lang = 'de' THEN -doc_id - 1 ELSE doc_id END AS doc_id, source, lang, text FROM documents) USING (doc_id)
"""


def pooled(spark: SparkSession, d: str) -> DataFrame:
    (embeddings,) = tables(spark, d, "embeddings")
    cut = _cut_documents(spark, d)
    vocab = text.build_vocab(cut, "tokens")
    table = embeddings.select((F.col("vec_id") + 1).alias("idx"), "embedding").join(
        vocab.select(F.col("idx").cast("bigint").alias("idx"), "token"), "idx"
    )
    table = materialize(table.select("token", "embedding"), "embeddings")
    means = text.pool_embeddings(cut, "doc_id", "tokens", table, dim=64)
    flat = means.select("doc_id", "n_tokens", F.posexplode("pooled").alias("dim", "value"))
    return flat.withColumn("value", F.round("value", 6))


POOL_EMBEDDINGS = f"""
WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql()},
e AS (SELECT token, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim
  FROM vocab JOIN embeddings ON vec_id + 1 = idx),
n AS (SELECT doc_id, token, count(*) AS n FROM words GROUP BY 1, 2),
s AS (SELECT doc_id, dim, sum(n) AS n_tokens, sum(n * v) AS total FROM n JOIN e USING (token) GROUP BY 1, 2)
SELECT doc_id, n_tokens::BIGINT AS n_tokens, dim::INT AS dim, round(total / n_tokens, 6) AS value FROM s
"""


def wide_text(spark: SparkSession, d: str) -> DataFrame:
    documents = _documents(spark, d)
    (benchmark,) = tables(spark, d, "benchmark")
    cut = text.tokenize(benchmark, "text")
    stop = text.build_vocab(cut, "tokens", max_words=20).select("token")
    return jobs.build_wide_text(
        documents, "doc_id", ["lang", "text"], stop, require="source", n=40
    )


WIDE_TEXT = f"""
WITH bw AS (SELECT unnest({_tokens_sql('text')}) AS token FROM benchmark),
stop AS (SELECT token FROM (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS rn
  FROM bw GROUP BY 1) WHERE rn <= 20),
s AS (SELECT list(token) AS stop FROM stop),
cut AS (SELECT doc_id, list_filter({_tokens_sql("text || ',' || lang || ','")},
  lambda t: NOT list_contains(stop, t)) AS tokens FROM documents, s WHERE source IS NOT NULL),
{WORDS}, {COUNTS}, {_vocab_sql()},
p AS (SELECT doc_id, unnest(tokens[1:40]) AS token, generate_subscripts(tokens[1:40], 1) AS pos FROM cut)
SELECT cut.doc_id, {WIDE_COLS} FROM cut
LEFT JOIN p ON p.doc_id = cut.doc_id LEFT JOIN vocab ON vocab.token = p.token GROUP BY 1
"""

#: Stand-ins of the Latin letters, for text in a script without spaces.
LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
HAN = "天地人山水火木金土日月星云雨风雪花草鱼鸟虫牛马羊龙虎" * 2


def _han_conversations(spark: SparkSession, d: str) -> DataFrame:
    """The turns with their letters as Han signs and without blanks; all else parts runs."""
    (conversations,) = tables(spark, d, "conversations")
    joined = F.translate(F.regexp_replace("text", r"[ \t\r\n]+", ""), LATIN, HAN)
    return conversations.select("conv_id", "turn", F.regexp_replace(joined, r"[^\p{IsHan}]+", " ").alias("text"))


HAN_SQL = rf"""han AS (SELECT conv_id, turn, regexp_extract_all(
    translate(regexp_replace(text, '[ \t\r\n]+', '', 'g'), '{LATIN}', '{HAN}'), '\p{{Han}}+') AS runs FROM conversations),
run AS (SELECT conv_id, turn, unnest(runs) AS r, generate_subscripts(runs, 1) AS k FROM han)"""
# for the least count and the thresholds of discover_words
FOUND = {"longest": 4, "least": 20, "cohesion": 2.0, "entropy": 1.0}
WORDS_SQL = """
place AS (SELECT r, unnest(range(1, length(r) + 1)) AS i FROM run),
gram AS (SELECT substr(r, i, s) AS word, CASE WHEN i > 1 THEN substr(r, i - 1, 1) ELSE '' END AS "left",
  substr(r, i + s, 1) AS "right" FROM place, (SELECT unnest([1, 2, 3, 4]) AS s) WHERE i + s - 1 <= length(r)),
often AS (SELECT word, count(*) AS n FROM gram GROUP BY 1),
signs AS (SELECT sum(n) AS total FROM often WHERE length(word) = 1),
many AS (SELECT * FROM often WHERE length(word) > 1 AND n >= 20),
cuts AS (SELECT word, n, unnest(range(1, length(word))) AS k FROM many),
held AS (SELECT c.word, c.n, min(ln(c.n * total::DOUBLE / (h.n::DOUBLE * t.n::DOUBLE))) AS cohesion
  FROM cuts c JOIN often h ON h.word = substr(c.word, 1, k) JOIN often t ON t.word = substr(c.word, k + 1), signs
  GROUP BY 1, 2),
beside AS (SELECT word, "left" AS sign, 'left' AS side, count(*) AS c FROM gram GROUP BY 1, 2
  UNION ALL SELECT word, "right", 'right', count(*) FROM gram GROUP BY 1, 2),
ent AS (SELECT word, side, ln(sum(c)) - sum(c * ln(c)) / sum(c) AS e FROM beside GROUP BY 1, 2),
found AS (SELECT held.word, held.n, cohesion, l.e AS left_entropy, r.e AS right_entropy FROM held
  JOIN ent l ON l.word = held.word AND l.side = 'left' JOIN ent r ON r.word = held.word AND r.side = 'right'
  WHERE cohesion >= 2 AND l.e >= 1 AND r.e >= 1)"""


def discovered(spark: SparkSession, d: str) -> DataFrame:
    found = discover.discover_words(_han_conversations(spark, d), "text", **FOUND)
    rounded = [F.round(c, 6).alias(c) for c in ("cohesion", "left_entropy", "right_entropy")]
    return found.select("word", "n", *rounded)


DISCOVERED = f"""
WITH {HAN_SQL}, {WORDS_SQL}
SELECT word, n, round(cohesion, 6) AS cohesion, round(left_entropy, 6) AS left_entropy,
  round(right_entropy, 6) AS right_entropy FROM found
"""


def segmented(spark: SparkSession, d: str) -> DataFrame:
    """Turns cut by the words that were discovered in them, plainly and for search."""
    texts = _han_conversations(spark, d)
    words = materialize(discover.discover_words(texts, "text", **FOUND).select("word", "n"), "discovered")
    plain = text.tokenize(texts, "text", "plain", "dict", dictionary=words)
    both = text.tokenize(plain, "text", "search", "dict", True, dictionary=words)
    return both.select("conv_id", "turn", *[F.array_join(c, " ").alias(c) for c in ("plain", "search")])


SEGMENTED = f"""
WITH {HAN_SQL}, {WORDS_SQL},
size AS (SELECT sum(n)::DOUBLE AS total FROM found),
dict AS (SELECT word, length(word) AS s, round(1000 * ln(n / total))::BIGINT AS score FROM found, size),
every AS (SELECT DISTINCT r FROM run),
edge AS (
  SELECT r, i, s, score FROM (SELECT r, unnest(range(1, length(r) + 1)) AS i FROM every) p,
    (SELECT unnest([2, 3, 4]) AS z) JOIN dict ON s = z AND word = substr(r, i, z) WHERE i + z - 1 <= length(r)
  UNION ALL
  SELECT r, i, 1, round(1000 * ln(1 / total))::BIGINT
  FROM (SELECT r, unnest(range(1, length(r) + 1)) AS i FROM every), size),
ways AS (SELECT r, i, list({{'s': s, 'score': score}}) AS o FROM edge GROUP BY 1, 2),
-- from the end of a run: the best sums of the next four places, and the word that is best here
back AS (
  WITH RECURSIVE w(r, i, best, s) AS (
    SELECT r, length(r) + 1, [0::BIGINT], 0::BIGINT FROM every
    UNION ALL
    SELECT r, i, list_prepend(top.a, best)[1:4], top.b FROM (
      SELECT w.r, ways.i, w.best, list_reverse_sort(list_transform(ways.o,
        lambda x: {{'a': x.score + w.best[x.s], 'b': x.s::BIGINT}}))[1] AS top
      FROM w JOIN ways ON ways.r = w.r AND ways.i = w.i - 1))
  SELECT r, i, s FROM w WHERE s > 0),
forth AS (
  WITH RECURSIVE f(r, i, s) AS (
    SELECT r, i, s FROM back WHERE i = 1
    UNION ALL SELECT back.r, back.i, back.s FROM f JOIN back ON back.r = f.r AND back.i = f.i + f.s)
  SELECT * FROM f),
sub AS (
  SELECT r, i, g, i + o AS spot FROM (SELECT *, unnest(range(0, s - g + 1)) AS o FROM forth, (SELECT unnest([2, 3]) AS g) WHERE s > g)
  WHERE EXISTS (SELECT 1 FROM dict WHERE word = substr(r, i + o, g))),
token AS (
  SELECT r, i, 9 AS kind, i AS spot, substr(r, i, s) AS word FROM forth
  UNION ALL SELECT r, i, g, spot, substr(r, spot, g) FROM sub),
whole AS (
  SELECT conv_id, turn, string_agg(word, ' ' ORDER BY k, i) FILTER (kind = 9) AS plain,
    string_agg(word, ' ' ORDER BY k, i, kind, spot) AS search
  FROM run JOIN token USING (r) GROUP BY 1, 2)
SELECT conv_id, turn, coalesce(plain, '') AS plain, coalesce(search, '') AS search FROM han LEFT JOIN whole USING (conv_id, turn)
"""

QUERIES = {
    "q_discover_words": Query(discovered, DISCOVERED),
    "q_segment": Query(segmented, SEGMENTED),
    "q_tokenize": Query(tokens, TOKENIZE),
    "q_tokenize_pairs": Query(
        conversation_tokens,
        f"""SELECT conv_id, turn, array_to_string({_tokens_sql('text')}, ' ') AS joined
        FROM conversations""",
    ),
    "q_stopword_file": Query(stopword_file, STOPWORD_FILE),
    "q_stopwords": Query(stopwords, STOPWORDS),
    "q_vocab": Query(
        vocab_top,
        f"WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql('rn > 10 AND rn <= 5010', 10)} SELECT * FROM vocab",
    ),
    "q_vocab_whole": Query(
        vocab_whole, f"WITH {CUT}, {WORDS}, {COUNTS}, {_vocab_sql()} SELECT * FROM vocab"
    ),
    "q_tokens_wide": Query(wide_tokens, TOKENS_WIDE),
    "q_pad_sequence": Query(padded, PAD_SEQUENCE),
    "q_text_corpus": Query(corpus, TEXT_CORPUS),
    "q_text_corpus_lines": Query(corpus_index, CORPUS_INDEX),
    "q_prepare_text": Query(prepared, PREPARE_TEXT),
    "q_pool_embeddings": Query(pooled, POOL_EMBEDDINGS),
    "q_wide_text": Query(wide_text, WIDE_TEXT),
}
