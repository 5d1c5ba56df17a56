"""Tokens, vocabularies, training corpora and pooled embeddings."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.functions.scalar import blank_to, format_label_line, merge_text, strip_newlines
from marlspike.operators.ids import assign_ids, number_rows
from marlspike.operators.relate import join_ranked
from marlspike.operators.sample import balance_classes, split
from marlspike.session import at_most, localize, materialize
from marlspike.sources.parsers import format_id_line

MODES = ("unicode", "cjk_bigram", "dict")
# Size checks in front of driver-side lists; larger tables join instead.
MAX_STOPWORDS = 20_000
# Words of 64 bits in front of the join with a larger list.
STOP_SLOTS = 1 << 20
# Signs of runs whose lattices a task holds at once.
LATTICE_SIGNS = 1 << 17
# Signs of a dictionary's words that are sent to the tasks in one piece.
SHARD_SIGNS = 1 << 20
MAX_VOCABULARY = 200_000
MAX_EMBEDDINGS = 20_000
# Bytes of vectors that are sent to the tasks at once.
SHARD_BYTES = 32 << 20

WORD_GAP = r"[^\p{L}\p{N}]++"
RUN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"
HAN_RUN = r"^\p{IsHan}+$"
HAN = regex.compile(r"\p{Script=Han}")


def _grams(word: Column, size: int) -> Column:
    """Overlapping substrings of a word of at least that size."""
    starts = F.sequence(F.lit(1), F.length(word) - (size - 1))
    return F.transform(starts, lambda i: F.substring(word, i, F.lit(size)))


def _with_subwords(word: Column) -> Column:
    """Search form of a Han token: its 2-grams, its 3-grams, then itself."""
    size = F.length(word)
    none = F.array().cast("array<string>")
    long_han = word.rlike(HAN_RUN)
    two = F.when(long_han & (size > 2), _grams(word, 2)).otherwise(none)
    three = F.when(long_han & (size > 3), _grams(word, 3)).otherwise(none)
    return F.concat(two, three, F.array(word))


def token_column(col: str, mode: str = "unicode", search: bool = False) -> Column:
    """Tokens of the whole lower-cased text as a native expression.

    unicode splits at everything that is not a letter or digit; cjk_bigram
    also cuts Han runs into overlapping pairs. search adds sub-words of long
    Han tokens.
    """
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    if mode == "unicode":
        tokens = F.array_remove(F.split(text, WORD_GAP), "")
    elif mode == "cjk_bigram":
        runs = F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(0))
        cut = F.transform(
            runs,
            lambda r: F.when(r.rlike(HAN_RUN) & (F.length(r) > 1), _grams(r, 2)).otherwise(
                F.array(r)
            ),
        )
        tokens = F.flatten(cut)
    else:
        raise ValueError("token_column knows 'unicode' and 'cjk_bigram'")
    return F.flatten(F.transform(tokens, _with_subwords)) if search else tokens


def tokenize(
    df: DataFrame,
    col: str,
    out: str = "tokens",
    mode: str = "unicode",
    search: bool = False,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Add an array of tokens. mode="dict" cuts Han runs by a dictionary table (word and,
    as a second column, how often it occurs; 1 without it); other text is cut as in
    unicode mode.

    All dictionary words of a run make a lattice; of its paths the one with the largest
    sum of log frequencies is taken, at a tie the one with the longer first word. A sign
    in no word counts as occurring once. search adds the dictionary words of two and
    three signs inside a longer token. A dictionary of any size is sent in shards of
    bounded size, and a task matches a batch against one after the other.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if mode != "dict":
        return df.withColumn(out, token_column(col, mode, search))
    if dictionary is None:
        raise ValueError("dict mode needs a dictionary table")
    runs = F.regexp_extract_all(
        F.lower(F.coalesce(F.col(col), F.lit(""))), F.lit(f"({RUN})"), F.lit(0)
    )
    shards, unknown = _shards(dictionary)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from _tokens(batch, shards, unknown, search)

    return df.withColumn(out, cut(runs))


def _tokens(batch: pa.Array, shards: Sequence, unknown: int, search: bool) -> Iterator[pa.Array]:
    """Rows of runs to rows of tokens, of about LATTICE_SIGNS signs at once: what is made of
    a part of the rows is gone before the next, however many rows a batch has."""
    signs = np.zeros(len(batch) + 1, np.int64)
    sizes = pc.utf8_length(batch.flatten()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    signs[1:] = np.concatenate([[0], np.cumsum(sizes)])[ends]
    part = signs[:-1] // LATTICE_SIGNS
    edges = np.flatnonzero(np.diff(part)) + 1
    for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
        rows = batch.slice(start, stop - start).to_pylist()
        han = dict.fromkeys(r for runs in rows for r in runs or () if HAN.match(r))  # the script decides, as in HAN_RUN
        ways = {}
        for some in _portions(list(han)):
            found = _lattices(some, shards)
            ways |= {run: _best_path(run, words, unknown, search) for run, words in found.items()}
        yield pa.array([[t for r in runs or () for t in ways.get(r, (r,))] for runs in rows], pa.list_(pa.string()))


def _score(often: Column, total: int) -> Column:
    """Log frequency in thousandths: whole numbers add up alike in any order."""
    return F.round(1000 * F.log(often / F.lit(float(total)))).cast("bigint")


def _shards(dictionary: DataFrame) -> tuple[list, int]:
    """(broadcast shards of (word, score), the score of a sign in no word). A shard holds
    about SHARD_SIGNS signs, by a hash of the word."""
    names = dictionary.columns
    often = F.greatest(F.col(names[1]).cast("double"), F.lit(1.0)) if len(names) > 1 else F.lit(1.0)
    word = F.lower(F.col(names[0]))
    words = dictionary.select(word.alias("word"), F.coalesce(often, F.lit(1.0)).alias("often"))
    words = words.where(F.length("word") > 0).groupBy("word").agg(F.max("often").alias("often"))
    words = materialize(words, "dictionary")
    size = words.agg(F.sum(F.length("word")).alias("signs"), F.sum("often").alias("total")).first()
    total = size["total"] or 1.0
    count = max(1, math.ceil((size["signs"] or 0) / SHARD_SIGNS))
    context = dictionary.sparkSession.sparkContext
    shard = F.pmod(F.xxhash64("word"), F.lit(count))
    held = words.select("word", _score(F.col("often"), total).alias("score"), shard.alias("shard"))
    parts = []
    for i in range(count):
        own = held.where(F.col("shard") == i).select("word", "score").toPandas()
        parts.append(context.broadcast((i, list(own["word"]), list(own["score"]))))
    return parts, round(1000 * math.log(1.0 / total))


@lru_cache(maxsize=2)
def _automaton(shard):
    """The trie of a shard's words with failure links; kept for the latest shards."""
    import ahocorasick

    trie = ahocorasick.Automaton()
    _, words, scores = shard.value
    for word, score in zip(words, scores):
        trie.add_word(word, (len(word), int(score)))
    trie.make_automaton()
    return trie


def _portions(runs: Sequence[str]) -> Iterator[list[str]]:
    """runs in portions of about LATTICE_SIGNS signs."""
    part, signs = [], 0
    for run in runs:
        part.append(run)
        signs += len(run)
        if signs >= LATTICE_SIGNS:
            yield part
            part, signs = [], 0
    if part:
        yield part


def _lattices(runs: Sequence[str], shards: Sequence) -> dict[str, list[dict[int, int]]]:
    """For each run and place the dictionary words that start there: size to score."""
    found: dict[str, list[dict[int, int]]] = {run: [{} for _ in run] for run in runs}
    for shard in shards:
        trie = _automaton(shard)
        if len(trie):
            for run, words in found.items():
                for end, (size, score) in trie.iter(run):
                    words[end - size + 1][size] = score
    return found


def _best_path(run: str, words: list[dict[int, int]], unknown: int, search: bool) -> list[str]:
    n = len(run)
    best, step = [0] * (n + 1), [1] * n
    for at in range(n - 1, -1, -1):
        ways = words[at] if 1 in words[at] else {1: unknown, **words[at]}
        best[at], step[at] = max((score + best[at + size], size) for size, score in ways.items())
    tokens: list[str] = []
    at = 0
    while at < n:
        size = step[at]
        if search:
            for gram in (2, 3):
                if size > gram:
                    starts = range(at, at + size - gram + 1)
                    tokens.extend(run[i : i + gram] for i in starts if gram in words[i])
        tokens.append(run[at : at + size])
        at += size
    return tokens


def remove_stopwords(
    df: DataFrame, tokens: str, stopwords: DataFrame, out: str | None = None
) -> DataFrame:
    """Drop exact, case-sensitive matches, keeping order and repeats.

    A checked list becomes a hash-set predicate inside the row, without a
    shuffle. With a larger one the places of the stop words are found by a join and cut
    out of the row, by a number written beside the rows.
    """
    out = out or tokens
    word = stopwords.columns[0]
    held, small = localize(stopwords.select(word).where(F.col(word).isNotNull()), MAX_STOPWORDS)
    if small:
        listed = [r[0] for r in held.collect()]
        if not listed:
            return df.withColumn(out, F.col(tokens))
        return df.withColumn(out, F.filter(tokens, lambda t: ~t.isin(listed)))
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    return _without(rows, tokens, stopwords, "_row", out).drop("_row")


def _stop_places(rows: DataFrame, tokens: str, stopwords: DataFrame, key: str) -> DataFrame:
    """(key, _pos, _token) of the tokens that are stop words. Tokens are first looked up in
    bits set by a hash of the stop words (STOP_SLOTS times 64, whatever their number), which
    are sent to the tasks, so that of the others next to none is moved."""
    word = F.col(stopwords.columns[0])
    listed = stopwords.select(word.alias("_token")).where(word.isNotNull()).distinct()
    code = F.xxhash64("_token")
    slot, bit = F.pmod(code, F.lit(STOP_SLOTS)), F.shiftrightunsigned(code, 58).cast("int")
    one = F.lit(1).cast("bigint")
    bits = listed.select(slot.alias("_slot"), F.call_function("shiftleft", one, bit).alias("_bit"))
    bits = bits.groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    places = rows.select(key, F.posexplode_outer(tokens).alias("_pos", "_token")).where(F.col("_token").isNotNull())
    met = places.withColumn("_slot", slot).join(F.broadcast(bits), "_slot").where(F.getbit("_bits", bit) == 1)
    return met.select(key, "_pos", "_token").join(listed, "_token", "left_semi")


def _without(df: DataFrame, tokens: str, stopwords: DataFrame, key: str, out: str) -> DataFrame:
    places = _stop_places(df, tokens, stopwords, key)
    drop = places.groupBy(key).agg(F.sort_array(F.collect_list("_pos")).alias("_drop"))
    # the stretches between the places that go
    c, n = F.col(tokens), F.size("_drop")

    def stretch(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("_drop", i - 1) + 1)
        end = F.coalesce(F.get("_drop", i), F.size(c))
        return F.slice(c, start + 1, end - start)

    left = F.when(F.col("_drop").isNull(), c).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), n), stretch)))
    joined = df.join(drop, key, "left").withColumn(out, F.array_compact(left))
    return joined.select(*df.columns, *([] if out in df.columns else [out]))


def _one_per_row(df: DataFrame, tokens: str, *kept: str) -> DataFrame:
    """One row per token. The outer form is used on purpose: for the inner one
    Spark infers a filter on the array size and pushes it below the projection
    that makes the tokens, which would cut every text twice."""
    rows = df.select(*kept, F.explode_outer(tokens).alias("token"))
    return rows.where(F.col("token").isNotNull())


def count_tokens(df: DataFrame, tokens: str) -> DataFrame:
    """(token, count). Counted inside each task first, so a token that fills a
    large share of the text costs one row per task."""
    rows = _one_per_row(df, tokens)
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def build_vocab(
    df: DataFrame, tokens: str, max_words: int | None = None, remove_top_n: int = 0
) -> DataFrame:
    """(token, count, idx): 1-based index by falling count, ties by token.

    The remove_top_n most frequent tokens are left out, then at most max_words
    kept; without max_words the vocabulary holds every token.
    """
    counts = count_tokens(df, tokens)
    if max_words is None or max_words + remove_top_n > MAX_VOCABULARY:
        ranked = number_rows(counts, [F.desc("count"), F.asc("token")], "rn")
        if max_words is not None:
            ranked = ranked.where(F.col("rn") <= max_words + remove_top_n)
    else:
        # A top-k of at most MAX_VOCABULARY rows, in one task; a longer one is numbered above.
        top = counts.orderBy(F.desc("count"), "token").limit(max_words + remove_top_n)
        order = Window.orderBy(F.desc("count"), "token")
        ranked = top.withColumn("rn", F.row_number().over(order))
    idx = (F.col("rn") - remove_top_n).cast("int")
    return ranked.where(F.col("rn") > remove_top_n).select("token", "count", idx.alias("idx"))


def tokens_to_wide(
    df: DataFrame, key: str, tokens: str, vocab: DataFrame, n: int = 40, prefix: str = "wide"
) -> DataFrame:
    """(key, wide0..wide{n-1}): vocabulary index of each of the first n tokens,
    0 past the end or out of vocabulary. key identifies a row.

    The exploded rows of one key are next to each other, so the aggregate
    folds them back inside the task and shuffles one narrow row per key.
    """
    placed = df.select(key, F.posexplode_outer(F.slice(tokens, 1, n)).alias("_pos", "token"))
    indexed = join_ranked(placed, vocab.select("token", "idx"), "token", "idx", MAX_VOCABULARY)
    slots = [
        F.coalesce(F.max(F.when(F.col("_pos") == i, F.col("idx"))), F.lit(0)).alias(f"{prefix}{i}")
        for i in range(n)
    ]
    return indexed.groupBy(key).agg(*slots)


def tokens_to_ids(
    df: DataFrame, key: str, tokens: str, vocab: DataFrame, out: str = "idx"
) -> DataFrame:
    """(key, array of vocabulary indices in token order); unknown tokens are
    dropped, as a word index does."""
    placed = df.select(key, F.posexplode_outer(tokens).alias("_pos", "token"))
    indexed = join_ranked(placed, vocab.select("token", "idx"), "token", "idx", MAX_VOCABULARY)
    ordered = F.sort_array(
        F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("_pos", "idx")))
    )
    return indexed.groupBy(key).agg(ordered["idx"].alias(out))


def pad_sequence(col: str | Column, n: int, trunc: str = "pre", pad: int = 0) -> Column:
    """An id array of exactly n items: filled with pad at the end, cut at the
    front (trunc="pre") or at the end ("post")."""
    c = F.col(col) if isinstance(col, str) else col
    if trunc == "pre":
        c = F.slice(c, F.greatest(F.size(c) - n + 1, F.lit(1)), F.lit(n))
    elif trunc != "post":
        raise ValueError("trunc is 'pre' or 'post'")
    return F.slice(F.concat(c, F.array_repeat(F.lit(pad), n)), 1, n)


def pool_embeddings(
    df: DataFrame, key: str, tokens: str, table: DataFrame, dim: int, out: str = "pooled"
) -> DataFrame:
    """(key, mean embedding of the known tokens, number of them).

    The dimensions are summed as columns, not exploded into rows. The tokens of a key stay
    in one task and leave it as one row, next to a checked table or next to each shard of a
    larger one, of about SHARD_BYTES, that is sent to the tasks; the tokens are then written once.
    """
    shards = 1 if at_most(table, MAX_EMBEDDINGS) else math.ceil(table.count() * 8 * dim / SHARD_BYTES)
    items = [F.get("embedding", F.lit(i)).cast("double").alias(f"_e{i}") for i in range(dim)]
    held = table.select("token", *items)
    if shards > 1:
        df = materialize(df.select(key, tokens), "tokens")
    found = _one_per_row(df, tokens, key)
    rows = None
    for i in range(shards):
        own = held.where(F.pmod(F.xxhash64("token"), F.lit(shards)) == i) if shards > 1 else held
        met = found.join(F.broadcast(own), "token")
        rows = met if rows is None else rows.unionByName(met)
    sums = [F.sum(f"_e{i}").alias(f"_s{i}") for i in range(dim)]
    summed = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_tokens"), *sums)
    mean = F.array(*[F.col(f"_s{i}") / F.col("n_tokens") for i in range(dim)])
    return summed.select(key, mean.alias(out), "n_tokens")


def labelled_lines(
    df: DataFrame, text: str = "text", label: str = "label", **tokenizing
) -> DataFrame:
    """Add `line`: `__label__<k> tok tok ...`, empty where there is no token."""
    cut = tokenize(df, text, "_tokens", **tokenizing)
    joined = strip_newlines(F.array_join("_tokens", " "))
    return cut.withColumn("line", format_label_line(label, joined)).drop("_tokens")


def build_text_corpus(
    df: DataFrame,
    id_col: str = "id",
    name: str = "company_name",
    text: str = "text",
    label: str = "label",
    train: float = 0.75,
    seed: int = 0,
    **tokenizing,
) -> dict[str, DataFrame]:
    """The parts of a text training job: all lines, the id index, and class
    balanced, disjoint train and valid lines. Empty lines are not trained on.

    Lines are written once: every part is read from them, so that text is cut
    into tokens once.
    """
    cut = labelled_lines(df, text, label, **tokenizing)
    lines = materialize(cut.select(id_col, name, label, "line"), "lines")
    filled = lines.where(F.col("line") != "")
    balanced = balance_classes(filled, label, id_col, seed)
    parts = split(balanced, {"train": train, "valid": 1.0 - train}, id_col, seed + 1)
    return {
        "lines": lines,
        "index": lines.select(format_id_line(id_col, name).alias("value")),
        "all": lines.select(F.col("line").alias("value")),
        "train": parts["train"],
        "valid": parts["valid"],
    }


def prepare_text(
    base: DataFrame,
    texts: DataFrame,
    key: str,
    text_cols: Sequence[str],
    label: str,
) -> DataFrame:
    """(key, text, label, id): text columns merged and joined to the labelled
    rows; a row without text has empty text. Ids follow the key."""
    merged = texts.select(key, merge_text(list(text_cols)).alias("text"))
    joined = base.select(key, F.col(label).alias("label")).join(merged, key, "left")
    filled = joined.select(key, blank_to("text", "").alias("text"), "label")
    return assign_ids(filled, key, as_string=True)
