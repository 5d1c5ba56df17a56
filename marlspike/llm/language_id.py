"""Word-level language identification with a linear-chain random field.

Each word of a text gets a probability for every language by forward-backward.
Its score for a language is the sum of weights of hashed features: prefixes and
suffixes of up to four characters, character n-grams of one to three with the
word's ends marked, and membership in each language's lexicon (its most
characteristic words). Transition weights between neighbouring words are learned
with them, from sequences in which stretches of texts in different languages
alternate, so a passage in another language is labelled as such.

Training uses a bounded sample: at most `per_language` texts of each language,
chosen by a hash of their id. It is dealt over `shards` tasks; each maximises the
likelihood of its own part by adaptive gradient steps, and Spark averages their
weights. What is broadcast are these averages: at most 2**BITS rows of one float
a language, the lexicons of at most LEXICON words a language, and the character
trigrams that the sample has in each language.

All texts of a batch form one chain that is cut into equal blocks: the blocks'
transfer matrices are computed side by side, messages pass between blocks, and a
text's first word starts afresh. The result is exact, whatever the lengths.

A text's language is the one with the largest share of word probabilities, and
that share is its score. Defined results: a null or empty text, or one without a
letter, is `und` with score 0. Ties go to the first language by name. With no
labelled text at all, every text is `und`. Further columns are ignored.

The score compares learned languages with each other: shares add up to 1, so it says
nothing about a text in none of them. keep_identified() therefore asks for evidence
that does not depend on their number. A word is supported if at least SUPPORT of its
trigrams occur in the sample of the language that the field gives it (digits count as
one character, punctuation as a word's end). A text is dropped if the share of its
lettered words that are supported is below `least` beyond doubt, that is with the
upper end of Wilson's interval; less than four words are never enough to drop a text.
A language that is written much like a learned one may pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import hash_strings, id_remainder, returning, slices

BITS = 17
LEXICON = 2000
PER_LANGUAGE = 250
SHARDS = 6
EPOCHS = 4
BLOCK = 128  # words of a chain that are handled one after the other
UNDETERMINED = "und"
SUPPORT = 2 / 3  # of a word's trigrams
LEAST = 0.5  # of a text's words that are supported
DOUBT = 1.96  # standard deviations

_MARK = 1  # stands before and after each word


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # 2**BITS rows of features, a column for each language
    lexicon: np.ndarray  # sorted word hashes
    member: np.ndarray  # their languages, a row of 0 and 1 for each word
    lexicon_weights: np.ndarray  # language of the lexicon by language of the label
    transitions: np.ndarray
    known: np.ndarray  # sorted trigrams
    known_member: np.ndarray  # their languages, as in member


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words) of lower-case words; a null text has none."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return kept[starts], flat.filter(real)


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, feature) pairs, and which words have a letter."""
    letters = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
    joined = chr(_MARK) + chr(_MARK).join(words.to_pylist()) + chr(_MARK)
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.flatnonzero(code == _MARK)
    if len(ends) != len(words) + 1:  # a text holds the mark itself
        words = pc.replace_substring(words, chr(_MARK), " ")
        return word_features(words)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(words)), sizes)
    indexes, features = [], []

    def add(index, value, kind):
        value = (value + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        indexes.append(index)
        features.append(((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int32))

    big = np.uint64(1_000_003)
    body = code[1:]  # position p belongs to owner[p]; the last of a word is a mark
    before = code[:-1]
    after = np.concatenate([code[2:], [np.uint64(_MARK)]]).astype(np.uint64)
    inside = body != _MARK
    add(owner[inside], body[inside], 1)
    add(owner, before * big + body, 2)
    add(owner[inside], (before * big + body)[inside] * big + after[inside], 3)
    first, last = ends[:-1] + 1, ends[1:] - 1
    length = sizes - 1
    head = np.zeros(len(words), np.uint64)
    tail = np.zeros(len(words), np.uint64)
    number = np.arange(len(words))
    for n in range(1, 5):
        long = length >= n
        head[long] = head[long] * big + code[first[long] + n - 1]
        tail[long] = tail[long] * big + code[last[long] - n + 1]
        add(number[long], head[long], 10 + n)
        add(number[long], tail[long], 20 + n)
    index, feature = np.concatenate(indexes), np.concatenate(features)
    keep = letters[index]
    return index[keep], feature[keep], letters


def word_trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word index, trigram) pairs, one for each character that is not punctuation."""
    plain = pc.replace_substring_regex(words, r"\pN", "0")
    plain = pc.replace_substring_regex(plain, r"[\pP\pS]", " ")
    joined = "\n" + "\n".join(plain.to_pylist()) + "\n"  # words hold no white space
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    line = code == ord("\n")
    owner = np.cumsum(line) - 1
    code[line | (code == ord(" "))] = _MARK
    spot = np.flatnonzero(code[1:-1] != _MARK) + 1
    bits = np.uint64(21)  # of a code point
    return owner[spot], (code[spot - 1] << bits | code[spot]) << bits | code[spot + 1]


def lexicon_rows(lexicon: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of hashes in the lexicon."""
    if len(lexicon) == 0:
        return np.zeros(len(hashes), int), np.zeros(len(hashes), bool)
    place = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return place, lexicon[place] == hashes


def forward_backward(scores: np.ndarray, transitions: np.ndarray, fresh: np.ndarray, expect: bool = True):
    """(label probabilities by word, expected transitions) of chains laid end to end.

    scores: words by labels; fresh: whether a word starts a chain; expect: whether the
    transitions are wanted (else None), which take labels by labels numbers a word.
    """
    words, labels = scores.shape
    blocks = -(-words // BLOCK)
    space = blocks * BLOCK - words
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    emit = np.concatenate([emit, np.ones((space, labels))]).reshape(blocks, BLOCK, labels)
    start = np.concatenate([fresh, np.ones(space, bool)]).reshape(blocks, BLOCK)
    step = np.exp(transitions - transitions.max())
    flat = np.ones((labels, labels))

    def advance(vectors, t):
        """Rows of messages (blocks, n, labels) over the step into word t."""
        moved = np.where(start[:, t, None, None], vectors @ flat, vectors @ step)
        moved *= emit[:, t, None, :]
        return moved / moved.sum(axis=(1, 2), keepdims=True)

    transfer = np.broadcast_to(np.eye(labels), (blocks, labels, labels)).copy()
    for t in range(BLOCK):
        transfer = advance(transfer, t)
    entering = np.empty((blocks, labels))
    message = np.ones(labels)
    for k in range(blocks):
        entering[k] = message
        message = message @ transfer[k]
        message = message / message.sum()
    leaving = np.empty((blocks, labels))
    message = np.ones(labels)
    for k in range(blocks - 1, -1, -1):
        leaving[k] = message
        message = transfer[k] @ message
        message = message / message.sum()
    forward = np.empty((blocks, BLOCK, labels))
    current = entering[:, None, :]
    for t in range(BLOCK):
        current = advance(current, t)
        forward[:, t] = current[:, 0]
    backward = np.empty((blocks, BLOCK, labels))
    current = leaving
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = current
        inward = current * emit[:, t]
        current = np.where(start[:, t, None], inward @ flat, inward @ step.T)
        current = current / current.sum(axis=1, keepdims=True)
    found = forward * backward
    found /= found.sum(axis=2, keepdims=True)
    if not expect:
        return found.reshape(-1, labels)[:words], None
    chained = ~start
    previous = np.concatenate([entering[:, None, :], forward[:, :-1]], axis=1)[chained]
    pair = previous[:, :, None] * step[None] * (emit * backward)[chained][:, None, :]
    pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
    return found.reshape(-1, labels)[:words], pair.sum(axis=0)


def word_scores(model: Model, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(scores of distinct words by language, which of them have a letter)."""
    index, feature, letters = word_features(words)
    scores = np.stack(
        [np.bincount(index, model.weights[feature, k], len(words)) for k in range(len(model.languages))], axis=1
    ).astype(float)
    place, found = lexicon_rows(model.lexicon, hash_strings(words))
    found &= letters
    scores[found] += model.member[place[found]] @ model.lexicon_weights
    return scores, letters


def word_support(model: Model, words: pa.Array) -> np.ndarray:
    """Whether each word has SUPPORT of its trigrams in each language."""
    owner, trigram = word_trigrams(words)
    place, found = lexicon_rows(model.known, trigram)
    owner_found, place = owner[found], place[found]
    total = np.bincount(owner, minlength=len(words))
    hits = [np.bincount(owner_found, model.known_member[place, k], len(words)) for k in range(len(model.languages))]
    return np.stack(hits, axis=1) >= np.maximum(SUPPORT * total, 1)[:, None] - 1e-9


def judge(model: Model, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, score, words with a letter) of each text."""
    return weigh(model, texts)[:3]


def weigh(model: Model, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """What judge() returns, and how many of the words with a letter are supported."""
    offsets, words = split_words(texts)
    count = len(offsets) - 1
    labels = len(model.languages)
    share = np.zeros((count, labels))
    real = np.zeros(count, np.int64)
    backed = np.zeros(count)
    if len(words) and labels:
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy()
        scores, letters = word_scores(model, coded.dictionary)
        fresh = np.zeros(len(code), bool)
        fresh[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        found, _ = forward_backward(scores[code], model.transitions, fresh, expect=False)
        counted = letters[code]
        owner = np.repeat(np.arange(count), np.diff(offsets))[counted]
        for k in range(labels):
            share[:, k] = np.bincount(owner, found[counted, k], count)
        real = np.bincount(owner, minlength=count)
        support = word_support(model, coded.dictionary)[code[counted]]
        backed = np.bincount(owner, (found[counted] * support).sum(axis=1), count)
    score = np.where(real > 0, share.max(axis=1, initial=0) / np.maximum(real, 1), 0.0)
    best = share.argmax(axis=1) if labels else np.zeros(count, int)
    names = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, real)]
    return names, np.minimum(score, 1.0), real, backed


def upper_share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The upper end of Wilson's interval for a share of whole; 1 of nothing."""
    whole = np.maximum(whole, 1e-9)
    share, spread = part / whole, DOUBT**2 / whole
    return (share + spread / 2 + np.sqrt(spread * (share * (1 - share) + spread / 4).clip(0))) / (1 + spread)


def _spliced(lengths: np.ndarray, labels: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of words in which stretches of the texts alternate.

    (positions, labels, fresh): texts are cut into stretches of 10 to 60 words,
    shuffled, and every eight stretches make a sequence.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    pieces = []
    for start, length, label in zip(starts, lengths, labels):
        at = 0
        while at < length:
            take = int(rng.integers(10, 61))
            pieces.append((start + at, min(take, length - at), label))
            at += take
    rng.shuffle(pieces)
    position = np.concatenate([np.arange(s, s + n) for s, n, _ in pieces])
    label = np.concatenate([np.full(int(n), k) for _, n, k in pieces]).astype(int)
    fresh = np.zeros(len(position), bool)
    fresh[np.cumsum([0] + [int(n) for _, n, _ in pieces])[:-1][::8]] = True
    return position, label, fresh


def fit_shard(texts: pa.Array, langs: list[str], languages: list[str], seed: int) -> Model:
    """The random field that fits these texts, by adaptive gradient steps."""
    rng = np.random.default_rng(seed)
    count = len(languages)
    offsets, words = split_words(texts)
    coded = words.dictionary_encode()
    code, names = coded.indices.to_numpy(), coded.dictionary
    index, feature, letters = word_features(names)
    order = np.argsort(index, kind="stable")
    index, feature = index[order], feature[order]
    edge = np.searchsorted(index, np.arange(len(names) + 1))
    lengths = np.diff(offsets)
    truth = np.array([languages.index(x) for x in langs], int)
    owner = np.repeat(truth, lengths)
    table = np.stack([np.bincount(code[owner == k], minlength=len(names)) for k in range(count)], axis=1)
    known = table * letters[:, None]
    rate = (known + 0.05) / (known.sum(axis=0) + 1)
    lift = known * np.log(rate / rate.mean(axis=1, keepdims=True))
    hashes = hash_strings(names)
    chosen = {int(i): None for k in range(count) for i in np.argsort(-lift[:, k], kind="stable")[:LEXICON] if lift[i, k] > 0}
    picked = np.array(list(chosen), int)
    picked = picked[np.argsort(hashes[picked])]
    member = (lift[picked] > 0).astype(float)
    lexicon = hashes[picked]
    row = np.full(len(names), -1)
    row[picked] = np.arange(len(picked))
    member_of = np.zeros((len(names), count))
    member_of[picked] = member

    weights = np.zeros((2**BITS, count))
    lex = np.zeros((count, count))
    move = np.zeros((count, count))
    squares = [np.full_like(x, 1e-6) for x in (weights, lex, move)]
    for _ in range(EPOCHS):
        position, label, fresh = _spliced(lengths, truth, rng)
        cuts = np.flatnonzero(fresh)[::16]
        for lo, hi in zip(cuts, [*cuts[1:], len(position)]):
            token = code[position[lo:hi]]
            distinct, back = np.unique(token, return_inverse=True)
            sizes = edge[distinct + 1] - edge[distinct]
            spots = np.repeat(edge[distinct] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            kinds = feature[spots]
            at = np.repeat(np.arange(len(distinct)), sizes)
            scores = np.stack([np.bincount(at, weights[kinds, k], len(distinct)) for k in range(count)], axis=1)
            scores += member_of[distinct] @ lex
            gold, first = label[lo:hi], fresh[lo:hi]
            found, pairs = forward_backward(scores[back], move, first)
            error = -found
            error[np.arange(len(gold)), gold] += 1
            by_word = np.stack([np.bincount(back, error[:, k], len(distinct)) for k in range(count)], axis=1)
            used, place = np.unique(kinds, return_inverse=True)
            grad = np.stack([np.bincount(place, by_word[at, k], len(used)) for k in range(count)], axis=1)
            size = len(gold)
            grad = grad / size - 1e-6 * weights[used]
            squares[0][used] += grad**2
            weights[used] += 0.1 * grad / np.sqrt(squares[0][used])
            grad = member_of[distinct].T @ by_word / size - 1e-6 * lex
            squares[1] += grad**2
            lex += 0.1 * grad / np.sqrt(squares[1])
            seen = np.zeros_like(move)
            np.add.at(seen, (gold[:-1][~first[1:]], gold[1:][~first[1:]]), 1)
            grad = (seen - pairs) / size - 1e-6 * move
            squares[2] += grad**2
            move += 0.1 * grad / np.sqrt(squares[2])
    owner, trigram = word_trigrams(names)
    known, back = np.unique(trigram, return_inverse=True)
    has = np.zeros((len(known), count))
    for k in range(count):
        has[back[(table[:, k] > 0)[owner]], k] = 1
    return Model(languages, weights, lexicon, member, lex, move, known, has)


def training_sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most per_language ids of each language, by a hash of the id, with their texts
    (doc, text, lang).

    The ids are chosen from rows without texts, and languages are thinned by their counts
    first, so few rows reach the ranking; the chosen ids are broadcast to the texts."""
    held = labelled.filter(F.col("lang").isNotNull() & F.col("doc").isNotNull())
    named = held.filter(F.col("text").rlike(r"\p{L}")).select("doc", "lang").distinct()
    order = F.xxhash64("doc", F.lit(11))
    counts = held.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    part = (order.bitwiseAND(F.lit(2**31 - 1)) / F.lit(float(2**31))) * F.col("rows")
    near = named.join(counts, "lang").filter(part < 4.0 * per_language).withColumn("order", order)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc"))
    chosen = near.withColumn("place", place).filter(F.col("place") <= per_language).select("doc", "lang")
    return held.join(F.broadcast(chosen), ["doc", "lang"]).select("doc", "text", "lang")


def train(
    labelled: DataFrame,
    per_language: int = PER_LANGUAGE,
    shards: int = SHARDS,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
) -> Model:
    """A model of the languages in labelled; texts are dealt over `shards` fits
    whose weights are averaged."""
    rows = labelled.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sample = training_sample(rows, per_language).withColumn(
        "shard", F.pmod(F.xxhash64("doc", "lang", F.lit(3)), F.lit(shards))
    )
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    count = len(languages)

    def fit(key, table):
        table = table.combine_chunks().sort_by([("doc", "ascending"), ("text", "ascending")])
        model = fit_shard(
            table.column("text").combine_chunks(), table.column("lang").to_pylist(), languages, key[0].as_py()
        )
        used = np.flatnonzero(np.abs(model.weights).sum(axis=1))
        parts = [
            (0, used, model.weights[used]),
            (1, np.arange(count), model.lexicon_weights),
            (2, np.arange(count), model.transitions),
            (3, model.lexicon.view(np.int64), model.member),
            (4, model.known.view(np.int64), model.known_member),
        ]
        return pa.table(
            {
                "kind": pa.array(np.concatenate([np.full(len(p), k) for k, p, _ in parts]), pa.int32()),
                "place": pa.array(np.concatenate([p for _, p, _ in parts]).astype(np.int64)),
                "value": pa.array(np.concatenate([v for _, _, v in parts]).tolist(), pa.list_(pa.float64())),
            }
        )

    fitted = sample.groupBy("shard").applyInArrow(fit, "kind int, place long, value array<double>")
    sums = fitted.groupBy("kind", "place").agg(
        *[F.sum(F.col("value")[k]).alias(f"v{k}") for k in range(count)], F.max("kind").alias("same")
    )
    found = sums.toArrow() if count else None
    weights = np.zeros((2**BITS, count), np.float32)
    small = [np.zeros((count, count)) for _ in range(2)]
    lexicon, member = np.zeros(0, np.uint64), np.zeros((0, count))
    known, known_member = lexicon, member
    if found is not None and found.num_rows:
        kind, place = found.column("kind").to_numpy(), found.column("place").to_numpy()
        value = np.stack([found.column(f"v{k}").to_numpy() for k in range(count)], axis=1)
        weights[place[kind == 0]] = value[kind == 0] / shards
        for k in (0, 1):
            small[k][place[kind == k + 1]] = value[kind == k + 1] / shards

        def listed(which):
            order = np.argsort(place[kind == which].view(np.uint64))
            return place[kind == which].view(np.uint64)[order], (value[kind == which][order] > 0).astype(float)

        lexicon, member = listed(3)
        known, known_member = listed(4)
    return Model(languages, weights, lexicon, member, small[0], small[1], known, known_member)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, lang_pred, score, n_words) for each row of docs, judged by its text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2_000_000):
                names, score, real = judge(sent.value, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(names), pa.array(score), pa.array(real)],
                    ["doc", "lang_pred", "score", "n_words"],
                )

    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(returning(run), f"doc {kind}, lang_pred string, score double, n_words long")


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST, text: str = "text") -> DataFrame:
    """docs, all columns, without texts that are `und` or whose share of supported words
    is below `least` beyond doubt."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            plain = pa.RecordBatch.from_arrays([batch.column(column), pa.array(np.arange(batch.num_rows))], ["text", "row"])
            for part in slices(plain, "text", 2_000_000):
                _, _, real, backed = weigh(sent.value, part.column("text"))
                rows = part.column("row").filter(pa.array((real > 0) & (upper_share(backed, real) >= least)))
                yield batch.take(rows)

    return docs.mapInArrow(returning(run), docs.schema)


def held_out(key: Column) -> Column:
    """Whether the id's remainder is 2; a null id is not held out."""
    return F.coalesce(id_remainder(key, 4) == 2, F.lit(False))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()))
    found = predict(docs, model)
    return found.select(
        F.col("doc").alias("doc_id"),
        held_out(F.col("doc")).alias("held_out"),
        "lang_pred",
        "score",
        "n_words",
    )


QUERIES = {"op1_language_id": (op1_language_id, None)}
