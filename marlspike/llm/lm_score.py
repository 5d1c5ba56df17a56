"""Language-model scores from a log-frequency Bloom filter.

Tokens are the words of a text, A-Z in lower case, and one end. Word and bigram
counts of the training texts are quantised to 1 + floor(log2(count)) levels, and
an n-gram is entered into a Bloom filter once for each level up to its own. To look
a count up, level after level is probed until one is missing: the last level found
stands for the middle of its counts. All n-grams are entered, those that occur once too.

The filter is built in segments by the hash of the n-gram; each is as large as its
entries ask for (BITS bits an entry and level). A filter that certainly takes at most
`most_bytes` is broadcast to the workers. Otherwise the n-grams move to the segments:
texts are written once as packs of token codes, each pack sends its distinct n-grams, with
their training counts, to the part of the filter they belong to, a part is filled and probed in
one place, and the levels go back to the pack, which scores its texts. Texts are read as
often, and an n-gram moves as often, whatever the size of the filter. Both ways give the
same scores.

    p(w | h) = (f(h w) + MU * p(w)) / (f(h) + MU)
    p(w) = (f(w) + 0.1) / (N + 0.1 (V + 1)),  f: looked up, N, V: tokens, exactly

The base score needs exact counts. Words move to the parts as strings and are counted there.
With a broadcast filter the counts of the most frequent words are broadcast too, at most
`head` words of at most HEAD_BYTES altogether; all other words of a text are joined with
the counts.

Defined results: a null text counts as empty and consists of its end. A table without
rows gives no rows. Rows that
share an id are scored each. Without training texts N and V are 0 and every token
has the probability 1. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import ascii_words, hash_strings, id_remainder, mix, returning, slices
from marlspike.session import materialize

ALPHA = 0.1
MU = 300.0
BITS, PROBES = 14, 6  # of the filter for each entry and level: about one false hit in 500
HEAD, HEAD_BYTES = 1 << 18, 16 << 20
LONG = 4096
SEGMENT = 1 << 18  # training tokens for which a segment is laid out
MOST_BYTES = 64 << 20
PACK = 8_000_000  # bytes of text in a pack
PART = 2  # a part has 2**PART segments
GATHERED = 1 << 20  # n-grams that a task counts before it passes them on
END = np.uint64(0x2545F4914F6CDD1D)
ENDS = b" "  # stands for the end among words, which hold no space
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray, np.ndarray]:
    """(tokens, ends, words, offsets): the hashes of all tokens, the place of each text's
    end among them, and the words with each text's offsets."""
    offsets, flat = ascii_words(texts)
    coded = flat.dictionary_encode()
    hashes = hash_strings(coded.dictionary)
    hashes[hashes == END] += np.uint64(1)
    tokens = np.insert(hashes[coded.indices.to_numpy()], offsets[1:], END)
    return tokens, offsets[1:] + np.arange(len(texts)), coded, offsets


def bigram_keys(tokens: np.ndarray) -> np.ndarray:
    """A key for each token with the one before it; a text's first follows an end."""
    before = np.concatenate([[END], tokens[:-1]]) if len(tokens) else tokens
    return mix(before * ONE + tokens * TWO + np.uint64(1))


def unigram_keys(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens * TWO)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)


def middle(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for; 0 for no level."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1.0) - 0.5, 0.0)


def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of a key and level, from which all its probes follow."""
    one = mix(keys ^ np.uint64(level * int(ONE) % 2**64))
    return one, (one * TWO) | np.uint64(1)


def _spots(one: np.ndarray, two: np.ndarray, probe: int, sizes: np.ndarray) -> np.ndarray:
    """The bit of a probe in a segment of the given size, which is below 2**32."""
    high = (one + np.uint64(probe) * two) >> np.uint64(32)
    return ((high * sizes.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def fill_segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The bits of a segment that holds these n-grams."""
    levels = levels_of(counts)
    size = max(64, -(-int(levels.sum()) * BITS // 8) * 8)
    bits = np.zeros(size, bool)
    sizes = np.full(len(keys), size)
    for level in range(1, int(levels.max(initial=0)) + 1):
        deep = levels >= level
        one, two = _hashes(keys[deep], level)
        for probe in range(PROBES):
            bits[_spots(one, two, probe, sizes[deep])] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Some consecutive segments of the filter."""

    def __init__(self, shift: int, first: int, parts: list):
        """parts: the bytes of each segment, or a buffer of them; copied once."""
        self.shift, self.first = shift, first
        self.sizes = np.array([len(p) * 8 for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.zeros(int(self.sizes.sum()) // 8, np.uint8)
        for start, part in zip((self.starts // 8).tolist(), parts):
            self.data[start : start + len(part)] = np.frombuffer(part, np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which all are present; 0 where the key's segment is not here."""
        out = np.zeros(len(keys), np.uint8)
        segment = segments_of(keys, self.shift) - self.first
        alive = np.flatnonzero((segment >= 0) & (segment < len(self.sizes)))
        alive = alive[self.sizes[segment[alive]] > 0]
        for level in range(1, 64):
            one, two = _hashes(keys[alive], level)
            for probe in range(PROBES):
                if not len(alive):
                    return out
                own = segment[alive]
                spot = self.starts[own] + _spots(one, two, probe, self.sizes[own])
                found = (self.data[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
                alive, one, two = alive[found], one[found], two[found]
            out[alive] = level
        return out


def segments_of(keys: np.ndarray, shift: int) -> np.ndarray:
    return (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) of the training texts."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                _, flat = ascii_words(part.column("text"))
                found = flat.value_counts()
                yield pa.RecordBatch.from_arrays(
                    [found.field(0).cast(pa.string()), found.field(1).cast(pa.int64())], ["word", "c"]
                )

    return training.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int, most_bytes: int = HEAD_BYTES) -> DataFrame:
    """The words (word, c) of at least some count, chosen so that they are at most `most`
    and have at most `most_bytes`. A word that is itself long (LONG bytes) is never among them."""
    step = F.floor(8 * F.log2("c")).cast("int")
    size = F.octet_length("word")
    short = counts.filter(size <= LONG)
    sizes = short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum(size).alias("bytes")).collect()
    lowest, taken, held = 10**6, 0, 0
    for row in sorted(sizes, key=lambda r: -r.step):  # under 512 rows
        taken, held = taken + row.words, held + row.bytes
        if taken > most or held > most_bytes:
            break
        lowest = row.step
    return short.filter(step >= lowest)


def filter_segments(training: DataFrame, shift: int) -> DataFrame:
    """(segment, bits) of the filter of the training texts' words and bigrams.

    A task counts up to GATHERED n-grams and passes them on by segment, packed."""

    def run(batches):
        held: list = []

        def packed():
            keys = np.concatenate([k for k, _ in held])
            weight = np.concatenate([w for _, w in held])
            keys, back = np.unique(keys, return_inverse=True)
            counts = np.minimum(np.bincount(back, weight), 2**32 - 1).astype(np.uint32)
            held.clear()
            segment = segments_of(keys, shift)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1, [len(keys)]])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(segment[edges[:-1]]),
                    pa.array([keys[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                ],
                ["segment", "keys", "counts"],
            )

        for batch in batches:
            for part in slices(batch, "text"):
                tokens = token_hashes(part.column("text"))[0]
                # the lowest bit tells words from bigrams
                for keys in (unigram_keys(tokens) | np.uint64(1), bigram_keys(tokens) & ~np.uint64(1)):
                    distinct, counts = np.unique(keys, return_counts=True)
                    held.append((distinct, counts))
                if sum(len(k) for k, _ in held) >= GATHERED:
                    yield packed()
        if held:
            yield packed()

    def build(table):
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
        keys, back = np.unique(keys, return_inverse=True)
        counts = np.bincount(back, counts, len(keys))
        return pa.table(
            {
                "segment": pa.array([table.column("segment")[0].as_py()], pa.int64()),
                "bits": pa.array([fill_segment(keys, counts)], pa.binary()),
            }
        )

    rows = training.mapInArrow(run, "segment long, keys binary, counts binary")
    return rows.groupBy("segment").applyInArrow(build, "segment long, bits binary")


def probe(tokens: np.ndarray, held: Filter) -> np.ndarray:
    """Levels of each token as a word and as the end of a bigram: two rows."""
    distinct, back = np.unique(tokens, return_inverse=True)
    words = held.levels(unigram_keys(distinct) | np.uint64(1))[back]
    return np.stack([words, held.levels(bigram_keys(tokens) & ~np.uint64(1))])


def token_scores(words: np.ndarray, pairs: np.ndarray, is_end: np.ndarray, facts: dict) -> np.ndarray:
    """log10 p(w | h) of consecutive tokens from their levels."""
    single = middle(words.astype(float))
    single[is_end] = facts["texts"]  # the end's count is known
    before = np.concatenate([[float(facts["texts"])], single[:-1]])
    both = middle(pairs.astype(float))
    below = facts["N"] + ALPHA * (facts["V"] + 1)
    alone = np.minimum((single + ALPHA) / below, 1.0)
    return np.log10(np.minimum((np.minimum(both, before) + MU * alone) / (before + MU), 1.0))


def segment_sum(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive values up to and with each end."""
    return np.add.reduceat(values, np.concatenate([[0], ends[:-1] + 1])) if len(ends) else np.zeros(0)


def _without_rare(coded, offsets, head, facts) -> list[pa.Array]:
    """For each text n_tokens, n_known and base as far as the head tells, and its rarer words
    with their times."""
    words, counts = head
    texts = len(offsets) - 1
    below = math.log10(facts["N"] + ALPHA * (facts["V"] + 1)) if facts["N"] else 0.0
    place = pc.index_in(coded.dictionary, value_set=words)
    spot = pc.fill_null(place, -1).to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy()
    rare = spot[code] < 0
    logs = np.where(spot < 0, 0.0, np.log10(np.append(counts, 1.0)[spot] + ALPHA) - below)
    last = math.log10(facts["texts"] + ALPHA) - below if facts["N"] else 0.0
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    base = np.bincount(owner, logs[code], texts) + last
    known = np.bincount(owner, ~rare, texts).astype(np.int64) + (facts["N"] > 0)
    pairs = np.unique(owner[rare] * np.int64(len(coded.dictionary) + 1) + code[rare], return_counts=True)
    text = pairs[0] // (len(coded.dictionary) + 1)
    edges = pa.array(np.searchsorted(text, np.arange(texts + 1)).astype(np.int32))
    names = coded.dictionary.take(pa.array(pairs[0] % (len(coded.dictionary) + 1))).cast(pa.string())
    return [
        pa.array(np.diff(offsets) + 1),
        pa.array(known),
        pa.array(base),
        pa.ListArray.from_arrays(edges, names),
        pa.ListArray.from_arrays(edges, pa.array(pairs[1])),
    ]


def _score_rows(sent, head, facts):
    """Rows (uid, doc, text) to what is known without the rarer words' counts."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, ends, coded, offsets = token_hashes(part.column("text"))
                score = np.zeros(len(ends))
                if facts["N"]:
                    is_end = np.zeros(len(tokens), bool)
                    is_end[ends] = True
                    words, pairs = probe(tokens, sent.value)
                    score = segment_sum(token_scores(words, pairs, is_end, facts), ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("doc"),
                        *_without_rare(coded, offsets, head.value, facts),
                        pa.array(score),
                    ],
                    ["uid", "doc", "n_tokens", "n_known", "base", "rare", "times", "score"],
                )

    return run


def packed(values: np.ndarray) -> bytes:
    """Unsigned values, byte by byte of their places and compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpacked(held, number: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(held, size * number, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, number).T).view(kind).ravel()


def _joined(words: pa.Array, edges: np.ndarray) -> list[bytes]:
    """The words between each two edges in one value. A word holds no line feed."""
    lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), words)
    joined = pc.binary_join(lists, pa.scalar(b"\n", words.type))
    return [pa.compress(x.as_buffer(), codec="zstd", asbytes=True) for x in joined]


def _parted(joined, size: int) -> pa.Array:
    whole = pa.array([pa.decompress(joined, size, codec="zstd", asbytes=True)], pa.large_binary())
    return pc.split_pattern(whole, b"\n").flatten()


def _word_hashes(words: pa.Array) -> np.ndarray:
    """As in token_hashes; the word ENDS is the end."""
    hashes = hash_strings(words)
    hashes[hashes == END] += np.uint64(1)
    hashes[pc.equal(words, ENDS).to_numpy(zero_copy_only=False)] = END
    return hashes


def _joined_size(words: pa.Array) -> int:
    return pc.sum(pc.binary_length(words)).as_py() + len(words) - 1


def _pack_rows(most):
    """Rows (uid, doc, text, learn) to a row for each pack: its texts in lists, its distinct
    words (the end is the last) and its tokens as codes of these."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", most):
                offsets, flat = ascii_words(part.column("text"))
                coded = flat.dictionary_encode()
                words = pa.concat_arrays([coded.dictionary.cast(pa.large_binary()), pa.array([ENDS], pa.large_binary())])
                codes = np.insert(coded.indices.to_numpy(), offsets[1:], len(words) - 1).astype("<u4")
                uid, n_tokens = part.column("uid"), np.diff(offsets) + 1
                learned = int(n_tokens[part.column("learn").to_numpy(zero_copy_only=False)].sum())
                edges = pa.array([0, len(uid)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        uid.slice(0, 1),
                        *[
                            pa.ListArray.from_arrays(edges, x)
                            for x in (uid, part.column("doc"), part.column("learn"), pa.array(n_tokens))
                        ],
                        pa.array([learned]),
                        pa.array([_joined_size(words)]),
                        pa.array(_joined(words, np.array([0, len(words)])), pa.binary()),
                        pa.array([packed(codes)], pa.binary()),
                    ],
                    ["pack", "uid", "doc", "learn", "n_tokens", "learned", "size", "words", "codes"],
                )

    return returning(run)


class Grams:
    """The n-grams of a pack: its distinct words and bigrams, each ordered by key."""

    def __init__(self, row, shift: int):
        """row: of a pack, by column."""
        self.n_tokens = row["n_tokens"].values.to_numpy()
        self.codes = unpacked(row["codes"].as_buffer(), int(self.n_tokens.sum()), "<u4")
        self.words = _parted(row["words"].as_buffer(), row["size"].as_py())
        hashes = _word_hashes(self.words)
        # the lowest bit tells words from bigrams
        words = unigram_keys(hashes) | np.uint64(1)
        self.word_order = np.argsort(words, kind="stable")
        self.word_parts = segments_of(words[self.word_order], shift) >> PART
        pairs = bigram_keys(hashes[self.codes]) & ~np.uint64(1)
        self.order = np.argsort(pairs)
        ordered = pairs[self.order]
        self.starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        self.pairs = ordered[self.starts]
        self.pair_parts = segments_of(self.pairs, shift) >> PART
        self.parts = np.union1d(self.word_parts, self.pair_parts)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each part starts among the words and among the bigrams, and their ends."""
        return (
            np.append(np.searchsorted(self.word_parts, self.parts), len(self.word_parts)),
            np.append(np.searchsorted(self.pair_parts, self.parts), len(self.pair_parts)),
        )


def _ask_rows(shift):
    """Packs to (part, pack, n_words, size, words, word_counts, n, keys, counts): the distinct n-grams
    of a pack and how often its training texts hold them, which may be never. keys are
    their differences."""
    names = ["part", "pack", "n_words", "size", "words", "word_counts", "n", "keys", "counts"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                grams = Grams(row, shift)
                own = np.repeat(row["learn"].values.to_numpy(zero_copy_only=False), grams.n_tokens)
                words = grams.words.take(pa.array(grams.word_order))
                word_counts = np.bincount(grams.codes[own], minlength=len(words))[grams.word_order].astype("<u8")
                counts = np.add.reduceat(own[grams.order].astype("<u8"), grams.starts)
                lengths = pc.binary_length(words).to_numpy()
                columns = [[] for _ in names]
                spans = [list(zip(x[:-1].tolist(), x[1:].tolist())) for x in grams.edges()]
                for part, joined, (a, b), (c, d) in zip(
                    grams.parts.tolist(), _joined(words, grams.edges()[0]), *spans
                ):
                    steps = np.diff(grams.pairs[c:d], prepend=np.uint64(0)).astype("<u8")
                    size = int(lengths[a:b].sum()) + max(0, b - a - 1)
                    cells = [b - a, size, joined, packed(word_counts[a:b]), d - c, packed(steps), packed(counts[c:d])]
                    for column, cell in zip(columns, [part, row["pack"].as_py(), *cells]):
                        column.append(cell)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    return returning(run)


def _answer(shift):
    """What is asked of a part to (part, pack, levels, word_counts, n_words, n, total, kinds): the part's
    segments are filled and each distinct n-gram probed once. total and kinds, in one
    row: training tokens and distinct ones."""

    def run(table):
        rows = table.to_pylist()
        words = [_parted(r["words"], r["size"]) for r in rows if r["n_words"]]
        coded = pa.concat_arrays([*words, pa.array([], pa.large_binary())]).dictionary_encode()
        spelt = coded.indices.to_numpy()
        times = np.concatenate([unpacked(r["word_counts"], r["n_words"], "<u8") for r in rows])
        exact = np.bincount(spelt, times, len(coded.dictionary)).astype("<u8")
        word_keys = unigram_keys(_word_hashes(coded.dictionary)) | np.uint64(1)
        asked = np.concatenate([np.cumsum(unpacked(r["keys"], r["n"], "<u8"), dtype=np.uint64) for r in rows])
        held = np.concatenate([unpacked(r["counts"], r["n"], "<u8") for r in rows])
        keys, back = np.unique(np.concatenate([word_keys, asked]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([exact, held]), len(keys))
        part = rows[0]["part"]
        first, segment = part << PART, segments_of(keys, shift)
        filled = []
        for number in range(first, first + 2**PART):
            own = (segment == number) & (counts > 0)
            filled.append(fill_segment(keys[own], counts[own]) if own.any() else b"")
        levels = Filter(shift, first, filled).levels(keys)[back]
        of_words, of_pairs = levels[: len(word_keys)][spelt], levels[len(word_keys) :]
        total, kinds, exact = int(exact.sum()), int((exact > 0).sum()), exact[spelt]
        out = {name: [] for name in ("part", "pack", "levels", "word_counts", "n_words", "n", "total", "kinds")}
        a = c = 0
        for i, row in enumerate(rows):
            b, d = a + row["n_words"], c + row["n"]
            out["part"].append(part)
            out["pack"].append(row["pack"])
            out["levels"].append(packed(np.concatenate([of_words[a:b], of_pairs[c:d]])))
            out["word_counts"].append(packed(exact[a:b]))
            out["n_words"].append(b - a)
            out["n"].append(d - c)
            out["total"].append(0 if i else total)
            out["kinds"].append(0 if i else kinds)
            a, c = b, d
        return pa.table(out)

    return run


def _scored_packs(shift, facts):
    """A pack and what its parts answer to (doc, n_tokens, n_known, base, score)."""

    def run(packs, answers):
        row = {name: packs.column(name)[0] for name in packs.column_names}
        grams = Grams(row, shift)
        words, pairs, exact = [], [], []
        for part in answers.sort_by("part").to_pylist():
            levels = unpacked(part["levels"], part["n_words"] + part["n"], np.uint8)
            words.append(levels[: part["n_words"]])
            pairs.append(levels[part["n_words"] :])
            exact.append(unpacked(part["word_counts"], part["n_words"], "<u8"))
        counts = np.empty(len(grams.words), np.float64)
        counts[grams.word_order] = np.concatenate(exact)
        single = np.empty(len(grams.words), np.uint8)
        single[grams.word_order] = np.concatenate(words)
        both = np.empty(len(grams.codes), np.uint8)
        both[grams.order] = np.repeat(np.concatenate(pairs), np.diff(np.append(grams.starts, len(grams.order))))
        ends = np.cumsum(grams.n_tokens) - 1
        below = facts["N"] + ALPHA * (facts["V"] + 1)
        logs = np.log10((counts + ALPHA) / below) if facts["N"] else np.zeros(len(counts))
        score = segment_sum(token_scores(single[grams.codes], both, grams.codes == len(counts) - 1, facts), ends)
        return pa.table(
            [
                row["doc"].values,
                row["n_tokens"].values,
                pa.array(segment_sum((counts > 0).astype(np.int64)[grams.codes], ends)),
                pa.array(segment_sum(logs[grams.codes], ends)),
                pa.array(score),
            ],
            ["doc", "n_tokens", "n_known", "base", "score"],
        )

    return run


def _segments(tokens: int, segment: int) -> int:
    """The number of segments for so many training tokens, as a power of two."""
    return max(0, math.ceil(math.log2(max(1, tokens / segment))))


def _scored_by_parts(rows: DataFrame, texts: int, segment: int) -> DataFrame:
    """score() with a filter that is not sent. texts: training texts."""
    kind = rows.schema["doc"].dataType.simpleString()
    packs = materialize(
        rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(
            _pack_rows(PACK),
            f"pack long, uid array<long>, doc array<{kind}>, learn array<boolean>, n_tokens array<long>, learned long, "
            "size long, words binary, codes binary",
        ),
        "packs",
    )
    shift = 64 - _segments(packs.agg(F.sum("learned")).first()[0] or 0, segment)
    asked = packs.select("pack", "learn", "n_tokens", "size", "words", "codes").mapInArrow(
        _ask_rows(shift),
        "part long, pack long, n_words long, size long, words binary, word_counts binary, n long, keys binary, counts binary",
    )
    answers = materialize(
        asked.groupBy("part").applyInArrow(
            _answer(shift),
            "part long, pack long, levels binary, word_counts binary, n_words long, n long, total long, kinds long",
        ),
        "answers",
    )
    total = answers.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    facts = {"texts": texts, "N": total[0], "V": total[1]}
    found = (
        packs.select("pack", "doc", "n_tokens", "size", "words", "codes")
        .groupBy("pack")
        .cogroup(answers.drop("total", "kinds").groupBy("pack"))
        .applyInArrow(
            _scored_packs(shift, facts), f"doc {kind}, n_tokens long, n_known long, base double, score double"
        )
    )
    return found.select("doc", "n_tokens", "n_known", F.lit(facts["N"]).cast("long").alias("train_tokens"), "base", "score")


def score(
    docs: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    head: int = HEAD,
    most_bytes: int = MOST_BYTES,
    segment: int = SEGMENT,
) -> DataFrame:
    """(doc, n_tokens, n_known, train_tokens, base, score) for each row of docs.

    training: whether the model learns from a row."""
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = docs.select(
        F.col(key).alias("doc"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("learn")
    )
    learn = rows.filter("learn").select("text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    # words are a byte and a blank at least, so with the end a text has at most so many tokens
    texts, most = learn.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.floor((size + 1) / 2) + 1), F.lit(0))).first()
    # an n-gram has no more levels than occurrences, words and bigrams are `most` each, a segment is 8 bytes at least
    if math.ceil(2 * most * BITS / 8) + 9 * 2 ** _segments(most, segment) > most_bytes:
        return _scored_by_parts(rows, texts, segment)
    counts = materialize(word_counts(learn), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    facts = {"texts": texts, "N": total[0] + texts, "V": total[1] + (texts > 0)}

    common = most_frequent(counts, head).toArrow()
    sent_head = context.broadcast(
        (common.column("word").combine_chunks().cast(pa.large_string()), common.column("c").to_numpy().astype(float))
    )
    number = _segments(facts["N"], segment)
    shift = 64 - number
    parts = filter_segments(learn, shift).toArrow()
    held: list = [b""] * 2**number
    for place, bits in zip(parts.column("segment").to_pylist(), parts.column("bits")):
        held[place] = bits.as_buffer()
    sent = context.broadcast(Filter(shift, 0, held))

    kind = rows.schema["doc"].dataType.simpleString()
    schema = (
        f"uid long, doc {kind}, n_tokens long, n_known long, base double, rare array<string>, times array<long>, score double"
    )
    numbered = rows.select("doc", "text", F.monotonically_increasing_id().alias("uid"))
    found = materialize(numbered.mapInArrow(_score_rows(sent, sent_head, facts), schema), "scored")
    rare = found.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "uid", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    below = facts["N"] + ALPHA * (facts["V"] + 1)
    log = F.log10((F.coalesce(F.col("c"), F.lit(0)) + ALPHA) / below) if facts["N"] else F.lit(0.0)
    sums = (
        rare.join(counts, "word", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.col("times") * log).alias("more_base"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        )
    )
    return found.join(sums, "uid", "left").select(
        "doc",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(facts["N"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base"),
        "score",
    )


def held_out(key: Column) -> Column:
    """Whether the id's remainder is 0; a null id is not held out."""
    return F.coalesce(id_remainder(key, 10) == 0, F.lit(False))


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = score(docs, ~held_out(F.col("doc_id")))
    return found.select(
        F.col("doc").alias("doc_id"),
        held_out(F.col("doc")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        F.col("base").alias("base_score"),
        "score",
    )


QUERIES = {"op4_lm_score": (op4_lm_score, None)}
