"""Packing documents into sequences by vector best-fit.

A document is the ids of its text and an end (id 0). It stays whole unless it is longer
than the longest piece, then it is cut into pieces of that length and a rest.

A sequence has three capacities: tokens, documents (pieces) and attention cost (the sum
of the squared lengths of its pieces). Pieces are placed from long to short, each in a
sequence in which every residual capacity holds it. Of those the best fit is taken by
`measure`: "norm", the smallest weighted norm of the residuals that it leaves, or "dot",
the smallest weighted dot product of the piece with the residuals that it finds (both as
shares of the capacities). If none holds it, a new sequence is opened.

Pieces of one length are alike for every capacity, so the plan is made from the number of
pieces of each length alone: sequences of the same content are kept as one pattern with a
count, and a placement serves as many of them at once as there are pieces. The driver gets
one number for each length (at most `tokens` of them) and makes at most three patterns a
length; a pattern has less than sqrt(2 * tokens) different lengths. The plan's size is
bounded by the capacity whatever the number of documents, and it is the plan that best-fit
makes over all pieces of the corpus, not over those of one task. Spark then numbers the
pieces of each length (range partitions of a written table, ties by a row hash, so a
frequent length is spread) and each piece finds its place by its length and number.

Ids are those of the tokenizers library. Texts without a special token's "<|" are split at
blanks (space, 0x09-0x0D), which no token crosses, and each distinct stretch of a slice is
encoded once. A stretch of characters up to U+00FF is cut into the tokenizer's words here
and each distinct word is merged by the library's model and remembered; all other stretches, and texts with
"<|", go through the library whole.

Defined results: a null or empty text is the end alone. Whole texts are read, in slices;
memory is bounded by a slice or the longest single text and MOST_KEPT words. Rows that
repeat an id are packed each. Which of several pieces of one length gets which place
follows from a hash of the rows; equal rows are interchangeable. A table without rows gives
no sequences. Further columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import slices, stretches
from marlspike.operators.ids import number_rows
from marlspike.session import materialize

END = 0
MOST_KEPT = 250_000  # words whose ids a task remembers
MOST_IDS = 8 * MOST_KEPT  # of them altogether
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
DIGITS = "0-9²³¹¼-¾"
BLANKS = r"\t-\r \x85\xA0"
#: The tokenizer's own words, written out for characters up to U+00FF, and line feeds.
WORDS = re.compile(rf"[{LETTERS}]+|\n|[{DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^{BLANKS}{LETTERS}{DIGITS}]+")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. documents and cost: None for no limit beyond that of tokens."""

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None

    def limits(self) -> tuple[int, int, int]:
        documents = self.tokens if self.documents is None else self.documents
        cost = self.tokens**2 if self.cost is None else self.cost
        if min(self.tokens, documents, cost) < 1:
            raise ValueError("capacities are at least 1")
        return self.tokens, documents, cost

    def longest(self) -> int:
        tokens, _, cost = self.limits()
        return min(tokens, math.isqrt(cost))


def best_fit(
    counts: dict[int, int],
    capacity: Capacity,
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    measure: str = "norm",
) -> list[tuple[int, dict[int, int]]]:
    """Patterns (number of sequences, {length: pieces in each}) for the pieces of each length."""
    if measure not in ("norm", "dot"):
        raise ValueError("measure is 'norm' or 'dot'")
    limits = np.array(capacity.limits(), np.float64)
    weight = np.array(weights)
    number, room, content = [], np.zeros((0, 3)), []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        piece = np.array([length, 1, length * length], np.float64)
        while left:
            fits = np.flatnonzero((room >= piece).all(axis=1))
            if not len(fits):
                most = int((limits // piece).min())
                new = [(left // most, most), (1, left % most)]
                for count, each in new:
                    if count and each:
                        number.append(count)
                        content.append({length: each})
                        room = np.vstack([room, limits - each * piece])
                break
            found = room[fits] / limits
            if measure == "norm":
                score = ((found - piece / limits) ** 2) @ weight
            else:
                score = (found * (piece / limits)) @ weight
            spot = int(fits[np.lexsort((room[fits, 0], score))[0]])
            if number[spot] > left:  # the others of this pattern stay as they are
                number.append(number[spot] - left)
                content.append(dict(content[spot]))
                room = np.vstack([room, room[spot]])
                number[spot] = left
            left -= number[spot]
            content[spot][length] = content[spot].get(length, 0) + 1
            room[spot] -= piece
    return list(zip(number, content))


def places(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each length of each pattern: which numbers of that length go there (from `first`
    on, up to the next of the length), the pattern's sequences (`bins` from `base` on) and
    the offset of its first such piece. Sorted by length, first."""
    rows, used, base = [], {}, 0
    for bins, content in patterns:
        offset = 0
        for length, each in content.items():
            rows.append((length, used.get(length, 0), bins, base, offset))
            used[length] = used.get(length, 0) + bins * each
            offset += length * each
        base += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "bins", "base", "offset"), table.T))


class Kept(dict):
    """Words to their spots: word i has the next sizes[i] ids of flat. An unknown word is added;
    a line feed is a word without ids."""

    def __init__(self, find):
        """find: the ids of a word."""
        self.find, self.flat, self.sizes = find, array("I"), array("q")
        self.add("\n", [])

    def add(self, word: str, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.sizes.append(len(ids))
        self[word] = spot = len(self)
        return spot

    def __missing__(self, word: str) -> int:
        return self.add(word, self.find(word))

    def full(self) -> bool:
        return len(self) > MOST_KEPT or len(self.flat) > MOST_IDS


class Words:
    """Ids of texts, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in own]
        self.byte = {b: chr(256 + i) for i, b in enumerate(others)}
        self.kept = Kept(self.word)

    def word(self, word: str) -> list[int]:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.byte)
        return [x.id for x in self.merges.tokenize(word)]

    def other(self, text: str) -> int:
        """The spot of a stretch that is not cut into words."""
        spot = self.kept.get(text)
        return self.kept.add(text, self.whole(text)) if spot is None else spot

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        special = pc.fill_null(pc.match_substring(texts, "<|"), False)
        offsets, flat = stretches(pc.if_else(special, "", texts))
        coded = flat.dictionary_encode()
        distinct, sizes = self.stretches(coded.dictionary)
        code = coded.indices.to_numpy()
        joined = gathered(distinct, sizes, code)
        edges = np.concatenate([[0], np.cumsum(sizes[code])])[offsets].tolist()
        out = [joined[a:b] for a, b in zip(edges[:-1], edges[1:])]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.array(self.whole(texts[i].as_py()), np.uint32)
        return out

    def stretches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches, one behind the other, and their number in each."""
        if self.kept.full():
            self.kept = Kept(self.word)
        kept = self.kept
        other = pc.match_substring_regex(texts, r"[^\x00-\x{FF}]").to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~other))
        # no stretch holds a line feed; it stands between the words of two
        lists = pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain)
        joined = pc.binary_join(lists, pa.scalar("\n", plain.type))[0].as_py()
        words = WORDS.findall(joined.lower() + "\n" * (len(plain) > 0))
        code = np.fromiter(map(kept.__getitem__, words), np.int64, len(words))
        others = np.array([self.other(x) for x in texts.filter(pa.array(other)).to_pylist()], np.int64)
        # copied, as an array cannot grow while it is viewed
        spots = np.array(kept.sizes, np.int64)
        found = gathered(np.array(kept.flat, np.uint32), spots, np.concatenate([code, others]))
        ends = np.cumsum(spots[code])[code == kept["\n"]]
        sizes = np.concatenate([np.diff(ends, prepend=0), spots[others]])
        # from the plain ones and the others behind them to the order of texts
        order = np.argsort(np.concatenate([np.flatnonzero(~other), np.flatnonzero(other)]))
        return gathered(found, sizes, order), sizes[order]


def gathered(flat: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The pieces of flat (of these sizes) that the codes name, one behind the other."""
    own = sizes[code]
    before = np.cumsum(own) - own
    starts = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts[code] - before, own) + np.arange(int(own.sum()))]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    return Words(path)


def tokenizer_path(path: str | None = None) -> str:
    """The given path, or that of the public vocabulary installed on each machine."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(longest: int, path: str | None, keep: bool):
    def run(batches):
        words = words_of(tokenizer_path(path))
        for batch in batches:
            for part in slices(batch, "text"):
                at, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, own in enumerate(words.ids(part.column("text"))):
                    whole = np.append(own, np.uint32(END)).astype("<u4")
                    for n, low in enumerate(range(0, len(whole), longest)):
                        one = whole[low : low + longest]
                        at.append(i)
                        piece.append(n)
                        start.append(low)
                        length.append(len(one))
                        crc.append(zlib.crc32(one.tobytes()))
                        if keep:
                            ids.append(one.tolist())
                columns = {
                    "doc": part.column("doc").take(pa.array(at, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if keep:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def cut(
    docs: DataFrame,
    longest: int,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc, piece, start, length, ids_crc32) and, if asked for, the ids of all pieces."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(_cut(longest, path, keep_ids), schema)


def _placed(plan, before, names):
    """Rows with `length` and `number` (from 1, by length) to their sequence and offset."""

    def run(batches):
        held, earlier = plan.value, before.value
        # numbers count within a length, so (length, number) grows along the plan's rows
        top = 1 << 44
        first = held["length"] * top + held["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("number").to_numpy() - 1 - earlier[length]
            row = np.searchsorted(first, length * top + rank, side="right") - 1
            inside = rank - held["first"][row]
            bins = held["bins"][row]
            columns = [batch.column(x) for x in names]
            columns.append(pa.array(held["base"][row] + inside % bins))
            columns.append(pa.array(held["offset"][row] + inside // bins * length))
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return run


def pack(
    pieces: DataFrame,
    capacity: Capacity = Capacity(),
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    measure: str = "norm",
) -> DataFrame:
    """pieces (`length` and more; read several times, so a written table) with the sequence
    that each goes to and its offset there."""
    context = pieces.sparkSession.sparkContext
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `tokens` rows
    counts = {row.length: row.n for row in sizes}
    if any(x > capacity.longest() or x < 1 for x in counts):
        raise ValueError("a piece is longer than a sequence holds")
    before = np.zeros(capacity.tokens + 2, np.int64)
    for length, n in counts.items():
        before[length + 1] = n
    plan = context.broadcast(places(best_fit(counts, capacity, weights, measure)))
    earlier = context.broadcast(np.cumsum(before))
    narrow = [f for f in pieces.schema.fields if f.dataType.simpleString() != "array<int>"]
    own = F.xxhash64(*[F.col(f"`{f.name}`") for f in narrow])
    numbered = number_rows(pieces, [F.col("length"), own, *[F.col(f"`{f.name}`") for f in narrow]], "number")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(
        _placed(plan, earlier, pieces.columns), f"{fields}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    measure: str = "norm",
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc, piece, start, length, ids_crc32[, ids], sequence_id, offset) of all documents."""
    pieces = materialize(cut(docs, capacity.longest(), key, text, path, keep_ids), "pieces")
    return pack(pieces, capacity, weights, measure)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, docs, offsets) of packed pieces that kept their ids. A sequence is
    bounded by its capacities, so a group is small."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc").alias("docs"),
        F.col("parts.offset").alias("offsets"),
    )


def op13_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).withColumnRenamed("doc", "doc_id")


QUERIES = {"op13_packing": (op13_packing, None)}
