"""Spelling variants grouped through PartEnum signatures.

Words are the runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, of
which one in DAMAGE loses a letter first (`counted`). Two words are near if one inserted,
deleted or replaced code point turns one into the other.

A word's letter multiset is a binary vector: letter c stands for the elements (c, 1),
(c, 2), ... as often as it occurs. One edit changes at most two elements: an inserted
letter exactly one, a replaced letter exactly two, as it takes one away and adds another.
The elements are dealt into parts by a hash. Vectors at a Hamming distance of k agree on
all but k parts at most, so for each choice of k parts that are left out a signature
stands for the elements of the rest: words of one length meet on the signatures that leave
out two of SAME_PARTS parts, words of lengths m and m + 1 on those that leave out one of
MORE_PARTS parts.

An edit also leaves the word on both sides of it as it is: of a word's thirds a replaced
letter changes one, of a word's halves an inserted letter changes one. Each signature is
joined with what an edit there leaves alone, which loses no pair and splits the words whose
letters are nearly the same in another order. Signatures are equi-joined as 64-bit hashes;
every pair that meets is verified code point by code point (levenshtein), and the verified
pairs are merged, as several signatures may show one.

The words that stand under one signature are spelled alike but for one part and have nearly
the same letters there; each is one row, however often it occurs. Counting is a hash
aggregation with partial sums in the tasks, so frequent words do no harm.

A word's form is its near word of the largest count, if that is at least RISE times its
own; following forms leads to its root. As counts grow by RISE with each step, the forms
of N words are at most log2(N) steps long and are followed by doubling the steps.

Defined results: null and empty texts have no words. A null id is written as an empty one
in the hash that decides which runs are damaged. Repeated rows count each. Ties go to the
word that is smaller in code-point order. Whole texts are read, in slices; memory is
bounded by a slice or the longest single text. A table without rows, or without words that
are frequent enough, gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import mix, slices
from marlspike.session import materialize

DAMAGE = 97
SHORTEST, LEAST, RISE = 5, 3, 2
SAME_PARTS, MORE_PARTS = 3, 2
ONE = np.uint64(0x9E3779B97F4A7C15)


def is_letter(code: np.ndarray) -> np.ndarray:
    low = code | 0x20
    return ((low >= 97) & (low <= 122)) | ((code >= 0xC0) & (code <= 0xFF))


@lru_cache(maxsize=1)
def _zero_bytes() -> np.ndarray:
    """[k, i, b]: what byte i of a crc32 register, if it is b, becomes after 2**k zero bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    value = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])
    out = [table[value & 255] ^ (value >> 8)]
    for _ in range(31):
        out.append(_through(out[-1], out[-1]))
    return np.stack(out)


def _through(tables: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = tables[0][value & 255]
    for i in range(1, 4):
        out = out ^ tables[i][(value >> np.uint32(8 * i)) & 255]
    return out


def crc_joined(first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of strings put together, from the crc32 of both parts and the second's bytes."""
    out, steps = first.astype(np.uint32), _zero_bytes()
    for k in range(int(sizes.max(initial=0)).bit_length()):
        there = np.flatnonzero((sizes >> k) & 1)
        out[there] = _through(steps[k], out[there])
    return out ^ second


def text_runs(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(text of each run, runs) of the runs of SHORTEST letters at least, A-Z in lower case."""
    texts = texts.cast(pa.large_string()).fill_null("")
    joined = "".join([x + " " for x in texts.to_pylist()])
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    letter = is_letter(code)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= SHORTEST
    starts, ends = starts[long], ends[long]
    closes = np.cumsum([len(x) + 1 for x in texts.to_pylist()], dtype=np.int64)
    before = np.searchsorted(starts, closes)
    owner = np.repeat(np.arange(len(closes)), np.diff(before, prepend=0))
    inside = np.zeros(len(code) + 1, np.int8)
    inside[starts], inside[ends] = 1, -1  # no run starts where another ends
    kept = code[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    kept = np.where((kept >= 65) & (kept <= 90), kept + 32, kept)
    width = 1 + (kept >= 0x80)
    places = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    data = kept.astype(np.uint8).tobytes().decode("latin-1").encode()
    offsets = places[np.concatenate([[0], np.cumsum(ends - starts, dtype=np.int64)])]
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return owner, runs.dictionary_encode()


def _counts(keys: str):
    """Rows (doc, text) to (word, n) for each slice: its runs, damaged ones in their new form."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                owner, runs = text_runs(part.column("text"))
                prefix = np.array([zlib.crc32(f"{x}:".encode()) for x in part.column(keys).to_pylist()], np.uint32)
                names = [x.encode() for x in runs.dictionary.to_pylist()]
                own = np.array([zlib.crc32(x) for x in names], np.uint32)
                sizes = np.array([len(x) for x in names], np.int64)
                code = runs.indices.to_numpy().astype(np.int64)
                h = crc_joined(prefix[owner], own[code], sizes[code]) if len(code) else np.zeros(0, np.uint32)
                hit = h % DAMAGE == 0
                n = np.bincount(code[~hit], minlength=len(names))
                words, counts = [x.decode() for x in names], n.tolist()
                for at, place in zip(code[hit].tolist(), h[hit].tolist()):
                    word = words[at]
                    cut = place % len(word)
                    words.append(word[:cut] + word[cut + 1 :])
                    counts.append(1)
                kept = [i for i, (w, c) in enumerate(zip(words, counts)) if c and len(w) >= SHORTEST]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([words[i] for i in kept], pa.string()),
                        pa.array([counts[i] for i in kept], pa.int64()),
                    ],
                    ["word", "n"],
                )

    return run


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of docs that occur LEAST times."""
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(named.alias("doc"), F.col(text).alias("text"))
    found = rows.mapInArrow(_counts("doc"), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def part_sums(code: np.ndarray, owner: np.ndarray, count: int, parts: int) -> np.ndarray:
    """[word, part]: the sum of the hashes of the word's elements in the part."""
    if not len(code):
        return np.zeros((count, parts), np.uint64)
    order = np.lexsort((code, owner))
    c, o = code[order], owner[order]
    new = np.append(True, (np.diff(o) != 0) | (np.diff(c) != 0))
    place = np.arange(len(c))
    times = place - np.maximum.accumulate(np.where(new, place, 0))
    element = mix(c.astype(np.uint64) * ONE + times.astype(np.uint64) + np.uint64(1))
    part = (mix(element) % np.uint64(parts)).astype(np.int64)
    out = np.zeros((count, parts), np.uint64)
    np.add.at(out, (o, part), element)
    return out


def prefix_hashes(code: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a hash of each code point and its place from the front, and of each
    and its place from the back: a piece of a word has the difference of two of them."""
    place = np.arange(len(code)) - np.repeat(starts, size)
    rest = np.repeat(size, size) - place
    out = []
    for spot in (place, rest):
        h = mix(code.astype(np.uint64) * ONE + mix(spot.astype(np.uint64) + np.uint64(1)))
        out.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)]))
    return out[0], out[1]


def signatures(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, key) of all keys under which words meet. Even keys are for words
    of one length, odd ones for a word and a longer one."""
    names = words.to_pylist()
    code = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.array([len(x) for x in names], np.int64)
    starts = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(names)), size)
    front, back = prefix_hashes(code, starts, size)
    keys = []

    def add(kind: int, length: np.ndarray, rest: np.ndarray, letters: np.ndarray) -> None:
        own = mix(length.astype(np.uint64) + np.uint64(kind << 32))
        key = mix(mix(rest + own) + letters)
        keys.append(key >> np.uint64(1) << np.uint64(1) | np.uint64(kind & 1))

    def piece(sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return sums[starts + high] - sums[starts + low]

    same = part_sums(code, owner, len(names), SAME_PARTS)
    whole = same.sum(axis=1, dtype=np.uint64)
    none, cuts = np.zeros(len(names), np.int64), [size * i // 3 for i in range(4)]
    for third in range(3):
        rest = piece(front, none, cuts[third]) + piece(front, cuts[third + 1], size)
        for i in range(SAME_PARTS):
            for j in range(i + 1, SAME_PARTS):
                add(2 * (100 * third + 10 * i + j), size, rest, whole - same[:, i] - same[:, j])
    more = part_sums(code, owner, len(names), MORE_PARTS)
    whole = more.sum(axis=1, dtype=np.uint64)
    for shorter in (size, size - 1):
        half = shorter // 2
        for which, rest in enumerate((piece(front, none, half), piece(back, size - (shorter - half), size))):
            for i in range(MORE_PARTS):
                add(2 * (10 * which + i) + 1, shorter, rest, whole - more[:, i])
    return np.tile(np.arange(len(names)), len(keys)), np.concatenate(keys)


def _signed(batches):
    for batch in batches:
        if batch.num_rows:
            place, key = signatures(batch.column("word"))
            own = batch.take(pa.array(place))
            yield pa.RecordBatch.from_arrays(
                [own.column("word"), own.column("n"), pa.array(key.view(np.int64))], ["word", "n", "key"]
            )


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n): each pair of near words of (word, n), which are distinct, once."""
    signed = words.select("word", "n").mapInArrow(_signed, "word string, n long, key long")
    a, b = (signed.select("key", F.col("word").alias(x), F.col("n").alias(f"{x}_n")) for x in "ab")
    odd = F.col("key").bitwiseAND(1) == 1
    # Spark sizes the keys by the file of the words, of which each word has many
    met = a.hint("merge").join(b, "key").filter(
        (~odd & (F.col("a") < F.col("b"))) | (odd & (F.length("a") + 1 == F.length("b")))
    )
    close = met.filter(F.levenshtein("a", "b", 1) == 1)
    return close.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of distinct words (word, n)."""
    pairs = near_pairs(words)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("m")),
    )
    best = (
        pairs.select(F.explode(both).alias("p"))
        .groupBy(F.col("p.word").alias("word"))
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("p.m")).alias("m"), F.col("p.near").alias("near"))).alias("best"),
        )
    )
    rises = -F.col("best.m") >= RISE * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(rises, F.col("best.near")).alias("form"),
        F.when(rises, -F.col("best.m")).alias("form_n"),
    )


def rooted(table: DataFrame) -> DataFrame:
    """table (word, form, ...) with the root of each word: forms followed to the last. Files
    of words are far smaller than their rows in memory, so no side is sent to the tasks."""
    steps = table.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("to"))
    while True:
        steps = materialize(steps, "steps")
        ahead = steps.select(F.col("word").alias("to"), F.col("to").alias("further"))
        wider = steps.hint("merge").join(ahead, "to", "left")
        if wider.filter(F.col("further").isNotNull()).isEmpty():
            break
        steps = wider.select("word", F.coalesce("further", "to").alias("to"))
    return table.hint("merge").join(steps, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of docs."""
    words = materialize(counted(docs, key, text), "words")
    table = materialize(forms(words), "forms")
    return rooted(table).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
p AS (SELECT doc, run, count(*) AS c FROM d WHERE length(run) >= 5 GROUP BY ALL),
-- crc32 of the bytes of doc:run, bit by bit; letters above 0x7F have two bytes
y AS (
  SELECT doc, run, c, list_concat(
    list_transform(string_split(doc || ':', ''), lambda x: ord(x)::BIGINT),
    flatten(list_transform(string_split(run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT]
      ELSE [192 + (ord(x) >> 6)::BIGINT, 128 + (ord(x) & 63)::BIGINT] END))) AS bytes
  FROM p),
h AS (
  SELECT run, c, xor(list_reduce(bytes, lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
    lambda r, _: xor(r >> 1, (r & 1) * 3988292384), xor(a, b)), 4294967295::BIGINT), 4294967295) AS h
  FROM y),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, sum(c)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
-- words with one code point left out: two of one length are near if they agree after leaving
-- out the same place, a shorter one is near if it is what is left of a longer one
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM w),
o AS (SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest FROM x),
e AS (
  SELECT a.word, b.word AS near, b.n AS m FROM o a JOIN o b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT o.word, w.word, w.n FROM o JOIN w ON o.rest = w.word
  UNION SELECT w.word, o.word, o.n FROM o JOIN w ON o.rest = w.word),
g AS (SELECT word, count(*) AS n_near, max(m) AS top, first(near ORDER BY m DESC, near) AS near FROM e GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN g.top >= 2 * w.n THEN g.near END AS form,
    CASE WHEN g.top >= 2 * w.n THEN g.top END AS form_n
  FROM w LEFT JOIN g USING (word)),
r AS (
  WITH RECURSIVE walk(word, spot, step) AS (
    SELECT word, word, 0 FROM f
    UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN f ON f.word = walk.spot WHERE f.form IS NOT NULL)
  SELECT word, first(spot ORDER BY step DESC) AS root FROM walk GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r USING (word)
"""

QUERIES = {"op11_spelling": (op11_spelling, SQL)}
