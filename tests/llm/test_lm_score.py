import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlspike.llm import lm_score
from tests.llm.support import docs, write

ROWS = [
    (i, t) for i, t in enumerate(
        ["The cat sat on the mat", "the dog sat on THE log\n\n", None, "", " \t ", "é É x", "the cat sat", "word " * 9000,
         "the cat sat on the mat", "a b c d e f g the cat", "never\x0bseen\x0cwords here", "the the the the"] * 3
    )
] + [(5, "the same id again"), (None, "the cat")]


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in low.encode().split()] + [None]


def learns(key):
    return key is None or zlib.crc32(str(key).encode()) % 10 != 0


def brute(rows):
    count = Counter(t for k, x in rows if learns(k) for t in tokens(x))
    total, kinds = sum(count.values()), len(count)
    out = []
    for key, text in rows:
        own = tokens(text)
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)
        out.append((key, not learns(key), len(own), sum(count[t] > 0 for t in own), total, round(base, 6)))
    return sorted(out, key=str)


def exact_scores(rows):
    """The model with exact counts, quantised as the filter does."""
    one, two, texts = Counter(), Counter(), 0
    for key, text in rows:
        if learns(key):
            own = tokens(text)
            texts += 1
            one.update(own)
            two.update(zip([None, *own], own))
    total, kinds = sum(one.values()), len(one)

    def quantised(count):
        return 1.5 * 2 ** int(math.log2(count)) - 0.5 if count else 0.0

    def single(t):
        return texts if t is None else quantised(one[t])

    out = []
    for key, text in rows:
        value = 0.0
        for h, w in zip([None, *tokens(text)], tokens(text)):
            alone = min(1.0, (single(w) + 0.1) / (total + 0.1 * (kinds + 1)))
            both = min(quantised(two[h, w]), single(h))
            value += math.log10(min(1.0, (both + lm_score.MU * alone) / (single(h) + lm_score.MU)))
        out.append((key, value))
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r)[:5] + (round(r.base_score, 6),) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return write(docs(spark, ROWS, ["uid", "rare", "digest", "score", "word", "c"]), tmp_path_factory.mktemp("lm"))


def test_exact_columns(spark, folder):
    assert plain(lm_score.op4_lm_score(spark, folder)) == brute(ROWS)


def test_rare_words_give_the_same_base(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    found = lm_score.score(table, ~lm_score.held_out(F.col("doc_id")), head=2)
    got = sorted(((r.doc, r.n_tokens, r.n_known, round(r.base, 6)) for r in found.collect()), key=str)
    assert got == sorted([(k, n, m, b) for k, _, n, m, _, b in brute(ROWS)], key=str)


def test_scores_and_rounds(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    learn = ~lm_score.held_out(F.col("doc_id"))
    once = sorted(((r.doc, r.score) for r in lm_score.score(table, learn).collect()), key=str)
    want = exact_scores(ROWS)
    assert [k for k, _ in once] == [k for k, _ in want]
    # a false hit of the filter is rare but allowed
    assert np.mean([abs(a - b) < 1e-6 for (_, a), (_, b) in zip(once, want)]) > 0.9
    many = lm_score.score(table, learn, segment=500, most_bytes=64)
    apart = sorted(((r.doc, r.score) for r in many.collect()), key=str)
    assert len(apart) == len(once)
    few = lm_score.score(table, learn, segment=500)
    together = sorted(((r.doc, r.score) for r in few.collect()), key=str)
    assert [k for k, _ in apart] == [k for k, _ in together]
    assert [x for _, x in apart] == pytest.approx([x for _, x in together])


def test_no_rows_and_no_training(spark):
    empty = docs(spark, [])
    assert lm_score.score(empty, F.lit(True)).count() == 0
    row = lm_score.score(docs(spark, [(1, "a b")]), F.lit(False)).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base, row.score) == (3, 0, 0, 0.0, 0.0)


def test_filter_finds_all_and_little_else():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    counts = rng.integers(1, 40, 20_000)
    held = lm_score.Filter(64, 0, [lm_score.fill_segment(keys, counts)])
    found = held.levels(keys)
    assert (found >= lm_score.levels_of(counts)).all()
    assert (found == lm_score.levels_of(counts)).mean() > 0.97
    assert (held.levels(rng.integers(0, 2**63, 20_000, dtype=np.uint64)) > 0).mean() < 0.02


def test_bigrams_that_occur_once_count(spark):
    """Of two texts of the same words the one whose word pair was met once scores higher."""
    rows = [(1, "north south"), (2, "east"), (3, "west")] + [(i, "filler") for i in range(11, 60)]
    table = docs(spark, rows + [(100, "north south"), (101, "south north")])
    found = {r.doc: r.score for r in lm_score.score(table, F.col("doc_id") < 100).collect()}
    assert found[100] > found[101]


def test_the_head_is_bounded_in_bytes(spark):
    counts = spark.createDataFrame([("x" * 5000, 99), ("ab", 50), ("cd", 50), ("ef", 3)], "word string, c long")
    assert {r.word for r in lm_score.most_frequent(counts, 10).collect()} == {"ab", "cd", "ef"}
    assert {r.word for r in lm_score.most_frequent(counts, 10, 5).collect()} == {"ab", "cd"}
    assert lm_score.most_frequent(counts, 10, 3).count() == 0


def test_texts_are_read_as_often_whatever_the_filter(spark):
    """Texts are not read again for each part of a filter that is too large to be sent."""
    reads = []
    for most_bytes in (1 << 12, 64):
        read = spark.sparkContext.accumulator(0)

        def seen(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        table = docs(spark, ROWS)
        table = table.mapInArrow(seen, table.schema)
        found = lm_score.score(table, ~lm_score.held_out(F.col("doc_id")), segment=500, most_bytes=most_bytes)
        assert len(found.collect()) == len(ROWS)
        reads.append(read.value)
    assert reads[0] == reads[1] <= 4 * len(ROWS)


def test_many_packs_give_the_same_scores(spark, monkeypatch):
    """A filter that is not sent scores as the model does, however the texts are packed."""
    rows = [*ROWS, (77, "cat " * 300 + "é"), (None, None)]
    want = [x for _, x in exact_scores(rows)]
    for pack in (1, 200, 10**7):
        monkeypatch.setattr(lm_score, "PACK", pack)
        found = lm_score.score(docs(spark, rows), ~lm_score.held_out(F.col("doc_id")), head=3, segment=100, most_bytes=64)
        got = found.collect()
        assert sorted(((r.doc, r.n_tokens, r.n_known, round(r.base, 6)) for r in got), key=str) == sorted(
            [(k, n, m, b) for k, _, n, m, _, b in brute(rows)], key=str
        )
        scores = [x for _, x in sorted(((r.doc, r.score) for r in got), key=str)]
        assert np.mean([abs(a - b) < 1e-6 for a, b in zip(scores, want)]) > 0.9


def test_values_come_back():
    for kind in ("<u4", "<u8", np.uint8):
        for values in ([], [0, 255, 7], [np.iinfo(kind).max, 1]):
            found = lm_score.unpacked(lm_score.packed(np.array(values, kind)), len(values), kind)
            assert found.tolist() == values
