import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marlspike.llm import packing
from marlspike.llm.packing import Capacity
from tests.llm.support import docs, write

TEXTS = [
    None, "", " ", "a", "A b\tc", "It's 12²ª, we'll DON'T!", "héÉ ÀÖØß µ×÷", "x" * 9000, "word " * 5000, "\x00\x1c\x85\xa0y",
    "<|endoftext|> in a text <|x", "‘quoted’ Ωμέγας İ é 中文字 🙂", "line\nline\r\nline", "' 's'S ''re", "�\U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return packing.Words(packing.tokenizer_path())


def test_ids_equal_the_library(library, own):
    found = own.ids([x or "" for x in TEXTS])
    assert [x.tolist() for x in found] == [library.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


def test_a_stretch_is_encoded_once(library, monkeypatch):
    """The work follows the distinct stretches between blanks, not the words of all texts."""
    texts = ["déjà vu, it's 中文 here", "中文 IT'S\nhere"] * 200

    class Library:
        calls = 0

        def encode(self, text, **kind):
            Library.calls += 1
            return library.encode(text, **kind)

    class Cutter:
        signs = 0

        def findall(self, text, found=packing.WORDS.findall):
            Cutter.signs += len(text)
            return found(text)

    own = packing.Words(packing.tokenizer_path())
    own.library = Library()
    monkeypatch.setattr(packing, "WORDS", Cutter())
    found = own.ids(texts)
    assert [x.tolist() for x in found] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert Library.calls == 1 and Cutter.signs <= len(" ".join(texts[:2]))


def test_marks_stay_with_their_letters(library, own):
    """Upper case that composes with a mark only in lower case, and stretches in any order."""
    texts = ["H\u0331 h\u0331 J\u030c A\u030a a", "a\u0301 b\u3000c", "Σ ΑΣ ΑΣ. a", "", "中 a 中 b", "<|x Ω", "Ω <|endoftext|>"]
    for some in (texts, texts[::-1], ["Ω"], ["a"], [""], []):
        assert [x.tolist() for x in own.ids(some)] == [library.encode(x, add_special_tokens=False).ids for x in some]


def test_forgotten_words_are_found_again(library, monkeypatch):
    monkeypatch.setattr(packing, "MOST_KEPT", 2)
    own = packing.Words(packing.tokenizer_path())
    for text in ("one two three 中", "three four", "中 one two"):
        assert own.ids([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.kept) <= 6


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" 'strevmld.,<|\n"), st.characters(max_codepoint=255)), max_size=40))
def test_any_latin_text(text):
    own = packing.words_of(packing.tokenizer_path())
    assert own.ids([text])[0].tolist() == own.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    own = packing.words_of(packing.tokenizer_path())
    text = text.encode("utf-8", "ignore").decode()
    assert own.ids([text])[0].tolist() == own.library.encode(text, add_special_tokens=False).ids


def checked(rows, capacity):
    """Every sequence is gapless and within all capacities; returns their number."""
    tokens, documents, cost = capacity.limits()
    held = defaultdict(list)
    for row in rows:
        held[row.sequence_id].append((row.offset, row.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens and len(parts) <= documents and sum(x * x for _, x in parts) <= cost
    return len(held)


def test_query_returns_every_piece_once(spark, tmp_path, library):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (3, "a"), (None, "two  words")]
    folder = write(docs(spark, rows, ["piece", "length", "doc", "number", "sequence_id"]), tmp_path)
    found = packing.op13_packing(spark, folder).collect()
    expected = Counter()
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            expected[key, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    total = sum(k[3] * n for k, n in expected.items())
    assert checked(found, Capacity()) == math.ceil(total / 2048)


def test_every_capacity_binds(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(0, 60, 400))]
    for capacity in (Capacity(100), Capacity(100, documents=3), Capacity(100, cost=4000), Capacity(64, 5, 900)):
        for measure in ("norm", "dot"):
            found = packing.pack_documents(docs(spark, rows), capacity, (1.0, 0.5, 0.5), measure).collect()
            assert sum(r.length for r in found) == sum(len(t.split()) + 1 for _, t in rows)
            used = checked(found, capacity)
            tokens, documents, cost = capacity.limits()
            least = max(
                sum(r.length for r in found) / tokens, len(found) / documents, sum(r.length**2 for r in found) / cost
            )
            assert least <= used <= 1.25 * least + 2


def one_by_one(lengths, capacity):
    """Best-fit decreasing by the residual tokens, a piece at a time."""
    room = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(room) if r >= length]
        if fitting:
            room[min(fitting, key=lambda i: room[i])] -= length
        else:
            room.append(capacity - length)
    return len(room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_patterns_are_those_of_best_fit(lengths):
    patterns = packing.best_fit(Counter(lengths), Capacity(20))
    assert sum(n for n, _ in patterns) == one_by_one(lengths, 20)
    again = Counter()
    for n, content in patterns:
        assert sum(k * v for k, v in content.items()) <= 20
        for length, each in content.items():
            again[length] += n * each
    assert again == Counter(lengths)


def test_large_counts_make_a_small_plan():
    rng = np.random.default_rng(1)
    counts = {i: int(rng.integers(1, 10**9)) for i in range(1, 2049)}
    patterns = packing.best_fit(counts, Capacity())
    total = sum(k * v for k, v in counts.items())
    least = max(total / 2048, sum(n for k, n in counts.items() if k > 1024))  # two long ones share none
    assert len(patterns) <= 3 * 2048 and sum(n for n, _ in patterns) <= 1.05 * least


def test_sequences_hold_the_ids(spark, library):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(30)]
    packed = packing.pack_documents(docs(spark, rows), Capacity(32), keep_ids=True)
    texts = {key: [*library.encode(text, add_special_tokens=False).ids, 0] for key, text in rows}
    pieces = defaultdict(dict)
    for row in packed.collect():
        pieces[row.doc][row.start] = row.ids
    assert {k: [i for s in sorted(v) for i in v[s]] for k, v in pieces.items()} == texts
    for row in packing.sequences(packed).collect():
        assert len(row.ids) <= 32 and row.offsets[0] == 0 and len(row.docs) == len(row.offsets)


def test_no_rows_and_bad_values(spark):
    assert packing.pack_documents(docs(spark, [])).count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        Capacity(0).limits()
    with pytest.raises(ValueError, match="measure"):
        packing.best_fit({1: 1}, Capacity(), measure="first")
