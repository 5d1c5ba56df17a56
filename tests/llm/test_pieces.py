import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from marlspike.llm import pieces
from tests.llm.support import docs, write

TEXTS = [
    None, "", " ", "  ", "a", "a b", "  a   b  ", "\n\t x\r\n", "\x00\x01", "<s> </s> <unk> <0x0A>", "▁", "a▁b", "▁▁ ▁a",
    "é é ① ﬁ 梦 🙂🙂", "　x y", "word " * 5000, "x" * 5000, "ab" * 3000, " " * 40 + "z", "￿\U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def own():
    return pieces.Vocabulary(pieces.model_path())


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(library, own, text):
    ids = own.encode(text or "")
    assert ids == library.encode(text or "")
    assert own.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁abcdeth.,\n"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text(text):
    own, library = pieces.vocabulary(pieces.model_path()), None
    library = own.library
    ids = own.encode(text)
    assert ids == library.encode(text)
    assert own.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(3, 258)), max_size=12))
def test_any_ids(ids):
    own = pieces.vocabulary(pieces.model_path())
    assert own.decode(ids) == own.library.decode(ids)


def test_query(spark, tmp_path, library):
    rows = list(enumerate(TEXTS)) + [(3, "  "), (None, "a b")]
    folder = write(docs(spark, rows, ["ids", "n_tokens", "doc"]), tmp_path)
    got = sorted((tuple(r) for r in pieces.op2_sentencepiece(spark, folder).collect()), key=str)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for key, text in rows:
        ids = library.encode(text or "")
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=str)


def test_round_trip_and_no_rows(spark):
    table = docs(spark, [(1, "to  and fro\n"), (2, None)])
    assert sorted(map(tuple, pieces.decode(pieces.encode(table)).collect())) == [(1, "to  and fro\n"), (2, "")]
    assert pieces.digests(docs(spark, [])).count() == 0


def test_a_difference_is_an_error(own, monkeypatch):
    wrong = lambda found: (np.full(len(found), 5, np.int32), np.arange(1, len(found) + 1))
    monkeypatch.setattr(own, "merge_all", wrong)
    with pytest.raises(ValueError, match="differs"):
        own.encode("a stretch \x02 not met before")


def test_single_merge_equals_rows(own):
    words = ["▁the", "▁▁▁x", "▁" + "tion" * 7, "▁été", "▁a", "▁▁", "▁", "x", "梦", "☃"]
    ids, ends = own.merge_all(words)
    assert [tuple(x) for x in np.split(ids, ends[:-1])] == [own.merge(w) for w in words]
