import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from marlspike.llm import spelling
from marlspike.session import materialize
from tests.llm.support import docs, write


def edited(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if x.isascii() else x for x in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if edited(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


ROWS = [
    (1, "colour colour colour Colour COLOUR color color color colors colors colors"),
    (2, "colour colour colour, colour. colour; colour! colour? colour"),
    (3, "colours colours colours éclair Éclair ÉCLAIR éclair eclair eclair eclair"),
    (4, None),
    (5, ""),
    (5, "listen silent enlist tinsel " * 3),
    (5, "listen silent enlist tinsel " * 3),
    (None, "aaaaa aaaaa aaaaa aaaab aaaab aaaab aaaaaa aaaaaa aaaaaa baaaa baaaa baaaa"),
    (6, "straße straße straße strasse strasse strasse ×÷×÷× " * 2),
    (7, "x" * 100_000 + " " + "x" * 99_999 + " word9word word_word 中文字符串"),
    (8, ("x" * 100_000 + " " + "x" * 99_999 + " ") * 2),
    (9, "\n\t \x00 abcde\x00abcde\x00abcde ábcde"),
]


def got(table):
    return sorted(map(tuple, table.collect()))


def test_query_equals_brute_force(spark, tmp_path):
    folder = write(docs(spark, ROWS, ["word", "n", "key"]), tmp_path)
    assert got(spelling.op11_spelling(spark, folder)) == brute(ROWS)


@pytest.mark.parametrize("seed", range(3))
def test_dense_words_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join("".join(rng.choice(list("aabéc"), rng.integers(4, 9))) for _ in range(150))) for i in range(40)]
    expected = brute(rows)
    assert any(x[1] for x in expected) and got(spelling.variants(docs(spark, rows))) == expected


def test_no_rows(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, "few words here once only")])).columns == [
        "word", "form", "root", "n", "n_near", "form_n"
    ]


def test_long_chains_of_forms(spark):
    chain = [("a" * i + "bbbbbb" + "c" * (20 - i), 2**i * 3) for i in range(12)]
    steps = [(w, n, n2) for (w, n), (n2, _) in zip(chain, chain[1:] + [(None, 0)])]
    table = materialize(spark.createDataFrame(steps, "word string, n long, form string"), "chain")
    assert {r.root for r in spelling.rooted(table).collect()} == {chain[-1][0]}


LETTERS = st.text(alphabet="abcé", min_size=5, max_size=12)


@settings(max_examples=400, deadline=None)
@given(LETTERS, st.data())
def test_every_edit_shares_a_signature(word, data):
    at = data.draw(st.integers(0, len(word) - 1))
    letter = data.draw(st.sampled_from("abcéd"))
    kind = data.draw(st.sampled_from(["replace", "insert"]))
    other = word[:at] + letter + word[at + (kind == "replace") :]
    if other != word:
        place, key = spelling.signatures(pa.array([word, other]))
        assert set(key[place == 0].tolist()) & set(key[place == 1].tolist())


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=20), st.binary(max_size=300))
def test_crc_of_joined_parts(one, two):
    found = spelling.crc_joined(
        np.array([zlib.crc32(one)], np.uint32), np.array([zlib.crc32(two)], np.uint32), np.array([len(two)])
    )
    assert int(found[0]) == zlib.crc32(one + two)


def test_words_are_not_sent_to_the_tasks(spark):
    """A file of words says little about the size of all their keys."""
    rows = [(f"word{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")), 3 + i % 7) for i in range(500)]
    words = materialize(spark.createDataFrame(rows, "word string, n long"), "words")
    pairs = spelling.near_pairs(words)
    assert pairs.count() > 500
    assert "Broadcast" not in pairs._jdf.queryExecution().toString()
