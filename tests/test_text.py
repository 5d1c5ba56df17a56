import math
import random
from collections import Counter

import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlspike.operators import discover
from marlspike.operators import text as T


def cut(spark, value, **how):
    df = spark.createDataFrame([(value,)], "t string")
    return T.tokenize(df, "t", **how).first()["tokens"]


def test_unicode(spark):
    assert cut(spark, "Éa, b1-C\n  ünï") == ["éa", "b1", "c", "ünï"]
    assert cut(spark, None) == [] and cut(spark, "。！") == []


def test_pairs(spark):
    assert cut(spark, "我爱北京Python和C++", mode="cjk_bigram") == ["我爱", "爱北", "北京", "python", "和", "c"]


def test_search(spark):
    found = cut(spark, "工信处女 ab", mode="unicode", search=True)
    assert found == ["工信", "信处", "处女", "工信处", "信处女", "工信处女", "ab"]


def test_dictionary(spark):
    words = spark.createDataFrame([("北京",), ("北京大学",), ("大学生",), ("学生",)], "w string")
    assert cut(spark, "我在北京大学生活 ok", mode="dict", dictionary=words) == [
        "我", "在", "北京大学", "生", "活", "ok",
    ]
    assert cut(spark, "北京大学", mode="dict", dictionary=words, search=True) == ["北京", "北京大学"]
    with pytest.raises(ValueError):
        cut(spark, "x", mode="dict")


def best_paths(run, often):
    """Every cut of a run into dictionary words and single signs, best first: by the sum of
    the scores, then by the sizes from the front, longer first."""
    total = sum(often.values()) or 1
    score = lambda w: round(1000 * math.log(often.get(w, 1) / total))

    def cuts(at):
        if at == len(run):
            yield ()
        for end in range(at + 1, len(run) + 1):
            if end == at + 1 or run[at:end] in often:
                for rest in cuts(end):
                    yield (run[at:end], *rest)

    return max(cuts(0), key=lambda c: (sum(map(score, c)), [len(w) for w in c]))


OFTEN = {"北京": 40, "北京大学": 6, "大学生": 9, "大学": 30, "学生": 25, "生活": 20, "京大学": 1, "活": 7, "学": 3}


@pytest.mark.parametrize("signs", [1 << 20, 5])
@pytest.mark.parametrize("search", [False, True])
def test_lattice_equals_every_cut(spark, monkeypatch, search, signs):
    """Whatever the number of shards, and with rows and keys that repeat."""
    monkeypatch.setattr(T, "SHARD_SIGNS", signs)
    words = spark.createDataFrame([*OFTEN.items(), ("北京", 2), ("", 5), ("没有", None)], "w string, n long")
    often = OFTEN | {"没有": 1}
    texts = ["我在北京大学生活 ok", "北京大学，大学生 x1", "", None, "学", "生活北京北京大", "abc", "北京大学生活北京大学生活", "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    held = T.tokenize(df, "t", mode="dict", dictionary=words, search=search).collect()
    for row in held:
        want = []
        for run in regex.findall(r"\p{Han}+|[a-z0-9]+", texts[row["k"]] or ""):
            for token in best_paths(run, often) if regex.match(r"\p{Han}", run) else (run,):
                if search and regex.match(r"\p{Han}", run):
                    for gram in (2, 3):
                        if len(token) > gram:
                            parts = [token[i : i + gram] for i in range(len(token) - gram + 1)]
                            want += [p for p in parts if p in often]
                want.append(token)
        assert row["tokens"] == want, texts[row["k"]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="天地人", max_size=9), st.dictionaries(st.text(alphabet="天地人", min_size=1, max_size=4), st.integers(1, 50)))
def test_best_path_is_best(run, often):
    total = sum(often.values()) or 1
    score = lambda w: round(1000 * math.log(often.get(w, 1) / total))
    words = [{e - i: score(run[i:e]) for e in range(i + 1, len(run) + 1) if run[i:e] in often} for i in range(len(run))]
    assert tuple(T._best_path(run, words, score("?"), False)) == best_paths(run, often)


@pytest.mark.parametrize("signs", [1_000_000, 1])
def test_one_rule_for_the_script(spark, monkeypatch, signs):
    """Signs of the script outside the usual code ranges are cut like the others."""
    monkeypatch.setattr(T, "SHARD_SIGNS", signs)
    words = spark.createDataFrame([("〇一",)], "w string")
    df = spark.createDataFrame([(1, "〇一二 々")], "k int, t string")
    assert T.tokenize(df, "t", mode="dict", dictionary=words).first()["tokens"] == ["〇一", "二", "々"]


def test_no_dictionary_words(spark):
    none = spark.createDataFrame([], "w string, n long")
    assert cut(spark, "北京 ok", mode="dict", dictionary=none) == ["北", "京", "ok"]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_stopwords_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(T, "MAX_STOPWORDS", limit)
    rows = [(1, ["a", "b", "a", "C", "c"]), (1, ["c", "the"]), (2, ["b"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "k int, tokens array<string>")
    stop = spark.createDataFrame([("b",), ("c",), ("c",)], "w string")
    found = sorted(((r["k"], r["tokens"]) for r in T.remove_stopwords(df, "tokens", stop).collect()), key=str)
    assert found == [(1, ["a", "a", "C"]), (1, ["the"]), (2, []), (3, []), (4, None)]


def test_word_discovery(spark):
    """Against counts in plain Python."""
    rng = random.Random(4)
    words = ["天地", "山水火", "木", "金", "土日月星", "云"]
    texts = ["".join(rng.choice(words) for _ in range(30)) + "x" for _ in range(40)] + [None, "", "abc", "云"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r["word"]: tuple(r)[1:] for r in discover.discover_words(df, "t", 4, 20, 0.3, 0.4).collect()}
    n, beside = Counter(), {"left": {}, "right": {}}
    for run in (r for t in texts for r in regex.findall(r"\p{Han}+", t or "")):
        for i in range(len(run)):
            for size in range(1, min(4, len(run) - i) + 1):
                w = run[i : i + size]
                n[w] += 1
                beside["left"].setdefault(w, Counter())[run[i - 1] if i else ""] += 1
                beside["right"].setdefault(w, Counter())[run[i + size : i + size + 1]] += 1
    total = sum(c for w, c in n.items() if len(w) == 1)
    want = {}
    for w, c in n.items():
        if len(w) > 1 and c >= 20:
            held = min(math.log(c * total / (n[w[:k]] * n[w[k:]])) for k in range(1, len(w)))
            ent = [math.log(c) - sum(x * math.log(x) for x in beside[s][w].values()) / c for s in ("left", "right")]
            if held >= 0.3 and min(ent) >= 0.4:
                want[w] = (c, held, *ent)
    assert found.keys() == want.keys() and {"天地", "山水火", "土日月星"} <= found.keys()
    assert all(found[w] == pytest.approx(want[w]) for w in want)
    assert discover.discover_words(df.limit(0), "t").count() == 0


def test_vocabulary(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c"],), (["c", "d"],)], "tokens array<string>")
    whole = {r["token"]: r["idx"] for r in T.build_vocab(df, "tokens").collect()}
    assert whole == {"b": 1, "c": 2, "a": 3, "d": 4}
    some = {r["token"]: r["idx"] for r in T.build_vocab(df, "tokens", 2, remove_top_n=1).collect()}
    assert some == {"c": 1, "a": 2}


def test_wide_tokens(spark):
    df = spark.createDataFrame([(1, ["b", "x", "a", "b"]), (2, []), (3, ["x"])], "k int, tokens array<string>")
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, idx int")
    found = {r["k"]: tuple(r)[1:] for r in T.tokens_to_wide(df, "k", "tokens", vocab, n=3).collect()}
    assert found == {1: (2, 0, 1), 2: (0, 0, 0), 3: (0, 0, 0)}
    ids = {r["k"]: r["idx"] for r in T.tokens_to_ids(df, "k", "tokens", vocab).collect()}
    assert ids == {1: [2, 1, 2], 2: [], 3: []}


def test_pad(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), ([1, 2, 3, 4, 5, 6],)], "a array<int>")
    assert [r[0] for r in df.select(T.pad_sequence("a", 4)).collect()] == [[1, 2, 3, 0], [0] * 4, [3, 4, 5, 6]]
    assert df.select(T.pad_sequence("a", 4, "post")).collect()[2][0] == [1, 2, 3, 4]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_pooling(spark, monkeypatch, limit):
    monkeypatch.setattr(T, "MAX_EMBEDDINGS", limit)
    df = spark.createDataFrame([(1, ["a", "b", "a", "x"]), (2, ["x"])], "k int, tokens array<string>")
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 3.0])], "token string, embedding array<double>")
    found = T.pool_embeddings(df, "k", "tokens", table, dim=2).collect()
    assert [(r["k"], r["pooled"], r["n_tokens"]) for r in found] == [(1, [2.0, 1.0], 3)]


def test_corpus(spark):
    rows = [(str(i), f"c{i}", "" if i % 10 == 0 else f"word{i} __label__1", 1 if i % 3 else 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, company_name string, text string, label int")
    made = T.build_text_corpus(df, seed=1)
    train, valid = made["train"].collect(), made["valid"].collect()
    assert not {r["id"] for r in train} & {r["id"] for r in valid}
    per = {c: sum(r["label"] == c for r in train + valid) for c in (1, 2)}
    assert per[1] == per[2] == df.where("label = 2 and text <> ''").count()
    assert made["all"].where("value = ''").count() == 30
    assert made["index"].where("value = '(7,c7)'").count() == 1


def test_prepare(spark):
    base = spark.createDataFrame([("b", 1), ("a", 2)], "name string, y int")
    texts = spark.createDataFrame([("a", "x", None), ("z", "q", "r")], "name string, t string, u string")
    found = T.prepare_text(base, texts, "name", ["t", "u"], "y").collect()
    assert {tuple(r) for r in found} == {("a", "x,", 2, "1"), ("b", "", 1, "2")}


def test_long_text_is_whole(spark):
    df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30000)), lambda i: F.concat(F.lit("w"), i)), " ").alias("t"))
    assert len(T.tokenize(df, "t").first()["tokens"]) == 30000


def test_a_long_vocabulary_is_numbered_like_a_short_one(spark, monkeypatch):
    df = spark.range(300).select(F.transform(F.sequence(F.lit(0), F.col("id") % 40), lambda i: F.concat(F.lit("w"), i)).alias("t"))
    short = sorted(map(tuple, T.build_vocab(df, "t", max_words=20, remove_top_n=3).collect()))
    monkeypatch.setattr(T, "MAX_VOCABULARY", 10)
    found = T.build_vocab(df, "t", max_words=20, remove_top_n=3)
    assert sorted(map(tuple, found.collect())) == short and len(short) == 20


def test_long_stop_list_moves_stop_words_only(spark):
    """Order, repeats, empty and null arrays stay; what meets the list is little more than it."""
    rows = [(1, ["a", "x", "b", "a", "y"]), (2, ["x"]), (3, []), (4, None), (5, ["b", None, "b"]), (6, ["y", "y", "a"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    stop = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "word string")
    found = T._stop_places(df, "tokens", stop, "id")
    assert sorted(map(tuple, found.select("id", "_pos", "_token").collect())) == [
        (1, 1, "x"), (1, 4, "y"), (2, 0, "x"), (6, 0, "y"), (6, 1, "y"),
    ]
    kept = {r["id"]: r["tokens"] for r in T._without(df, "tokens", stop, "id", "tokens").collect()}
    assert kept == {1: ["a", "b", "a"], 2: [], 3: [], 4: None, 5: ["b", "b"], 6: ["a"]}


def test_lattices_are_held_in_portions(monkeypatch):
    monkeypatch.setattr(T, "LATTICE_SIGNS", 4)
    assert list(T._portions(["天地", "人山", "水", "火木金土日", "月"])) == [["天地", "人山"], ["水", "火木金土日"], ["月"]]
    assert list(T._portions([])) == []


def test_pooling_in_shards(spark, monkeypatch):
    """A table in several shards gives the means of the whole table, in one row a key."""
    df = spark.createDataFrame([(i, [f"t{j % 9}" for j in range(i + 1)] + ["none"]) for i in range(12)], "id long, tokens array<string>")
    table = spark.createDataFrame([(f"t{j}", [float(j), j * 0.5]) for j in range(9)], "token string, embedding array<double>")
    monkeypatch.setattr(T, "MAX_EMBEDDINGS", 2)
    monkeypatch.setattr(T, "SHARD_BYTES", 48)  # three shards
    found = {r["id"]: r for r in T.pool_embeddings(df, "id", "tokens", table, 2).collect()}
    assert len(found) == 12
    for i, row in found.items():
        own = [j % 9 for j in range(i + 1)]
        assert row["n_tokens"] == len(own) and row["pooled"] == pytest.approx([sum(own) / len(own), sum(own) / len(own) / 2])


def test_tokens_of_a_batch_come_in_parts(monkeypatch):
    """However many rows a batch has, the tokens of about LATTICE_SIGNS signs are held at once."""
    class Shard:
        value = (0, ["天地", "地人"], [-1, -2])

    rows = [["天地人天" * (i % 5)] * (i % 3) + ["ok"] for i in range(200)] + [[], ["天" * 500], ["地人"]]
    batch = pa.array([[], ["x"], *rows], pa.list_(pa.string())).slice(2)
    (whole,) = T._tokens(batch, [Shard()], -9, True)
    monkeypatch.setattr(T, "LATTICE_SIGNS", 100)
    parts = list(T._tokens(batch, [Shard()], -9, True))
    assert sum((x.to_pylist() for x in parts), []) == whole.to_pylist()
    assert whole[1].as_py() == ["天地", "人", "天", "ok"]
    signs = [sum(len(t) for row in x.to_pylist() for t in row) for x in parts]
    assert len(parts) > 20 and sorted(signs)[-2] < 200
    assert [len(x) for x in T._tokens(batch.slice(0, 0), [Shard()], -9, True)] == [0]
