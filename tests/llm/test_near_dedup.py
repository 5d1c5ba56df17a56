import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlspike.llm import components, near_dedup
from tests.llm.support import docs, write


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return low.encode().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return sorted(((k, len(sets[i]), low.get(find(i)), k == low.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def edited(rng, base, times):
    w = base.split()
    for _ in range(times):
        at = rng.randrange(len(w))
        w[at : at + 1] = rng.choice([[], ["new%d" % rng.randrange(10**6)], [w[at], "more"]])
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    text = lambda n: " ".join("w%d" % rng.randrange(3000) for _ in range(n))
    out = []
    for size, copies in ((60, 70), (200, 40), (30, 12)):
        base = text(size)
        out += [edited(rng, base, rng.randrange(1 + size // 14)) for _ in range(copies)]
    out += [text(rng.randrange(5, 150)) for _ in range(120)]
    out += ["Alpha Beta\tgamma", "alpha  beta gamma", "alpha beta", "", "  \n", None, "one two three four five", "ONE TWO THREE FOUR FIVE"]
    out += [text(40)] * 3 + ["long " * 30_000, text(20_000)]
    out.append(out[-1] + " tail of the text")
    rng.shuffle(out)
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark, tmp_path, rows):
    folder = write(docs(spark, rows, ["cls", "node", "n", "component"]), tmp_path)
    assert found(near_dedup.op8_near_dedup(spark, folder)) == brute(rows)


def test_rounds_decide_every_pair(spark, rows, monkeypatch):
    """With few pivots, small chunks and several rounds the result is the same."""
    monkeypatch.setattr(near_dedup, "ROUNDS", [(1, 0), (2, 1), (2, 0)])
    monkeypatch.setattr(near_dedup, "CHUNK", 7)
    got = near_dedup.near_classes(docs(spark, rows))
    want = [(k, n, c) for k, n, c, _ in brute(rows)]
    assert found(got) == sorted(want, key=str)


def test_ids_that_repeat_or_are_missing(spark, tmp_path):
    a, b = "a b c d e f g h", "q r s t u v w"
    rows = [(5, a), (5, b), (7, a), (3, b), (None, a), (None, "x y z"), (9, ""), (9, None)]
    folder = write(docs(spark, rows), tmp_path)
    assert found(near_dedup.op8_near_dedup(spark, folder)) == brute(rows)


def test_no_rows(spark, tmp_path):
    folder = write(docs(spark, []), tmp_path)
    assert found(near_dedup.op8_near_dedup(spark, folder)) == []


def test_keep_one(spark, rows):
    table = docs(spark, rows, ["kept", "doc"])
    kept = near_dedup.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, *_, stays in brute(rows) if stays)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900, dtype=np.uint64)
    one, two = np.unique(x[:600]), np.unique(x[100:700])
    a, b = near_dedup.registers(one), near_dedup.registers(two)
    assert (np.maximum(a, b) == near_dedup.registers(np.union1d(one, two))).all()
    assert abs((a == b).mean() - 500 / 700) < 0.08
    far = near_dedup.registers(np.unique(x[500:]))
    size = np.array([600.0]), np.array([600.0])
    assert near_dedup.likely(a[None], b[None], *size, 0.7)[0]
    assert not near_dedup.likely(a[None], far[None], np.array([600.0]), np.array([400.0]), 0.5)[0]


def test_sets_are_those_of_the_text():
    texts = ["a b c d e f a b c d e", "A B", None, "a\x0bb c\x0cd e\x85f"]
    got = [len(x) for x in near_dedup.shingle_sets(pa.array(texts))]
    assert got == [len(shingles(t)) for t in texts]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(500, i) for i in range(501, 600)]
    frame = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.label for r in components.components(frame).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[find(a)] = find(b)
    same = {}
    for node in {x for a, b in edges if a != b for x in (a, b)}:
        assert same.setdefault(find(node), label[node]) == label[node]
    assert len(set(same.values())) == len(same)
    assert components.components(frame.filter(F.lit(False))).count() == 0


def test_groups_are_bounded_and_pairs_meet_once(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 10)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "SALTS", 2)
    members = [(9, 0, i, i, 1, 40) for i in range(40)] + [(8, 0, i, i, 1, 5) for i in range(5)]
    open_ = spark.createDataFrame(members, "bucket long, band int, node long, label long, own long, size long")
    chosen = near_dedup.choose_pivots(open_, 8)
    assert sorted((r.bucket, r.node) for r in chosen.collect()) == [(8, i) for i in range(5)] + [(9, i) for i in range(8)]
    groups = {}
    for r in near_dedup.deal(open_, chosen, 8).collect():
        groups.setdefault((r.bucket, r.block, r.chunk), ([], []))[r.pivot].append(r)
    assert max(len(p) for p, _ in groups.values()) == 3
    met = []
    for (bucket, block, _), (p, m) in groups.items():
        met += [(bucket, *sorted((x.node, y.node))) for x in p for y in m if x.node != y.node and (y.own_block != block or x.node < y.node)]
    want = {(9, i, j) for i in range(8) for j in range(i + 1, 40)} | {(8, i, j) for i in range(5) for j in range(i + 1, 5)}
    assert len(met) == len(set(met)) and set(met) == want
    monkeypatch.setattr(near_dedup, "ROUNDS", [(1, 0), (5, 1), (4, 0)])
    monkeypatch.setattr(near_dedup, "MOST_PIVOTS", 12)
    got = near_dedup.near_classes(docs(spark, rows))
    assert found(got) == sorted([(k, n, c) for k, n, c, _ in brute(rows)], key=str)


def test_the_exact_way_equals_brute_force(spark, rows):
    got = near_dedup.near_classes(docs(spark, rows), exact=True)
    assert found(got) == sorted([(k, n, c) for k, n, c, _ in brute(rows)], key=str)
    assert near_dedup.near_classes(docs(spark, []), exact=True).count() == 0


def boilerplate(count, shared, own):
    """Texts that have `shared` words in common and `own` words of their own."""
    rng = random.Random(count)
    common = " ".join("c%d" % i for i in range(shared))
    return [(i, common + " " + " ".join("o%d" % rng.randrange(10**9) for _ in range(own))) for i in range(count)]


def counted_pairs(monkeypatch):
    """The pairs that reach the verification, round by round."""
    kept, verified = [], near_dedup.verified

    def counting(pairs, sets, percent):
        kept.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "verified", counting)
    return kept


def test_failed_pairs_are_not_verified_again(spark, monkeypatch):
    kept = counted_pairs(monkeypatch)
    rows = boilerplate(120, 200, 50)  # a similarity of 0.66: no links
    got = near_dedup.near_classes(docs(spark, rows))
    assert found(got) == sorted([(k, n, c) for k, n, c, _ in brute(rows)], key=str)
    assert len(kept) == len(set(kept))


@pytest.mark.parametrize("count", [150, 600])
def test_a_group_of_near_copies_proposes_few_pairs(spark, monkeypatch, count):
    kept = counted_pairs(monkeypatch)
    got = near_dedup.near_classes(docs(spark, boilerplate(count, 200, 16)))  # a similarity of 0.83
    assert {r.component for r in got.collect()} == {0}
    assert len(kept) <= 8 * count


def test_a_group_just_below_the_threshold_makes_few_rows(spark, monkeypatch):
    """Its pairs all need verification, but no table has a row for each of them."""
    count = 300
    kept, sizes, materialize = counted_pairs(monkeypatch), [], near_dedup.materialize

    def counting(df, label="table", *rest):
        table = materialize(df, label, *rest)
        sizes.append((table.count(), label))
        return table

    monkeypatch.setattr(near_dedup, "materialize", counting)
    rows = boilerplate(count, 200, 37)  # a similarity of 0.71: no links
    rows += [(k + 10_000, f"{text} one end") for k, text in rows[: count // 3]]
    got = near_dedup.near_classes(docs(spark, rows))
    want = [(k, n, c) for k, n, c, _ in brute(rows)]
    assert len({c for *_, c in want}) == count
    assert found(got) == sorted(want, key=str)
    assert len(kept) <= near_dedup.BANDS * len(rows)
    assert max(sizes)[0] <= near_dedup.BANDS * len(rows)


def test_joining_links_join_what_all_links_join():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**64, 300, dtype=np.uint64))
    sets = []
    for size in rng.integers(0, 70, 60):
        own = rng.integers(0, 2**64, size, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([base[size:], own])))
    label = [i if i % 4 else 0 for i in range(60)]
    pairs = np.array([(i, j) for i in range(20) for j in range(60) if i != j and label[i] != label[j]])
    share = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    linked = {(i, j) for i, j in pairs.tolist() if share(i, j)}

    def groups(links):
        of = {x: {x} for x in label}
        for i, j in links:
            both = of[label[i]] | of[label[j]]
            of.update((x, both) for x in both)
        return {frozenset(x) for x in of.values()}

    got = near_dedup.joining_links(pairs, label, sets, 75)
    assert set(got) <= linked and 0 < len(linked) < len(pairs)
    assert groups(got) == groups(linked)
    assert len(got) == len(set(label)) - len(groups(linked))
    assert near_dedup.joining_links(pairs[:0], label, sets, 75) == []
