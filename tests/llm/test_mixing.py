import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marlspike.llm import mixing
from tests.llm.support import docs, write


def tokens(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def share_out(node, budget, epochs, weights, depth=0):
    """{leaf path: tokens} by filling: shortages go to siblings until all are full."""
    if depth == 3:
        return {(): budget}
    name = mixing.LEVELS[depth]
    room = lambda x, d: x * epochs if d == 3 else sum(room(y, d + 1) for y in x.values())
    kids = {k: (room(v, depth + 1), weights.get(name, {}).get(k, 1)) for k, v in node.items()}
    budget = min(budget, sum(r for r, _ in kids.values()))
    share, left, open_ = {}, budget, dict(kids)
    while open_:
        heavy = sum(w for _, w in open_.values())
        full = [k for k, (r, w) in open_.items() if r * heavy <= left * w]
        if not full:
            break
        first = min(full, key=lambda k: (open_[k][0] / open_[k][1], k))
        share[first] = open_.pop(first)[0]
        left -= share[first]
    heavy = sum(w for _, w in open_.values())
    for k, (_, w) in open_.items():
        share[k] = left * w // heavy
    spare = budget - sum(share.values())
    for k in sorted(open_, key=lambda k: (-open_[k][1], k))[:spare]:
        share[k] += 1
    out = {}
    for k, s in share.items():
        out.update({(k, *path): v for path, v in share_out(node[k], s, epochs, weights, depth + 1).items()})
    return out


def brute(rows, weights, percent, epochs, seed=mixing.SEED):
    tree, by_leaf = {}, defaultdict(list)
    for doc, domain, lang, source, n in rows:
        if n:
            tree.setdefault(domain, {}).setdefault(lang, {}).setdefault(source, 0)
            tree[domain][lang][source] += n
            by_leaf[domain, lang, source].append((doc, n))
    total = sum(n for x in by_leaf.values() for _, n in x)
    out = []
    for leaf, budget in share_out(tree, total * percent // 100, epochs, weights).items():
        held = sum(n for _, n in by_leaf[leaf])
        epoch = 0
        while budget > 0:
            key = lambda x: int(hashlib.md5(f"{x[0]}|{seed}|{epoch}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
            for doc, n in sorted(by_leaf[leaf], key=key):
                if budget <= 0:
                    break
                out.append((doc, *leaf, n, epoch, min(n, budget)))
                budget -= n
            epoch += 1
        assert held
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc long, domain string, lang string, source string, tokens long")


@pytest.mark.parametrize("percent, epochs", [(10, 1), (60, 1), (95, 2), (100, 1), (170, 2), (500, 3)])
def test_equals_brute_force(spark, percent, epochs):
    rows = [
        (i, f"d{i % 3 if i % 7 else 0}", ["en", "de", "fr"][i % 5 % 3], f"s{i * i % 6}", (i * 37) % 90)
        for i in range(400)
    ] + [(1000 + i, "d0", "en", "hot", 50) for i in range(300)]
    weights = {"domain": {"d0": 1, "d1": 6}, "lang": {"en": 3}, "source": {"hot": 2}}
    got = mixing.take(table(spark, rows), weights, percent, epochs)
    assert sorted(map(tuple, got.collect())) == brute(rows, weights, percent, epochs)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(1, "a", "en", "x", 10), (2, "a", "en", "y", 1000), (3, "b", "en", "z", 1000)]
    got = mixing.take(table(spark, rows), {}, 50, 1).groupBy("domain", "source").agg(F.sum("taken").alias("n"))
    assert sorted(map(tuple, got.collect())) == [("a", "x", 10), ("a", "y", 493), ("b", "z", 502)]


ODD = [
    (1, "a  b\tc\n", "en", "src1"), (2, None, "en", "src1"), (3, "", None, None), (4, "x " * 50_000, None, "src2"),
    (5, "one two", "de", None), (5, "one two", "de", None), (None, "no id here", "fr", "web"), (6, "é 梦", "es", "src99999999999"),
]


def test_odd_rows_equal_sql(spark, tmp_path):
    folder = write(docs(spark, ODD, ["domain", "tokens", "share"]), tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = mixing.op7_mixing(spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(con.sql(mixing.SQL).fetchall(), key=str)


def test_no_rows(spark, tmp_path):
    assert mixing.op7_mixing(spark, write(docs(spark, []), tmp_path)).count() == 0


def test_documents_are_cut(spark):
    rows = [(i, f" w{i}a  w{i}b\nw{i}c tail ", "en", f"src{i % 2}") for i in range(40)]
    frame = docs(spark, rows, ["doc", "cut", "row", "uncut"])
    kept = mixing.take_documents(frame, {"source": {"src1": 3}}, 53)
    assert kept.columns == frame.columns
    found = {r.doc_id: r for r in kept.collect()}
    total = sum(tokens(t) for _, t, *_ in rows) * 53 // 100
    assert sum(tokens(r.text) for r in found.values()) == total
    for key, text, *_ in rows:
        if key in found:
            assert text.startswith(found[key].text) and found[key].n_chars == len(found[key].text)
    assert any(found[k].text != t for k, t, *_ in rows if k in found)
