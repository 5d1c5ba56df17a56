import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from marlspike.llm import exact_dedup
from tests.llm.support import docs, write

ROWS = [
    (1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, "same  text"), (4, None), (5, ""),
    (6, "É"), (7, "é"), (8, "long " * 40_000), (10, "long " * 40_000), (11, "x"), (11, "x"), (12, "X"),
    (None, "alone"), (None, "Same text"),
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[lower(text)].append(key)
    out = []
    for body, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(k, keep, len(keys), k == keep, sha) for k in keys]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark, tmp_path):
    folder = write(docs(spark, ROWS, ["digest", "body", "salt", "keep", "size"]), tmp_path)
    assert found(exact_dedup.op10_exact_dedup(spark, folder)) == brute(ROWS)


def test_no_rows(spark, tmp_path):
    folder = write(docs(spark, []), tmp_path)
    assert found(exact_dedup.op10_exact_dedup(spark, folder)) == []


def test_texts_that_share_a_digest_stay_apart(spark):
    table = docs(spark, ROWS).repartition(5)
    got = exact_dedup.classes(table, digest=lambda body: F.length(body).cast("string"))
    want = [(k, keep, size) for k, keep, size, *_ in brute(ROWS)]
    assert found(got.select("doc", "keep", "size")) == sorted(want, key=str)


def test_a_hot_text_over_many_tasks(spark):
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(900)]
    got = exact_dedup.classes(docs(spark, rows).repartition(60), salts=4)
    want = [(k, keep, size) for k, keep, size, *_ in brute(rows)]
    assert found(got.select("doc", "keep", "size")) == sorted(want, key=str)


def test_keep_one_keeps_all_columns(spark):
    table = docs(spark, ROWS, ["keep", "sha", "digest"])
    kept = exact_dedup.keep_one(table)
    assert kept.columns == table.columns
    want = [k for k, keep, _, stays, _ in brute(ROWS) if stays]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
