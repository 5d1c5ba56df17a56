import hashlib

from pyspark.sql import functions as F

from marlspike.functions.hashing import hash_cross, java_string_hash, row_hash


def java_hash(text):
    """Brute force over UTF-16 units."""
    h = 0
    raw = text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


WORDS = ["", "a", "hello world", "软件_500万元", "😀x", "z" * 500, "ÿ"]


def test_java_hash(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "w string")
    found = {r["w"]: r["h"] for r in df.select("w", java_string_hash(F.col("w")).alias("h")).collect()}
    assert found == {w: java_hash(w) for w in WORDS}


def test_hash_cross(spark):
    df = spark.createDataFrame([(88, "500万元"), (0, None)], "a int, b string")
    found = [r[0] for r in df.select(hash_cross(["a", "b"], 100)).collect()]
    assert found == [java_hash("88_500万元") % 100, java_hash("0_null") % 100]
    fast = [r[0] for r in df.select(hash_cross(["a", "b"], 100, "xxhash64")).collect()]
    assert all(0 <= b < 100 for b in fast)


def test_row_hash(spark):
    df = spark.createDataFrame([(5, None)], "a int, b string")
    expected = int(hashlib.md5(b"5||9").hexdigest()[:15], 16)
    assert df.select(row_hash(["a", "b"], 9)).first()[0] == expected
