import numpy as np
import pytest
from pyspark.sql import functions as F

from marlspike.llm import hash_forest
from tests.llm.support import write

SCHEMA = "vec_id long, embedding array<float>, label int, asks string, class int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, 0, "x", 1) for k, v in rows], SCHEMA)


def usable(rows):
    size = len(rows[-1][1])
    out = {}
    for key, v in rows:
        ok = v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if key is not None and ok:
            out[key] = min(out.get(key, v), v)
    return out


def brute(rows, k=20):
    held = usable(rows)
    keys = np.array(sorted(held))
    data = np.array([np.array(held[i], np.float32).astype(float) for i in keys.tolist()])
    out = {}
    for i in keys[keys % 20 == 0].tolist():
        score = np.einsum("ij,j->i", data, np.array(held[i], np.float32).astype(float))
        order = [j for j in np.lexsort((keys, -score)) if keys[j] != i][:k]
        out[i] = [(int(keys[j]), float(score[j])) for j in order]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        assert r["rank"] == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def test_odd_rows_and_ties(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(150)]
    rows += [(i, [1.0, 0.0, 2.0, 1.0]) for i in range(200, 300)]  # one vector on many rows
    rows += [(400, None), (420, [0.0] * 4), (440, [1.0, None, 1.0, 1.0]), (460, [float("nan")] * 4), (480, [float("inf"), 0.0, 0.0, 1.0])]
    rows += [(500, [1.0]), (520, []), (None, [1.0] * 4), (60, [9.0, 9.0, 9.0, 9.0]), (40, rows[40][1]), (540, [-1.0, 3.0, 1.0, 1.0])]
    folder = write(table(spark, rows), tmp_path, "embeddings")
    quick = got(hash_forest.op5_hash_forest(spark, folder))
    frame = hash_forest.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("id") % 20 == 0, reach=1e6)
    found = got(frame.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
    want = brute(rows)
    assert found.keys() == want.keys() == quick.keys()
    assert all(len(x) == 20 for x in quick.values())
    for key in want:
        assert [s for _, s in found[key]] == pytest.approx([s for _, s in want[key]])
        assert [i for i, _ in found[key]] == [i for i, _ in want[key]]


def test_few_and_no_rows(spark):
    assert hash_forest.nearest(table(spark, []), F.col("id") % 20 == 0).count() == 0
    few = hash_forest.nearest(table(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 2.0])]), F.col("id") % 20 == 0)
    assert sorted(map(tuple, few.select("query", "rank", "id").collect())) == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]


def test_recall_without_clusters(spark):
    rng = np.random.default_rng(4)
    data = rng.standard_normal((6000, 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(data.astype(np.float32).tolist())]
    frame = table(spark, rows)
    found = hash_forest.nearest(frame, F.col("id") % 20 == 0, block=1500, queries=100)
    want = brute(rows)
    mine = got(found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
    hits = [len({i for i, _ in mine[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    scanned = hash_forest.Forest(data[:1500], 1.0).ranges(data[1500:1600], int(hash_forest.REACH * 1500))
    assert (scanned[1] - scanned[0]).sum() < 100 * 1500  # it is not a full scan


def test_longest_prefix_and_ascent():
    rng = np.random.default_rng(5)
    data = rng.standard_normal((300, 8))
    forest = hash_forest.Forest(data, 40.0)
    query = rng.standard_normal((5, 8))
    first, end = forest.ranges(query, 200)
    own = hash_forest.hash_strings(np.column_stack([query, np.zeros(5)]), forest.normals)
    for q in range(5):
        for depth in range(hash_forest.DEPTH, -1, -1):
            shift = hash_forest.DEPTH - depth
            match = [(s >> shift) == (o >> shift) for s, o in zip(forest.strings, own[:, q])]
            if sum(m.sum() for m in match) >= 200:
                break
        assert [int(m.sum()) for m in match] == (end[:, q] - first[:, q]).tolist()
