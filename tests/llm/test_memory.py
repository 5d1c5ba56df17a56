"""What tasks hold while they run, and what they leave to the tasks of later stages."""

import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from marlspike.llm import language_id, near_dedup, pieces
from marlspike.llm.common import returning
from tests.llm.support import docs

LANGS = ["de", "en", "es", "fr"]


def words_of(count, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(f"{chr(97 + x % 26)}{x:x}" for x in rng.integers(0, 5000, 500)) for _ in range(count)]


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_prediction_holds_no_transitions_of_words():
    texts = pa.array(words_of(8, 1))
    model = language_id.fit_shard(texts, LANGS * 2, LANGS, 0)
    many = pa.array(words_of(300, 2))
    assert peak(lambda: language_id.weigh(model, many)) < 300 * 150_000


def test_probabilities_without_expected_transitions_are_the_same():
    rng = np.random.default_rng(3)
    scores, moves, fresh = rng.normal(size=(700, 4)), rng.normal(size=(4, 4)), rng.random(700) < 0.01
    full, pairs = language_id.forward_backward(scores, moves, fresh)
    plain, none = language_id.forward_backward(scores, moves, fresh, expect=False)
    assert np.array_equal(full, plain) and pairs.shape == (4, 4) and none is None


def test_sets_are_made_of_small_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1600)), pa.array(words_of(1600, 4))], ["doc", "text"])
    assert batch.nbytes > 4_000_000
    run = near_dedup._row_digests(near_dedup.WORDS)
    assert peak(lambda: [x.num_rows for x in run([batch])]) < 12_000_000


def test_a_task_remembers_no_stretch_behind_it(spark):
    table = docs(spark, [(i, x) for i, x in enumerate(words_of(4, 5))]).coalesce(1)

    def kept(batches):
        for _ in batches:
            own = pieces.vocabulary(pieces.model_path())
            yield pa.RecordBatch.from_arrays([pa.array([len(own.kept) + len(own.kept_ids)])], ["n"])

    for made in (pieces.digests, pieces.encode):
        for _ in range(4):
            assert made(table).count() == 4
        found = spark.range(0, 64, 1, 16).mapInArrow(kept, "n long").collect()
        assert {r.n for r in found} == {0}


def test_what_follows_the_last_batch():
    seen = []

    def run(batches):
        for batch in batches:
            yield batch + 1
        seen.append("end")

    assert list(returning(run, lambda: seen.append("forgotten"))([1, 2])) == [2, 3]
    assert seen == ["end", "forgotten"]
    left = returning(run, lambda: seen.append("left"))(iter([1, 2]))
    next(left)
    left.close()
    assert seen[2:] == ["left"]


def test_freed_memory_goes_back_to_the_system():
    done = subprocess.run([sys.executable, "-c", """
import numpy as np
from marlspike.llm.common import returning
def held():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) // 1024
def run(batches):
    for batch in batches:
        small = [np.ones(8000) for _ in range(3000)]  # 190 MB in pieces below any mmap threshold
        pinned.append(np.ones(8000))  # the last piece keeps the heap's top
        yield len(small)
pinned = []
before = held()
plain = sum(run(range(2)))
after = held()
whole = sum(returning(run)(range(2)))
print(before, after, held())
assert held() < before + 60, (before, after, held())
"""], capture_output=True, text=True)  # fmt: skip
    assert done.returncode == 0, done.stdout + done.stderr
