import subprocess
import sys

import corpus_pipeline
from marlspike.llm import exact_dedup, mixing
from tests.llm import test_near_dedup as near
from tests.llm.support import docs, write


def rows():
    base = "the quick brown fox jumps over the lazy dog and runs far away from here"
    out = [(1, base), (2, base.upper()), (3, base + " now"), (4, "totally different words in this text about rivers and hills"), (5, "12 34"), (6, None), (7, "")]
    out += [(10 + i, f"filler number words {i} alpha{i} beta{i} gamma{i} delta{i} end", "en", f"src{i % 4}") for i in range(40)]
    return out


def test_stages_follow_each_other(spark, tmp_path):
    folder = write(docs(spark, rows(), ["kept", "row"]), tmp_path)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        out.write.parquet(f"{tmp_path}/{name}")
        before, frame = frame, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = frame.collect()
        if name != "sentencepiece":
            assert frame.columns == columns
            assert {r.doc_id for r in seen[name]} <= {r.doc_id for r in before.collect()}
    ids = {name: {r.doc_id for r in held} for name, held in seen.items()}
    texts = [(r[0], r[1]) for r in rows()]
    assert ids["language_id"] == {k for k, t in texts if t and any(c.isalpha() for c in t)}
    assert ids["exact_dedup"] == ids["language_id"] - {1}
    left = [(k, t) for k, t in texts if k in ids["exact_dedup"]]
    assert ids["near_dedup"] == {k for k, _, _, stays in near.brute(left) if stays} == ids["exact_dedup"] - {3}
    total = sum(r.n_tokens for r in mixing_tokens(spark, seen["near_dedup"], columns))
    kept = sum(r.n_tokens for r in mixing_tokens(spark, seen["mixing"], columns))
    assert kept == total * corpus_pipeline.MIX_PERCENT // 100
    assert ids["sentencepiece"] == ids["mixing"]


def mixing_tokens(spark, held, columns):
    frame = spark.createDataFrame([tuple(r) for r in held], ", ".join(f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in columns))
    return mixing.leafed(frame).withColumnRenamed("tokens", "n_tokens").collect()


def test_run(spark, tmp_path):
    folder = write(docs(spark, rows()), tmp_path)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 20


def test_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(docs(spark, []), tmp_path)).count() == 0


def test_the_rest_imports_without_the_operators():
    """As if the folder and the pipeline were not there."""
    hide = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("marlspike.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
names = set(entry.queries()) | set(entry.oracle_sql())
assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
"""
    subprocess.run([sys.executable, "-c", hide], check=True)


def test_a_broken_operator_is_not_hidden():
    broken = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "sentencepiece_missing_library" or name == "pyarrow.compute":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__
"""
    done = subprocess.run([sys.executable, "-c", broken], capture_output=True, text=True)
    assert done.returncode and "pyarrow.compute" in done.stderr


def test_classes_of_the_exact_stage(spark):
    kept = exact_dedup.keep_one(docs(spark, [(1, "A"), (2, "a"), (3, "b")]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
