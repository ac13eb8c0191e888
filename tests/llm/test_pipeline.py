"""The pipeline's stages: what each keeps, and the columns it returns."""

import os
import subprocess
import sys
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from kinweave.llm import decontam, langid, linededup, simhash, tokens
from kinweave.runtime import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900001, "%%% 123 !!!", None, None, 11), (900002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    for k, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        out = materialize(stage(spark, docs, SF), name)
        after = [r.doc_id for r in out.select("doc_id").collect()]
        assert set(after) <= before and len(after) == len(set(after))
        if k < len(cp.STAGES) - 1:
            assert out.columns == list(cp.COLUMNS)
        if name == "language":
            assert before - set(after) >= {900001, 900002} and len(after) >= 0.97 * len(before)
        if name in ("lines", "mixture"):
            assert set(after) == before
        if name == "near_copies":
            groups = simhash.near_duplicates(docs, **simhash.SIMILAR).collect()
            assert set(after) == {r.id for r in groups if r.id == r.component}
        if name == "benchmark":
            hit = {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(after) == before - hit
        docs = out
    assert [n for n, _ in cp.STAGES] == ["language", "lines", "near_copies", "benchmark", "mixture"] and cp.ORACLE_SQL is None


def test_stages_without_rows_and_with_other_columns(spark):
    """No rows give none; columns with names that the stages use themselves pass through or are left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(1) for c in ("n_dropped", "component", "start", "src", "h1s")})
    for name, stage in cp.STAGES:
        assert stage(spark, docs.where("false"), SF).collect() == []
        some = stage(spark, docs.limit(40), SF)
        assert "doc_id" in some.columns and some.count() <= 40, name


class Rows:
    """Stands for a table; gives what a worker runs."""

    columns, schema = ["doc_id", "text"], None
    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda v: SimpleNamespace(value=v)))  # noqa: N815

    def select(self, *_):
        return self

    where = select

    def mapInArrow(self, run, _):  # noqa: N802
        return run


TAKES_TEXTS = {
    "language": lambda: langid.reject_unidentified(Rows(), langid.fit([("abc def", "x"), ("uvw xyz", "y")])),
    "lines": lambda: linededup.line_hashes(Rows(), "doc_id", "text", 20),
    "near_copies": lambda: simhash.set_fingerprints(Rows()),
    "benchmark": lambda: decontam._segments(SimpleNamespace(value=np.zeros(1 << 10, np.uint64)), 16, [3], 20),
}


@pytest.mark.parametrize("name", TAKES_TEXTS)
def test_a_worker_holds_few_texts_besides_the_batch(spark, name):
    """A batch of 2,560 texts is 50 MB; as Python objects all at once they were 50 MB more."""
    run, text = TAKES_TEXTS[name](), "b" * 20_000 + " def"
    batch = pa.record_batch([pa.array(range(2560), pa.int64()), pa.array([text] * 2560)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        assert tracemalloc.get_traced_memory()[1] < 0.6 * batch.nbytes
    finally:
        tracemalloc.stop()


def test_scoring_holds_few_arrays_of_all_words():
    rng = np.random.default_rng(5)
    score = rng.normal(size=(8, 50_000))
    given = score.copy()
    tracemalloc.start()
    try:
        langid.forward_backward(score, rng.normal(size=(8, 8)), rng.normal(size=8), np.full(2500, 20))
        assert tracemalloc.get_traced_memory()[1] < 4.5 * score.nbytes  # 5.5 before
    finally:
        tracemalloc.stop()
    assert (score == given).all()


def test_a_worker_gives_memory_back_at_the_end_of_a_task():
    """What small objects left between large ones kept, in a process of its own, as pages of this one may be anybody's."""
    code = """
import re, sys
from pathlib import Path
import pyarrow as pa
from kinweave.llm.tokens import lean
held = lambda: sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024
kept = []
def run(batches):
    for b in batches:
        rows = [bytes(3000) for _ in range(50_000)]
        kept.append(rows[::400])  # what is remembered pins the end of the heap
        yield b
task = (lean if sys.argv[1] == "lean" else lambda f: f)(run)
before = held()
for _ in task(iter([pa.record_batch([pa.array([1])], ["x"])])):
    pass
print(held() - before)
"""
    took = {k: float(subprocess.run([sys.executable, "-c", code, k], env=os.environ | {"PYTHONPATH": os.path.dirname(cp.__file__)}, capture_output=True, text=True, check=True).stdout) for k in ("plain", "lean")}
    if tokens._trim() is None:
        pytest.skip("not glibc")
    assert took["plain"] > 100 > 50 > took["lean"]


def test_rewritten_lines_of_a_batch_of_many_parts(spark):
    """Over ``TEXTS`` rows in one batch; with and without lines to lose, nulls and empty texts in between."""
    n, shared = 3 * tokens.TEXTS + 7, "a line that is long enough to count"
    rows = [(i, None if i % 11 == 3 else "" if i % 11 == 5 else f"own {i}" if i % 2 else f"own {i}\n {shared.upper()} \nend") for i in range(n)]
    out = {r.doc_id: r for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    last = max(i for i, t in rows if t and shared.upper() in t)
    assert len(out) == n
    for i, t in rows:
        loses = bool(t) and "\n" in t and i != last
        assert (out[i].text, out[i].n_lines, out[i].n_dropped) == (f"own {i}\nend" if loses else t, (t or "").count("\n") + 1, int(loses))
