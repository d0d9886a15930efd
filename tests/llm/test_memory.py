"""Python workers hand memory back after a task, and whole texts travel in small batches."""

import re
from pathlib import Path

import pyarrow as pa

import corpus_pipeline
from abundara.llm.common import BATCH_ROWS, cut, lean, slices
from abundara.llm.toxicity import SIDE, Model


def _anonymous_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_lean_hands_memory_back():
    def run(batches):
        held = [pa.array(list(range(1000)) * 100) for _ in batches]
        yield len(held)

    before = _anonymous_mb()
    assert list(lean(run)(iter(range(200)))) == [200]  # 160 MB at once
    assert _anonymous_mb() - before < 40


def _rows_of_batches():
    def run(batches):  # inside, so that it travels by value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return run


def test_cut_bounds_batches(spark):
    before = spark.conf.get(BATCH_ROWS)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(_rows_of_batches(), "n long")
    assert {r.n for r in cut(rows, batch_rows=1000).collect()} == {1000}
    assert spark.conf.get(BATCH_ROWS) == before


def test_packing_stage_bounds_batches(spark, monkeypatch):
    def plan(docs, path):  # the stage's write, seen through its batches
        return docs.select("doc_id").mapInArrow(_rows_of_batches(), "n long")

    monkeypatch.setattr(corpus_pipeline, "pack_documents", plan)
    docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "'a b' AS text")
    assert max(r.n for r in corpus_pipeline.packing(spark, docs, "").collect()) <= 1000


def test_slices_and_groups_keep_scores():
    import numpy as np

    rng = np.random.default_rng(1)
    model = Model(rng.normal(size=SIDE**3).astype(np.float32), -0.1, 1.0, 0.0)
    texts = ["".join(rng.choice(list("abc de f"), int(n))) for n in rng.integers(0, 3000, 400)]
    whole = model.scores(texts)
    assert np.array_equal(whole, np.concatenate([model.scores([t]) for t in texts]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    assert [t for part in slices([batch], 7) for t in part.column(0).to_pylist()] == texts
