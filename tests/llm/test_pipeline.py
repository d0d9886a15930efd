"""The pipeline's stages on a small corpus, and the registered queries against plain versions."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
from abundara.llm import registry

from test_similar import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if n < 4:
            assert docs.columns == columns
    ids = {k: Counter(r.doc_id for r in v.select("doc_id").collect()) for k, v in kept.items() if k != "packing"}
    start = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    toxic = {r.doc_id for r in registry.op6_toxicity(spark, SF).where("predicted = 1").collect()}
    assert set(ids["toxicity"]) == start - toxic
    assert set(ids["secrets"]) == set(ids["near_duplicates"]) <= set(ids["toxicity"])
    assert set(ids["mixing"]) == set(ids["secrets"]) and max(ids["mixing"].values()) <= 2
    # the stage's definition, every pair of five-word sets compared: one row of each component, that of the smallest id
    assert ids["near_duplicates"] == Counter({first for _, first in brute([(r.doc_id, r.text) for r in kept["toxicity"].collect()])})
    for r in kept["secrets"].collect():
        assert r.n_chars == len(r.text) and not re.search(r"[0-9a-f]{24}", r.text)
    tokens = kept["packing"].selectExpr("sum(length)").first()[0]
    once = registry.op1_packing(spark, SF)
    per = {r.doc_id: r.doc_tokens for r in kept["packing"].collect()}
    assert tokens == sum(per[i] * n for i, n in ids["mixing"].items()) and once.count() >= len(start)


def test_empty_corpus(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_chat_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for c, t, role, text in sorted(rows):
        told, loss, n = want.get(c, ("", "", 0))
        want[c] = (told + f"{role}\n{text}\n", loss + (text if role == "assistant" else ""), n + 1)
    got = registry.op7_chat(spark, SF).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {r.conv_id: (r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_turns) for r in got} == {c: (sha(a), len(b), sha(b), n) for c, (a, b, n) in want.items()}


def test_license_query(spark):
    notice = {"MIT-notice": "Released under the MIT License.", "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.", "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.", "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0."}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(r.doc_id, k) for r in docs for k, v in notice.items() if v in r.text}
    got = {(r.doc_id, r.license) for r in registry.op3_licenses(spark, SF).collect()}
    assert want and want <= got


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, repeats, ties, empty and long texts and clashing column names in every stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, text_row string, component_id long, secret_spans string, mix_pass int, score double"
    plain = " ".join(f"alpha{n} beta{n % 7}" for n in range(60))
    told = " ".join(reversed(plain.split()))
    rows = [
        (1, plain, "en", "s"), (1, plain, "en", "s"), (2, plain, "en", "s"), (3, None, None, None), (4, "", "en", ""), (None, plain, "en", "s"), (None, None, None, None),
        (5, told + " key = 1 secret=abcdef123 end", "en", "t"), (5, "another text under an id that stands twice " * 3, "en", "t"), (6, "word " * 60_000, "en", "t"), (7, "  ", "en", None),
    ]
    docs = spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "r", "x", 9, "y", 1, 0.5) for i, t, la, s in rows], schema)
    columns, counts = docs.columns, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        assert n == 4 or docs.columns == columns
    kept = spark.read.parquet(str(tmp_path / "near_duplicates"))
    # 2 is a copy of 1, the repeat of 1 goes, 4 and 7 are copies of 3 (no words); both texts of 5 differ; rows without an id stay
    assert counts[0] == len(rows) and sorted((r.doc_id or 0 for r in kept.collect())) == [0, 0, 1, 3, 5, 5, 6]
    assert counts[2] == counts[1] <= counts[3]
    said = {r.text for r in spark.read.parquet(str(tmp_path / "secrets")).collect()}
    assert plain in said and None in said and told + " key = 1 <SECRET> end" in said


def test_texts_are_scored_once(spark, monkeypatch):
    """run() writes each stage: the toxicity stage is planned and run once, whatever the later stages read."""
    calls = []
    whole = corpus_pipeline.STAGES
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda s, d, p, n=n, f=f: (calls.append(n), f(s, d, p))[1]) for n, f in whole])
    out = corpus_pipeline.run(spark, SF)
    assert calls == [n for n, _ in whole] and out.count() > 0
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # the packing; toxicity is behind written files
