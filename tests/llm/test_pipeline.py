"""The pipeline's stages, each on its own input, and the whole of it."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import decontamination, toxicity
from tests.llm import brute


def test_stages_keep_columns_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    rows = {r.doc_id: r for r in docs.collect()}
    out = {name: stage(spark, docs, folder) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(df.columns == docs.columns for df in out.values())
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert {r.doc_id for r in out["toxicity"].collect()} == {d for d, s in scores.items() if s < 0.7}
    groups = brute.near_groups([(d, r.text) for d, r in rows.items()], 5, 80)
    assert sorted(r.doc_id for r in out["near_dedup"].collect()) == sorted({c for _, c in groups.values()})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = brute.contamination([(d, r.text) for d, r in rows.items()], items)
    assert sorted(r.doc_id for r in out["decontamination"].collect()) == sorted(d for d, (_, n, _) in hit.items() if not n)
    sizes: dict = {}
    for r in rows.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(brute.SPACES, r.text))
    taken: dict = {}
    for r in out["mixing"].collect():
        taken[r.source] = taken.get(r.source, 0) + len(re.findall(brute.SPACES, r.text))
    want = brute.targets(sizes)
    assert all(abs(taken.get(s, 0) - want[s]) <= 1 for s in want)


def test_stages_take_awkward_and_empty_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.createDataFrame(brute.awkward_rows(), brute.SCHEMA).withColumn("score", F.lit(9.5)).withColumn("tie", F.lit("t"))
    made = rows.collect()
    for docs in (rows, rows.limit(0)):
        got = {name: stage(spark, docs, folder) for name, stage in corpus_pipeline.STAGES}
        assert all(got[name].columns == docs.columns for name, _ in corpus_pipeline.STAGES[:-1])
        assert got["token_output"].count() == docs.count()
    known = [(r.doc_id, r.text) for r in made if r.doc_id is not None]
    out = {name: stage(spark, rows, folder).collect() for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(r.score == 9.5 and r.tie == "t" for part in out.values() for r in part)
    groups = brute.near_groups(known, 5, 80)
    assert sorted(r.doc_id for r in out["near_dedup"] if r.doc_id is not None) == sorted({c for _, c in groups.values()})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = brute.contamination([(i, r.text) for i, r in enumerate(made)], items)
    assert sorted(map(str, out["decontamination"])) == sorted(str(made[i]) for i, (_, n, _) in hit.items() if not n)
    assert set(map(str, out["toxicity"])) <= set(map(str, made))
    taken, sizes = {}, {}
    for r in made:
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(brute.SPACES, r.text or ""))
    for r in out["mixing"]:
        taken[r.source] = taken.get(r.source, 0) + len(re.findall(brute.SPACES, r.text or ""))
    want = brute.targets(sizes)
    assert all(abs(taken.get(s, 0) - want[s]) <= 1 for s in want)


def test_run(spark):
    folder = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and min(r.start for r in got) == 0
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert decontamination.WINDOW == 10
