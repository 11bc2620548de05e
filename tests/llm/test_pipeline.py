"""The pipeline's stages on planted documents, each against what it must do to its input."""

import hashlib
from pathlib import Path

import corpus_pipeline
from edgeledger.llm.common import land, shared_root
from tests.llm import cases


def planted():
    good = [(k, cases.sentence(k, 120 + k % 40), "en", "abc"[k % 3], 0) for k in range(90)]
    junk = [(200 + k, " ".join([f"w{k}"] * 60 + [f"v{k}"] * 60), "en", "a", 0) for k in range(30)]
    copies = [(300 + k, good[k][1].upper(), "en", "b", 0) for k in range(10)]
    near = [(400 + k, good[20 + k][1] + " tail", "en", "c", 0) for k in range(10)]
    return good, junk, copies, near


def test_stages(spark, tmp_path):
    good, junk, copies, near = planted()
    marks = spark.createDataFrame([(r[0], 1) for r in good] + [(r[0], 0) for r in junk], "doc_id long, quality int")
    docs = cases.table(spark, good + junk + copies + near + [(999, None, None, None, None)])
    folder = cases.on_disk(docs, tmp_path, marks)
    ids = lambda frame: sorted(r["doc_id"] for r in frame.collect())
    step, names = corpus_pipeline.documents(spark, folder), [n for n, _ in corpus_pipeline.STAGES]
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        step = results[name] = land(stage(spark, step, folder), name)
        if name != names[-1]:
            assert step.columns == docs.columns
    assert ids(results["quality_rules"]) == sorted(r[0] for r in good + copies + near)
    left = {r[0] for r in good[10:] + copies + near}
    assert ids(results["exact_dedup"]) == sorted(left)
    assert ids(results["near_dedup"]) == sorted(left - {r[0] for r in near})
    texts = {r["doc_id"]: r["text"] for r in results["near_dedup"].collect()}
    mixture, tokens = results["source_mix"].collect(), results["byte_bpe"].collect()
    assert all(r["text"] == texts[r["doc_id"]] for r in mixture)
    assert sorted(r["doc_id"] for r in mixture) == sorted(r["doc_id"] for r in tokens)
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in tokens)
    assert ids(corpus_pipeline.run(spark, folder)) == sorted(r["doc_id"] for r in tokens)


def test_empty(spark, tmp_path):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert corpus_pipeline.run(spark, cases.on_disk(cases.empty(spark), tmp_path, marks)).count() == 0


def test_scratch_goes_with_the_next_stage(spark, tmp_path):
    good, junk, copies, near = planted()
    marks = spark.createDataFrame([(r[0], 1) for r in good] + [(r[0], 0) for r in junk], "doc_id long, quality int")
    folder = cases.on_disk(cases.table(spark, good + junk + copies + near), tmp_path, marks)
    scratch = Path(shared_root(spark).removeprefix("file:")) / "llm"
    tokens = corpus_pipeline.run(spark, folder)
    before = set(scratch.iterdir())
    assert tokens.count() > 0
    docs = corpus_pipeline.exact_dedup(spark, corpus_pipeline.documents(spark, folder), folder)
    assert len(before & set(scratch.iterdir())) < len(before)
    chained = corpus_pipeline.near_dedup(spark, docs, folder)  # not stored between: what it reads stays
    assert chained.count() == len(good + junk)
