"""The pipeline: each stage on its own input, and the whole on a small corpus."""

import random

from llm_data import documents, edited, prose

import corpus_pipeline
from churnwise.llm import common, toxicity
from test_toxicity import corpus


def write(spark, tmp_path):
    rng = random.Random(19)
    texts, labels = corpus(rng, 500)
    items = [(k, prose(rng, 20)) for k in range(3)]
    marks = spark.createDataFrame([(k, 1, y) for k, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    base = prose(rng, 120)
    texts += [base, edited(rng, base, 1), base, items[0][1] + " and more words here", "mail a.b@example.com or call +1 (446) 555-8962", None, ""]
    sources = [rng.choice(["a", "b", None]) for _ in texts]
    docs = documents(spark, texts, sources)
    for name, df in (("documents", docs), ("labels", marks), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return texts, str(tmp_path)


def test_run(spark, tmp_path):
    texts, sf = write(spark, tmp_path)
    n = 500
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "personal_data", "mixing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.cut(stage(spark, docs, sf), name)
        if name != "mixing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        before = {r["doc_id"] for r in docs.collect()}
        after = {r["doc_id"] for r in out.collect()}
        assert after <= before
        seen[name] = after
        docs = out
    scores = {r["doc_id"]: r["score"] for r in toxicity.report(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert seen["toxicity"] == {k for k, s in scores.items() if s < 0.3} and {n, n + 1, n + 2, n + 3, n + 4} <= seen["toxicity"]
    assert n in seen["near_dedup"] and not {n + 1, n + 2} & seen["near_dedup"] and n + 3 in seen["near_dedup"]
    assert seen["near_dedup"] - seen["decontamination"] == {n + 3}
    assert seen["personal_data"] == seen["decontamination"]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert text.get(n + 4, "mail <email> or call <phone>") == "mail <email> or call <phone>"
    # rerun: the same documents, as often
    again = corpus_pipeline.run(spark, sf)
    assert sorted((r["doc_id"], r["epoch"], r["words_taken"]) for r in again.collect()) == sorted((r["doc_id"], r["epoch"], r["words_taken"]) for r in docs.collect())


def test_empty_documents(spark, tmp_path):
    _, sf = write(spark, tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, sf), f"empty-{name}")
        assert docs.collect() == []


