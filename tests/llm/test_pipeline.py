import hashlib
import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_stages_follow_their_operators(spark):
    from strataforge.llm import decontaminate, ngram_join, pii, spiece, toxicity
    from strataforge.llm.shared import cut

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        after = cut(stage(spark, docs, DATA), name)
        seen.append((docs, after))
        docs = after
    assert all(after.columns == columns for _, after in seen[:-1])
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    scores = toxicity.score_documents(seen[0][0], spark.read.parquet(f"{DATA}/labels.parquet"))
    assert ids(seen[0][1]) == ids(scores.where("predicted = 0"))
    parts = ngram_join.link_documents(seen[1][0])
    assert ids(seen[1][1]) == ids(parts.where("doc_id = component_id"))
    marks = decontaminate.contamination(seen[2][0], spark.read.parquet(f"{DATA}/benchmark.parquet"))
    assert ids(seen[2][1]) == ids(marks.where("not contaminated"))
    assert ids(seen[3][1]) == ids(seen[3][0]) and pii.find_pii(seen[3][1]).where("n_email + n_ip + n_card > 0").count() == 0
    codec = spiece.Codec(spiece.Vocabulary.load(corpus_pipeline.SENTENCEPIECE_MODEL))
    texts = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in seen[4][0].collect()}
    back = {r["doc_id"]: hashlib.sha256((codec.decode(r["token_ids"]) if r["token_ids"] else "").encode()).hexdigest() for r in docs.collect()}
    assert texts == back
    assert corpus_pipeline.run(spark, DATA).columns == docs.columns
