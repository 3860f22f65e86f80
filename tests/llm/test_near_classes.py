"""The near-dedup stage of the pipeline takes in what op1 finds."""

import numpy as np

import corpus_pipeline
from plumbline.llm import near_dedup, simhash


def test_pairs_that_only_op1_finds_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(11)
    texts = [[f"w{x}" for x in rng.integers(5000, size=400)] for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100 + i, " ".join([*t[:-1], "other"])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = {r.doc_id for r in simhash.near_classes(docs, carry=["doc_id"]).collect() if r.component_id != r.doc_id}
    assert len(linked) >= 25 and min(linked) >= 100
    # No block of min-hashes is shared, so op1's classes alone name candidates.
    monkeypatch.setattr(near_dedup, "bands", lambda h: np.random.default_rng().integers(1 << 62, size=20).tolist())
    kept = {r.doc_id for r in corpus_pipeline.not_near(spark, docs, "").collect()}
    assert kept == {i for i, _ in rows} - linked
