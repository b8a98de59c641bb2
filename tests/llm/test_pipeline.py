import corpus_pipeline
from cellwatch.llm.common import written
from tests.llm import brute


def test_stages(spark, odd, corpus):
    docs = corpus.union(odd.select(*corpus.columns)).cache()
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = written(stage(spark, now, ""), name)
        if name != "packing":
            assert now.columns == docs.columns
        if name == "language_id":
            gone = before.exceptAll(now).collect()
            assert gone and all(not any(c.isalpha() for c in (r.text or "")) for r in gone)
        if name == "exact_dedup":
            texts = [" ".join(brute.words(r.text)) if not (r.text or "")[:1].isspace() else r.text for r in now.collect()]
            assert len(set(texts)) == len(texts)
        if name == "near_dedup":
            rows = [(i, r.text) for i, r in enumerate(before.collect())]
            assert now.count() == len({c for _, c in brute.components(rows).values()})
        if name == "pii":
            assert now.count() == before.count()
            assert all(not brute.pii(r.text) for r in now.collect())
    assert now.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0
