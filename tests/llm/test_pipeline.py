"""The pipeline over the small tables: each stage keeps whole documents and passes columns on."""

import corpus_pipeline
from filigree.llm import bpe
from filigree.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
        assert set(now) <= set(before) and len(now) > 0.8 * len(before)
        assert all(len(t) == n for t, n in now.values())
        before = {i: t for i, (t, _) in now.items()}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(before)
    own = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()))
    for i in list(out)[:20]:
        assert own.encode(before[i]) == list(out[i].ids) and len(out[i].ids) == out[i].n_tokens


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
