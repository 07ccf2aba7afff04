"""The pipeline against a plain version made of its parts' definitions."""

import numpy as np
import public_tokenizers

import corpus_pipeline
from meshwork.llm import langid, quality
from tests.conftest import SF
from tests.llm.test_similar import plain_kept


def test_pipeline_equals_a_plain_version(spark):
    from tokenizers import Tokenizer

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    kept = {r["doc_id"] for r in quality.resample(docs, model).where("kept").collect()}
    assert 0 < len(kept) < len(rows)
    left = docs.where(docs.doc_id.isin(*kept))
    tongue = langid.fit(left)
    found = dict(zip(sorted(kept), tongue.predict([rows[i] for i in sorted(kept)]), strict=True))
    kept = {i for i in kept if found[i][0] != "und" and found[i][1] >= 0.5}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    first: dict = {}
    for i in sorted(kept):
        first.setdefault(rows[i].translate(lower), i)
    kept = set(first.values())
    kept = plain_kept([(i, rows[i]) for i in sorted(kept)])
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: len(t.encode(rows[i], add_special_tokens=False).ids) + 1 for i in kept}
    got: dict = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == tokens


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert np.isfinite(docs.count())
