from collections import Counter

import corpus_pipeline

import __spark_entry__ as entry
from readloom.llm import langid, pii

from llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    found = entry.queries()
    assert found["pipeline"] is corpus_pipeline.run
    assert {k.split("_")[0] for k in found if k.startswith("op")} == {f"op{n}" for n in range(1, 14)}


def test_run_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_on_fold(docs)
    rows = [r for r in docs.orderBy("doc_id").collect()]
    read = [r for r in rows if not model.rejects(r["text"], *model.predict(r["text"]))]
    assert len(read) >= 0.99 * len(rows)
    groups = brute_components([r["doc_id"] for r in read], [brute_fingerprint(r["text"]) for r in read])
    kept = [r for r, c in zip(read, groups, strict=True) if r["doc_id"] == c]
    clean = pii.redact(pii.find(docs)).select("doc_id", "text").collect()
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in clean}
    packed = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        packed[r["doc_id"]] += r["n_words"]
    assert packed == Counter({r["doc_id"]: words[r["doc_id"]] for r in kept})


def test_stages_keep_the_columns(spark, odd_documents, no_documents):
    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, docs.where("false")):
            out = stage(spark, df, SF)
            assert out.dtypes == docs.dtypes, name
            out.collect()
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.redact_pii(spark, docs, SF).where("doc_id is not null").collect()}
    assert "a.b@c.de" not in texts[6] and "4111" not in texts[6]
