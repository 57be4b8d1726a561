from itertools import product

import numpy as np
import pytest

from readloom.llm import toxicity
from readloom.llm.queries import op11_toxic_crf

SF = "/root/testdata/sf0.01"


def brute_marginals(chain, emission):
    """Every tagging of one chain, weighed."""
    total, toxic, moves = 0.0, np.zeros(len(emission)), np.zeros((2, 2))
    for tags in product((0, 1), repeat=len(emission)):
        logs = chain.start * tags[0] + sum(e for e, t in zip(emission, tags) if t)
        logs += sum(chain.moves[a, b] for a, b in zip(tags, tags[1:]))
        weight = np.exp(logs)
        total += weight
        toxic += weight * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            moves[a, b] += weight
    return toxic / total, moves / total


def test_marginals_are_brute_force():
    rng = np.random.default_rng(1)
    chain = toxicity.Chain(rng.normal(size=(2, 2)), 0.7)
    sizes = [1, 5, 9, 2, 11, 1, 7]
    emission = rng.normal(size=sum(sizes)) * 3
    first = np.zeros(len(emission), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    wanted, moves = zip(*(brute_marginals(chain, e) for e in np.split(emission, np.cumsum(sizes)[:-1])), strict=True)
    p, counted = chain.expected_moves(emission, first)
    assert np.allclose(p, np.concatenate(wanted)) and np.allclose(counted, sum(moves))
    assert np.allclose(chain.marginals(emission, first), np.concatenate(wanted))


def test_features_are_those_of_the_word_alone():
    words = ["idiot", "a", "été", "x" * 5000, "abcdefgh", "abcdefghi"]
    rows, starts = toxicity.features([toxicity.word_bytes(w) for w in words])
    parts = np.split(rows, starts[1:])
    for word, part in zip(words, parts, strict=True):
        own, _ = toxicity.features([toxicity.word_bytes(word)])
        assert sorted(own.tolist()) == sorted(part.tolist())
    # Words with a long common prefix share rows, others do not.
    shared = lambda a, b: len(set(toxicity.features([a])[0].tolist()) & set(toxicity.features([b])[0].tolist()))
    assert shared(b"achlichen", b"achlichung") >= 5 and shared(b"achlichen", b"wertzu") == 0


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op11_toxic_crf(spark, SF).collect()
    assert len(rows) == len(texts)
    known = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    right = [r["predicted"] == labels[r["doc_id"]] for r in known]
    assert np.mean(right) >= 0.9
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    clean = [r["predicted"] for r in known if labels[r["doc_id"]] == 0]
    assert np.mean(clean) <= 0.06
    for r in rows:
        for span in filter(None, r["spans"].split(",")):
            start, stop = map(int, span.split(":"))
            words = texts[r["doc_id"]][start:stop]
            assert words and words[0].isalpha() and words[-1].isalpha()


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    plain = ["river", "stone", "light", "green", "walks", "slowly", "under", "bridge"]
    texts, labels = [], []
    for i in range(300):
        words = rng.choice(plain, 30).tolist()
        if i % 3 == 0:
            words.insert(int(rng.integers(30)), f"vex{rng.choice(list('abcdefgh'))}ling")
            words.insert(int(rng.integers(30)), "You Oaf")
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return toxicity.train(texts, labels)


def test_spans_and_odd_texts(spark, model, odd_documents, no_documents):
    texts = ["a river, you OAF! stone", "stone vexzling", "river stone light", None, "", "12 !?", "river " * 50_000 + "oaf"]
    docs = spark.createDataFrame([(i, t, "s", 0.0) for i, t in enumerate(texts)], "doc_id long, text string, spans string, score double")
    got = {r["doc_id"]: r for r in toxicity.predict(docs, model, ("doc_id",)).collect()}
    assert texts[0][slice(*map(int, got[0]["spans"].split(",")[-1].split(":")))].lower().endswith("oaf")
    assert got[1]["spans"] == "6:14" and got[1]["predicted"] == 1
    assert [got[i]["predicted"] for i in (2, 3, 4, 5)] == [0] * 4 and got[2]["spans"] == ""
    assert got[3]["score"] == got[4]["score"] == got[5]["score"]
    assert got[6]["spans"] == f"{6 * 50_000}:{6 * 50_000 + 3}"
    scores = [r["score"] for r in toxicity.predict(odd_documents, model).collect()]
    assert len(scores) == odd_documents.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.predict(no_documents, model).count() == 0


def test_nothing_to_learn(spark, odd_documents):
    labels = spark.createDataFrame([(1, None), (4, 0), (4, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    for some in (labels, labels.where("false")):
        model = toxicity.fit_on_fold(odd_documents, some)
        assert all(r["predicted"] == 0 for r in toxicity.predict(odd_documents, model).collect())
    assert toxicity.train(["", ""], [0, 1]).scale.shape == (4,)
    # One label says toxic, another does not: toxic.
    both = spark.createDataFrame([(5, 0), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit_on_fold(odd_documents, both)
    assert {r["predicted"] for r in toxicity.predict(odd_documents, model).collect()} <= {0, 1}
