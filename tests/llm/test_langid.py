import base64

import numpy as np

from readloom.llm import langid
from readloom.llm.queries import op7_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_language_id(spark, SF).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows if r["lang_pred"] == langs[r["doc_id"]]) <= 0.002 * len(rows)


def test_odd_rows(spark, odd_documents, no_documents):
    model = langid.fit_on_fold(spark.read.parquet(f"{SF}/documents.parquet"))
    got = langid.predict(odd_documents, model, ("doc_id", "score", "key")).toDF("doc_id", "own", "key", "lang_pred", "score", "rejected")
    rows = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 and rows[i]["rejected"] for i in (1, 2, 3))
    assert rows[8]["lang_pred"] == "en" and rows[8]["own"] == "w"
    assert got.count() == odd_documents.count()
    assert langid.predict(no_documents, model, ("doc_id",)).count() == 0


def test_nothing_to_learn_from(no_documents, odd_documents):
    model = langid.fit_on_fold(no_documents)
    assert {r["lang_pred"] for r in langid.predict(odd_documents, model, ("doc_id",)).collect()} == {"und"}


def test_one_language(odd_documents):
    model = langid.fit_on_fold(odd_documents)
    assert model.langs == ["en"]
    assert langid.predict(odd_documents, model, ("doc_id",)).where("lang_pred = 'en' and not rejected").count() > 0


def test_subwords_read_the_whole_text():
    assert len(langid.subwords("ab " * 50_000)) > 3 * 100_000
    assert langid.subwords("").size >= 1


def test_foreign_text_is_rejected_and_clean_text_stays(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_on_fold(docs)
    russian = "Все люди рождаются свободными и равными в своем достоинстве и правах."
    noise = np.random.default_rng(0).bytes(200)
    texts = [
        russian,
        russian.encode().decode("latin-1"),
        "すべての人間は、生まれながらにして自由であり、",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        noise.hex(),
        base64.b64encode(noise).decode(),
    ]
    got = langid.predict(frame(list(enumerate(texts)), "doc_id int, text string"), model, ("doc_id",)).collect()
    assert all(r["rejected"] and r["lang_pred"] != "und" for r in got)
    held = docs.where((langid.remainder(4) == 2) & docs["text"].rlike(r"\p{L}"))
    rows = langid.predict(held, model, ("doc_id",)).collect()
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)


def plain_subwords(text):
    """Rows of the table, n-gram by n-gram."""
    letters = "".join(c if ord(c) > 127 or "a" <= c <= "z" else c.lower() if "A" <= c <= "Z" else " " for c in text)
    codes = b" " + b" ".join(w for w in letters.encode().split(b" ") if w) + b" "
    rows = []
    for k, size in enumerate(langid.SIZES):
        for i in range(len(codes) - size + 1):
            code = int.from_bytes(codes[i : i + size], "little")
            mixed = (code * 2654435761 % 2**32) ^ (code >> 15)
            rows.append((mixed * 2246822519 % 2**32 >> 32 - 14) + k * langid.BUCKETS)
    return rows


def test_prediction_is_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit_on_fold(docs)
    texts = dict(docs.select("doc_id", "text").collect())
    for r in langid.predict(docs, model, ("doc_id",)).collect():
        text = texts[r["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        rows = plain_subwords(text)
        logits = [sum(float(model.table[i, j]) for i in rows) / len(rows) + model.bias[j] for j in range(len(model.langs))]
        p = np.exp((np.array(logits) - max(logits)) / model.heat)
        p /= p.sum()
        assert r["lang_pred"] == model.langs[int(p.argmax())] and abs(r["score"] - p.max()) < 1e-6


def test_a_language_of_long_texts_is_learned(frame):
    german, english = "haus baum garten wald und die strasse ", "house tree garden wood and the street "
    rows = [(i, german, "de") for i in range(40)] + [(100 + i, english * 700, "en") for i in range(40)]
    rows = [(i, f"{t}{'abcdefgh'[i % 8]}", lang) for i, t, lang in rows]
    model = langid.fit(frame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"] and model.predict("house tree garden wood")[0] == "en"


def test_many_languages_are_bounded(frame, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 5)
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    rows = [(i, f"word{chr(97 + i % 9)} text number {i}", f"l{i % 9 if i % 9 < 5 else i}") for i in range(360)]
    taught = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: taught.extend(langs))
    langid.fit(frame(rows, "doc_id long, text string, lang string"))
    assert set(taught) <= {f"l{i}" for i in range(5)} and 0 < len(taught) <= 60
