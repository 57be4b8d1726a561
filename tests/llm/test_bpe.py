import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from readloom.llm import bpe
from readloom.llm.queries import op8_byte_bpe

SF = "/root/testdata/sf0.001"
VOCABULARY = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def test_query_is_tiktoken(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op8_byte_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = TIKTOKEN.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_hard_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["", " ", "\n\n  x", "<|endoftext|> it's 12345 \U0001f600\U0001f600 naïve  　日本語", "a" * 20_000, "ab" * 10_001, "\x00\x01"]
    texts += ["".join(rng.choice("aabcdest ing'é\U0001f600\n") for _ in range(rng.randrange(2_000))) for _ in range(60)]
    texts += ["".join(rng.choice("aes") for _ in range(rng.randrange(300))) for _ in range(60)]
    wanted = [TIKTOKEN.encode_ordinary(t) for t in texts]
    for longest in (64, 0):
        monkeypatch.setattr(bpe, "LONG_WORD", longest)
        assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Replay(VOCABULARY).encode(texts)] == wanted


def test_a_lower_rank_that_a_merge_opens_comes_first(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"aba": 300, b"ab": 500, b"abab": 600, b"ababa": 400}
    own = bpe.Vocabulary(ranks, r"\S+")
    theirs = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    texts = ["ababa", "abab", "abaabab", "ab" * 9, "ababc"]
    for longest in (64, 0):
        monkeypatch.setattr(bpe, "LONG_WORD", longest)
        assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Replay(own).encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_odd_rows(odd_documents, no_documents):
    coded = bpe.encode(odd_documents, VOCABULARY)
    back = {r["doc_id"]: r["text"] for r in bpe.decode(coded, VOCABULARY).collect()}
    for r in odd_documents.collect():
        if r["doc_id"] is not None:
            assert back[r["doc_id"]] == (r["text"] or "")
    assert coded.count() == odd_documents.count()
    assert bpe.encode(no_documents, VOCABULARY).count() == 0
