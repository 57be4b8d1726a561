"""Language identification: averaged embeddings of hashed byte n-grams and a linear softmax, trained by SGD in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import map_texts

UNDETERMINED = "und"
#: Subwords of 2, 3 and 4 bytes, each size hashed to as many rows.
SIZES = (2, 3, 4)
BUCKETS = 1 << 14
DIM = 16
#: Bound of the training sample: documents per language and of all languages, first characters of a
#: document that take part, and languages, the most frequent ones.
SAMPLE_PER_LANG = 1500
SAMPLE_DOCS = 6000
SAMPLE_CHARS = 20_000
MAX_LANGS = 256
EPOCHS = 4
#: Share of correctly read calibration documents that the rejection may cost.
REJECTED = 0.0005
#: Hashed 4-byte subwords whose occurrence in the sample is remembered, one bit each.
SEEN = 1 << 24
#: Subwords that a text must have for half of its share of unseen ones to count.
FEW = 16

LETTER = regex.compile(r"\p{L}")
#: Lower-case letters and every byte beyond ASCII stay; the rest separates words.
PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def subwords(text: str) -> np.ndarray:
    """Rows of the embedding table, one per n-gram of the whole text."""
    plain = b" ".join((b" " + text.encode("utf-8") + b" ").translate(PLAIN).split())
    codes = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    rows, code = [], codes
    for k in range(1, max(SIZES)):
        code = code[: len(codes) - k] | codes[k:] << np.uint32(8 * k)
        if k + 1 in SIZES:
            mixed = (code * np.uint32(2654435761)) ^ (code >> np.uint32(15))
            mixed = (mixed * np.uint32(2246822519)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            rows.append(mixed.astype(np.int64) + SIZES.index(k + 1) * BUCKETS)
    return np.concatenate(rows)


def quads(text: str) -> np.ndarray:
    """Bits of ``SEEN``, one per 4-byte subword of the whole text."""
    plain = b" ".join((b" " + text.encode("utf-8") + b" ").translate(PLAIN).split())
    codes = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    n = max(len(codes) - 3, 0)
    code = codes[:n].copy()
    for k in (1, 2, 3):
        code |= codes[k : n + k] << np.uint32(8 * k)
    return (code * np.uint32(2654435761)) >> np.uint32(32 - SEEN.bit_length() + 1)


@dataclass
class Model:
    """``table`` is embedding times softmax weights, so a text's logits are the mean of its subwords' rows.

    ``seen`` holds a bit per hashed 4-byte subword of the sample.
    """

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float
    reject_below: float
    seen: np.ndarray
    novel_above: float

    def logits(self, text: str) -> np.ndarray:
        total = np.zeros(len(self.langs))
        rows = subwords(text)
        for at in range(0, len(rows), 1 << 17):
            total += self.table[rows[at : at + (1 << 17)]].sum(axis=0, dtype=np.float64)
        return total / max(len(rows), 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not LETTER.search(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(text) / self.heat)
        best = int(p.argmax())
        return self.langs[best], float(p[best])

    def novelty(self, text: str) -> float:
        """Share of 4-byte subwords that the sample never shows; a text of few subwords counts less."""
        at = quads(text)
        known = self.seen[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1
        return float((len(at) - int(known.sum())) / (len(at) + FEW))

    def rejects(self, text: str | None, lang: str, score: float) -> bool:
        return lang == UNDETERMINED or score < self.reject_below or self.novelty(text) > self.novel_above


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 0) -> Model:
    """SGD over single documents; every fifth calibrates the temperature and the lowest score.

    The highest share of unseen subwords comes from all documents, each held
    against the others. Fewer than 20 documents can't tell new words from another
    language, so that nothing is rejected for its words.
    """
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (len(SIZES) * BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    if not langs:
        return Model([], embedding @ weights, bias, 1.0, 0.0, np.zeros(SEEN // 8, np.uint8), 1.0)
    y = np.array([langs.index(x) for x in labels])
    bags = []
    for text in texts:
        rows, n = np.unique(subwords(text), return_counts=True)
        bags.append((rows, (n / n.sum()).astype(np.float32)))
    order = rng.permutation(len(texts))
    tuned, learned = (order[::5], np.delete(order, np.s_[::5])) if len(order) >= 20 else (order, order)
    for epoch in range(EPOCHS):
        rate = np.float32(2.0 * (1 - epoch / EPOCHS))
        for i in rng.permutation(learned):
            rows, share = bags[i]
            own = embedding[rows]
            hidden = share @ own
            slope = softmax(hidden @ weights + bias)
            slope[y[i]] -= 1
            back = weights @ slope
            weights -= rate * np.outer(hidden, slope)
            bias -= rate * np.float32(0.1) * slope
            embedding[rows] = own - (rate * 10) * share[:, None] * back
    table = (embedding @ weights).astype(np.float32)
    logits = np.stack([bags[i][1] @ table[bags[i][0]] + bias for i in tuned])
    loss = lambda heat: -np.log(softmax(logits / heat)[np.arange(len(tuned)), y[tuned]] + 1e-12).mean()
    heat = float(min(np.geomspace(0.05, 5, 41), key=loss))
    p = softmax(logits / heat)
    right = p.max(axis=1)[p.argmax(axis=1) == y[tuned]]
    # Half of the way from chance, 1 / languages, to the lowest right score: small samples don't show the lowest one.
    below = float(np.quantile(right, REJECTED) + 1 / len(langs)) / 2 if len(right) and len(langs) > 1 else 0.0
    seen, limit = words_seen(texts)
    return Model(langs, table, bias.astype(np.float64), heat, below, seen, limit if len(texts) >= 20 else 1.0)


def words_seen(texts: list[str]) -> tuple[np.ndarray, float]:
    """``seen`` and ``novel_above`` of a model: subwords of a text that no other text has are new to it."""
    texts_with = np.zeros(SEEN, np.uint8)
    for text in texts:
        own = np.unique(quads(text))
        texts_with[own] = np.minimum(texts_with[own], 1) + 1
    new = []
    for text in texts:
        at = quads(text)
        new.append(int((texts_with[at] < 2).sum()) / (len(at) + FEW))
    usual = float(np.quantile(new, 1 - REJECTED))
    return np.packbits(texts_with > 0, bitorder="little"), usual + (1 - usual) / 8


def fit(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG, max_chars: int = SAMPLE_CHARS) -> Model:
    """A model from a bounded sample of ``(doc_id, text, lang)``.

    Each of the ``MAX_LANGS`` most frequent languages gives about ``per_lang`` documents, fewer where that would be
    over ``SAMPLE_DOCS`` in all, chosen by a hash of their text and id; of a longer text the first
    ``max_chars`` characters take part. That bounds what the driver receives and the model's size. Rows without a
    language or a letter give nothing.
    """
    start = F.left("text", F.lit(max_chars))
    usable = labelled.where(F.col("lang").isNotNull() & start.rlike(r"\p{L}")).select("doc_id", "text", "lang")
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return train([], [])
    quota = max(1, min(per_lang, SAMPLE_DOCS // len(sizes)))
    shares = labelled.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, quota / r["n"]) * (1 << 40)) for r in sizes], "_lang string, _share double"
    )
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < F.col("_share")
    # One row per language, at most MAX_LANGS.
    sample = usable.join(F.broadcast(shares), F.col("lang") == F.col("_lang")).where(drawn)
    rows = sorted((r["lang"], r["text"]) for r in sample.select("lang", start.alias("text")).collect())
    return train([t for _, t in rows], [lang for lang, _ in rows])


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` and ``rejected`` for every row, from whole texts.

    Null texts and texts without a letter are ``und``, score 0, and rejected; others
    are rejected if their score is below the calibrated threshold, or their share of
    unseen subwords above the calibrated one: the score only tells the trained languages
    from each other. Rows that repeat are read alike, and other columns are not looked at. The model has ``BUCKETS``
    rows per subword size of a number per language, and ``SEEN`` bits, which bounds what tasks receive.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def run(texts):
            langs, scores = zip(*map(model.predict, texts), strict=True)
            return [langs, scores, list(map(model.rejects, texts, langs, scores))]

        return run

    return map_texts(docs, keep, start, {"lang_pred": "string", "score": "double", "rejected": "boolean"})


def remainder(parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def fit_on_fold(docs: DataFrame) -> Model:
    """The registered query's model: all labelled documents but those with remainder 2 of 4 may be drawn."""
    return fit(docs.where(F.coalesce(remainder(4) != 2, F.lit(False))))
