"""Toxic spans and scores: a linear-chain CRF tags tokens, its marginals add up to a score of the document."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import map_texts
from readloom.llm.langid import remainder

#: Bound of the training sample: documents per label, and characters of a document that take part.
SAMPLE = {1: 1500, 0: 3000}
SAMPLE_CHARS = 6000
#: Rows of the weight table, and the byte lengths of the prefixes and n-grams of a word that are hashed to it.
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
GRAMS = (3, 4)
#: Passes over the sample, sentences of documents in a step, and pull of the weights to zero.
EPOCHS, STEPS, RATE, DECAY = 6, 24, 0.5, 1e-3
#: Marginal from which a token is tagged, and score from which a document is.
TAGGED, PREDICTED = 0.5, 0.3
#: Distinct words that a task remembers.
REMEMBERED = 300_000
LARGEST = 20.0

WORD = re.compile(r"[^\W\d_]+")


def prefix_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of each word and of its prefixes; 0 where a word is not longer than the prefix."""
    found = np.zeros((len(words), len(PREFIXES) + 1), np.uint64)
    found[:, 0] = [xxhash.xxh64_intdigest(w) for w in words]
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer(b"".join(words) + bytes(max(PREFIXES)), np.uint8)
    starts = np.cumsum(sizes) - sizes
    value = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(max(PREFIXES)):
        value = (value ^ codes[starts + k]) * np.uint64(0x100000001B3)
        value ^= value >> np.uint64(29)
        if k + 1 in PREFIXES:
            at = PREFIXES.index(k + 1) + 1
            found[:, at] = np.where(sizes > k + 1, value + np.uint64(k), 0)
    return found


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for every word one after another, and where each word's begin.

    A word has its own row, one per prefix and one per n-gram of bytes with its edges.
    """
    whole = prefix_hashes(words)
    rows, owners = [], []
    at, kind = np.nonzero(whole)
    rows.append((whole[at, kind] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64))
    owners.append(at)
    edged = [b"\x02" + w + b"\x03" for w in words]
    sizes = np.array([len(w) for w in edged], np.int64)
    codes = np.frombuffer(b"".join(edged) + bytes(4), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))
    for size in GRAMS:
        code = np.full(len(owner), size, np.uint64)
        for k in range(size):
            code = code << np.uint64(8) | codes[k : k + len(owner)]
        fits = left >= size
        rows.append((code[fits] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64))
        owners.append(owner[fits])
    flat, owner = np.concatenate(rows).astype(np.int32), np.concatenate(owners)
    del rows, owners
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return flat[order], np.cumsum(counts) - counts


def word_bytes(word: str) -> bytes:
    return word.lower().encode("utf-8")


@dataclass
class Chain:
    """Potentials of a chain of tags 0 (clean) and 1 (toxic): from tag to tag, and of the first tag, as odds."""

    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def ratios(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds of tag 1 for chains laid end to end; ``first`` marks where one begins.

        The odds go through a token by a fraction of two linear terms, so a run of tokens is a
        2 x 2 matrix: about sqrt(n) runs of sqrt(n) tokens are multiplied out side by side, joined, and
        gone through again with the odds that enter each. Long texts cost what many short ones do.
        """
        n = len(emission)
        width = int(np.ceil(np.sqrt(max(n, 1))))
        columns = -(-n // width)
        a = np.exp(self.moves)
        opening = np.exp(np.clip(self.start, -LARGEST, LARGEST))

        def laid(x: np.ndarray, fill) -> np.ndarray:
            out = np.full(width * columns, fill, x.dtype)
            out[:n] = x
            return np.ascontiguousarray(out.reshape(columns, width).T)

        odds = laid(np.exp(np.clip(emission, -LARGEST, LARGEST)), 1.0)
        cut = laid(first, True)
        p00, p01, p10, p11 = (np.full(columns, float(x)) for x in (1, 0, 0, 1))
        for e, c in zip(odds, cut, strict=True):
            n00, n01 = p00 * a[0, 0] + p01 * a[1, 0], (p00 * a[0, 1] + p01 * a[1, 1]) * e
            n10, n11 = p10 * a[0, 0] + p11 * a[1, 0], (p10 * a[0, 1] + p11 * a[1, 1]) * e
            s0, s1 = p00 + p01, p10 + p11
            n00, n01 = np.where(c, s0, n00), np.where(c, s0 * opening * e, n01)
            n10, n11 = np.where(c, s1, n10), np.where(c, s1 * opening * e, n11)
            scale = 1 / (n00 + n01 + n10 + n11)
            p00, p01, p10, p11 = n00 * scale, n01 * scale, n10 * scale, n11 * scale
        enter, leave = np.ones(columns), np.ones(columns)
        for k in range(1, columns):
            r = enter[k - 1]
            enter[k] = (p01[k - 1] + r * p11[k - 1]) / (p00[k - 1] + r * p10[k - 1])
        for k in range(columns - 2, -1, -1):
            q = leave[k + 1]
            leave[k] = (p10[k + 1] + p11[k + 1] * q) / (p00[k + 1] + p01[k + 1] * q)
        forward, backward = np.empty_like(odds), np.empty_like(odds)
        r = enter
        for k in range(width):
            r = np.where(cut[k], opening, (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)) * odds[k]
            forward[k] = r
        q = leave
        for k in range(width - 1, -1, -1):
            backward[k] = q
            through = odds[k] * q
            q = np.where(cut[k], 1.0, (a[1, 0] + a[1, 1] * through) / (a[0, 0] + a[0, 1] * through))
        return forward.T.ravel()[:n], backward.T.ravel()[:n]

    def marginals(self, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of tag 1 of every token, given all tokens of its chain."""
        forward, backward = self.ratios(emission, first)
        both = forward * backward
        return both / (1 + both)

    def expected_moves(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and expected counts of moves from tag to tag."""
        forward, backward = self.ratios(emission, first)
        inner = np.flatnonzero(~first)
        a, r = np.exp(self.moves), forward[inner - 1]
        through = np.exp(np.clip(emission[inner], -LARGEST, LARGEST)) * backward[inner]
        shares = np.stack([np.full(len(inner), a[0, 0]), a[0, 1] * through, r * a[1, 0], r * a[1, 1] * through])
        both = forward * backward
        return both / (1 + both), (shares / shares.sum(axis=0)).sum(axis=1).reshape(2, 2)


@dataclass
class Model:
    """``weights`` of word features, the chain over them, and the logistic ``scale`` from marginals to a score."""

    weights: np.ndarray
    chain: Chain
    scale: np.ndarray

    def emissions(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        rows, starts = features(words)
        return np.add.reduceat(self.weights[rows].astype(np.float64), starts)


def evidence(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each document: log of the expected toxic tokens, log odds of the likeliest one, log of all tokens, and 1."""
    out = np.zeros((len(sizes), 4))
    out[:, 0], out[:, 1], out[:, 3] = np.log(1e-4), -LARGEST / 2, 1
    some = np.flatnonzero(sizes)
    if len(some):
        at = (np.cumsum(sizes) - sizes)[some]
        likeliest = np.maximum.reduceat(marginals, at)
        out[some, 0] = np.log(np.add.reduceat(marginals, at) + 1e-4)
        out[some, 1] = np.clip(np.log(likeliest + 1e-12) - np.log1p(-likeliest + 1e-12), -LARGEST / 2, LARGEST / 2)
    out[:, 2] = np.log1p(sizes)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last column, the constant, is not pulled to zero."""
    pull = np.diag([*[ridge] * (x.shape[1] - 1), 1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + pull
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (y - p) - pull @ w), -5, 5)
    return w


class Tokens:
    """Texts as numbers of distinct words, laid end to end."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[str, int] = {}
        found = [np.array([numbers.setdefault(w, len(numbers)) for w in WORD.findall(t)], np.int32) for t in texts]
        known: dict[bytes, int] = {}
        lowered = np.array([known.setdefault(word_bytes(w), len(known)) for w in numbers], np.int32)
        self.words = list(known)
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.word = lowered[np.concatenate(found)] if numbers else np.empty(0, np.int32)
        self.stops = np.cumsum(self.sizes)

    def of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of some documents, and which of them begin one."""
        docs = docs[self.sizes[docs] > 0]
        sizes = self.sizes[docs]
        offsets = np.cumsum(sizes) - sizes
        places = np.arange(sizes.sum()) + np.repeat(self.stops[docs] - sizes - offsets, sizes)
        first = np.zeros(len(places), bool)
        first[offsets] = True
        return places, first


def token_labels(tokens: Tokens, labels: np.ndarray) -> np.ndarray:
    """Tags of the tokens from the labels of their documents: 1 for a word that marks toxic documents.

    A word marks them itself or by a prefix: by the likelihood ratio of the numbers of toxic and clean
    documents that hold it, at a level that no chance among all words and prefixes reaches, and only if a
    toxic document is ten times likelier to hold it. All tokens of clean documents are clean.
    """
    keys = prefix_hashes(tokens.words)
    owners = np.repeat(np.arange(len(labels)), tokens.sizes)
    pairs = np.unique(owners * len(tokens.words) + tokens.word)
    doc, word = pairs // len(tokens.words), pairs % len(tokens.words)
    distinct, number = np.unique(keys, return_inverse=True)
    number = number.reshape(keys.shape).astype(np.int32)
    d1, d0 = np.zeros(len(distinct)), np.zeros(len(distinct))
    for column in number.T:
        # A prefix counts once a document, however many of its words begin with it.
        held = np.unique(doc * len(distinct) + column[word])
        label = labels[held // len(distinct)]
        held %= len(distinct)
        d1 += np.bincount(held[label == 1], minlength=len(distinct))
        d0 += np.bincount(held[label == 0], minlength=len(distinct))
    n1, n0 = float((labels == 1).sum()), float((labels == 0).sum())
    share = (d1 + d0) / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.nan_to_num(d1 * np.log(d1 / (n1 * share))) + np.nan_to_num(d0 * np.log(d0 / (n0 * share))))
    level = 2 * np.log(10 * max(len(distinct), 1))
    marks = (ratio > level) & (d1 / n1 > 10 * d0 / n0) & (distinct != 0)
    marked = marks[number].any(axis=1)
    return (marked[tokens.word] & (labels[owners] == 1)).astype(np.float64)


def train(texts: list[str], labels: list[int], seed: int = 0) -> Model:
    """CRF weights by AdaGrad on documents whose tokens carry tags; every fifth document scales the score.

    Toxic documents without a tagged token are left out of the first half of the passes; then
    their likeliest token is tagged, and others' tokens that the model finds likely.
    Without both labels there is nothing to learn: the score is the share of toxic documents.
    """
    y = np.array(labels, np.int64)
    model = Model(np.zeros(BUCKETS, np.float32), Chain(), np.zeros(4))
    if len(set(labels)) < 2:
        model.scale[3] = 30 * (2 * float(y.mean()) - 1) if len(y) else -30
        return model
    rng = np.random.default_rng(seed)
    tokens = Tokens(texts)
    if not tokens.words:
        model.scale = logistic(evidence(np.empty(0), tokens.sizes), y)
        return model
    order = rng.permutation(len(y))
    tuned, learned = (order[::5], np.delete(order, np.s_[::5])) if len(order) >= 100 else (order, order)
    taught = np.zeros(len(y), bool)
    taught[learned] = True
    tags = token_labels(tokens, np.where(taught, y, -1))
    rows, starts = features(tokens.words)
    counts = np.diff(np.append(starts, len(rows)))
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    chain, chain_squares = Chain(np.log(np.array([[0.9, 0.1], [0.5, 0.5]])), np.full(5, 1.0)), None
    chain.start, chain_squares = -2.0, np.full(5, 1.0)

    def emissions() -> np.ndarray:
        return np.add.reduceat(weights[rows], starts)

    for epoch in range(EPOCHS):
        if epoch == EPOCHS // 2:
            _tag_again(tokens, chain, emissions(), learned[y[learned] == 1], tags)
        owners = np.repeat(np.arange(len(y)), tokens.sizes)
        has = np.bincount(owners, weights=tags, minlength=len(y)) > 0
        usable = learned[(y[learned] == 0) | has[learned]]
        for part in np.array_split(rng.permutation(usable), min(STEPS, max(len(usable) // 8, 1))):
            places, first = tokens.of(part)
            if not len(places):
                continue
            word, truth = tokens.word[places], tags[places]
            p, moves = chain.expected_moves(emissions()[word], first)
            slope = np.bincount(word, weights=truth - p, minlength=len(tokens.words))
            grad = np.bincount(rows, weights=np.repeat(slope, counts), minlength=BUCKETS) - DECAY * weights
            squares += grad**2
            weights += RATE * grad / np.sqrt(squares)
            inner = np.flatnonzero(~first)
            seen = np.bincount((2 * truth[inner - 1] + truth[inner]).astype(np.int64), minlength=4).reshape(2, 2)
            change = np.append((seen - moves).ravel(), (truth[first] - p[first]).sum())
            chain_squares += change**2
            change = 0.2 * change / np.sqrt(chain_squares)
            chain.moves = chain.moves + change[:4].reshape(2, 2)
            chain.start += float(change[4])
    model.weights, model.chain = weights.astype(np.float32), chain
    places, first = tokens.of(tuned)
    p = chain.marginals(np.add.reduceat(model.weights[rows].astype(np.float64), starts)[tokens.word[places]], first)
    model.scale = logistic(evidence(p, tokens.sizes[tuned]), y[tuned])
    return model


def _tag_again(tokens: Tokens, chain: Chain, emissions: np.ndarray, toxic: np.ndarray, tags: np.ndarray) -> None:
    places, first = tokens.of(toxic)
    if not len(places):
        return
    p = chain.marginals(emissions[tokens.word[places]], first)
    tags[places[p >= TAGGED]] = 1
    starts = np.flatnonzero(first)
    likeliest = np.maximum.reduceat(p, starts)
    own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(p))))
    none = np.add.reduceat(tags[places], starts) == 0
    tags[places[none[own] & (p == likeliest[own])]] = 1


def fit(labelled: DataFrame, sample: dict[int, int] = SAMPLE, max_chars: int = SAMPLE_CHARS) -> Model:
    """A model from a bounded sample of ``(doc_id, text, toxic)``.

    Of each label the ``sample`` documents with the smallest hashes of their id are drawn, with their first
    ``max_chars`` characters: that bounds what the driver receives. Rows without a label give nothing.
    """
    usable = labelled.where(F.col("toxic").isin(0, 1)).select(
        F.col("toxic").cast("int").alias("toxic"), F.left(F.coalesce("text", F.lit("")), F.lit(max_chars)).alias("text"),
        F.xxhash64("doc_id").alias("draw"),
    )
    rows = []
    for label, n in sample.items():
        rows += usable.where(F.col("toxic") == label).orderBy("draw", "text").limit(n).collect()
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def fit_on_fold(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> Model:
    """The registered query's model: labelled documents but those with remainder 2 of 4 may be drawn.

    A document with several labels counts as toxic if one of them says so. The ids are drawn
    first, so that only texts of the sample leave their tasks.
    """
    of = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = docs.where(F.coalesce(remainder(4) != 2, F.lit(False))).select("doc_id").distinct().join(of, "doc_id")
    drawn = None
    for label, n in sample.items():
        some = ids.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        drawn = some if drawn is None else drawn.unionAll(some)
    # At most the rows of ``sample``.
    return fit(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), sample)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns with ``score``, ``predicted`` and ``spans`` for every row, from whole texts.

    ``spans`` are the runs of tagged tokens as ``start:stop`` in code points, ``stop`` exclusive,
    comma-joined. Null and empty texts and texts without letters have no token: their score is
    what the model gives for none. Texts may be of any length, rows that repeat score alike,
    and other columns are not looked at. The model has a fixed size, which bounds what tasks receive.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model, known = shared.value, {}

        def run(texts):
            found = [WORD.findall(t) if t else [] for t in texts]
            new = list(dict.fromkeys(w for words in found for w in words if w not in known))
            known.update(zip(new, model.emissions([word_bytes(w) for w in new]).tolist(), strict=True))
            sizes = np.array([len(f) for f in found], np.int64)
            emission = np.array([known[w] for words in found for w in words])
            first = np.zeros(len(emission), bool)
            first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
            p = model.chain.marginals(emission, first)
            scores = sigmoid(evidence(p, sizes) @ model.scale)
            if len(known) > REMEMBERED:
                known.clear()
            stops = np.cumsum(sizes)
            spans = [tagged_spans(t, p[j - n : j]) for t, n, j in zip(texts, sizes.tolist(), stops.tolist(), strict=True)]
            return [scores, (scores >= PREDICTED).astype(np.int64), spans]

        return run

    found = map_texts(docs, keep, start, {"score": "double", "predicted": "long", "spans": "string"})
    return found.withColumn("predicted", F.col("predicted").cast("int"))


def tagged_spans(text: str | None, marginals: np.ndarray) -> str:
    """Runs of neighbouring tagged tokens."""
    tagged = (marginals >= TAGGED).tolist()
    if not any(tagged):
        return ""
    runs: list[list[int]] = []
    last = False
    for match, tag in zip(WORD.finditer(text), tagged, strict=True):
        if tag and last:
            runs[-1][1] = match.end()
        elif tag:
            runs.append(list(match.span()))
        last = tag
    return ",".join(f"{a}:{b}" for a, b in runs)
