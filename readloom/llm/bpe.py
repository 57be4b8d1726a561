"""Byte-level BPE by merge replay over all distinct words of a slice of the corpus at once."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from readloom.llm.common import map_texts

#: Bytes of text in a slice.
SLICE = 8 << 20
#: Words whose ids a task remembers between slices, and the longest such word.
REMEMBERED = 600_000
LONG_WORD = 64


@dataclass
class Vocabulary:
    """Ranks of byte strings, which are their ids, and the pattern that cuts texts into words."""

    ranks: dict[bytes, int]
    pattern: str

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of ids that merges, as ``left << 32 | right`` in order, and the rank of each."""
        get = self.ranks.get
        found = sorted(
            (left << 32 | right, rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (left := get(token[:i])) is not None and (right := get(token[i:])) is not None
        )
        keys, ranks = zip(*found, strict=True)
        return np.array(keys, np.int64), np.array(ranks, np.int64)

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return Vocabulary(ranks, pattern)


class Replay:
    """Merges in rank order through an index from the rank of a pair to its positions."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ranks = vocabulary.ranks
        self.cut = regex.compile(vocabulary.pattern).findall
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.bytes_to_ids = np.array(self.single, np.int64)
        self.table = vocabulary.pairs
        self.pairs: dict[tuple[int, int], int] = {}
        self.known: dict[str, bytes] = {}

    def rank_of(self, left: int, right: int) -> int:
        """Rank of the merged pair, -1 if there is none."""
        rank = self.pairs.get((left, right))
        if rank is None:
            rank = self.pairs[left, right] = self.ranks.get(self.token[left] + self.token[right], -1)
        return rank

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks = self.table
        wanted = left * (1 << 32) + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, ranks[at], -1)

    def encode_short(self, words: list[bytes]) -> list[bytes]:
        """As `encode_long`, with all words that hold a pair merged in one step.

        A word merges its leftmost place only; its other places wait until no lower
        rank is left. Steps grow with the length of words, so long ones go the other way.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.bytes_to_ids[np.frombuffer(b"".join(words), np.uint8)]
        stops = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        after[stops - 1] = -1
        before[stops - lengths] = -1
        index: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def note(left: np.ndarray, right: np.ndarray) -> None:
            ranks = self.ranks_of(ids[left], ids[right])
            left, ranks = left[ranks >= 0], ranks[ranks >= 0]
            if len(left):
                by_rank = np.argsort(ranks, kind="stable")
                left, ranks = left[by_rank], ranks[by_rank]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                for rank, a, b in zip(ranks[[0, *cuts]].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(left)], strict=True):
                    if rank not in index:
                        index[rank] = []
                        heappush(order, rank)
                    index[rank].append(left[a:b])

        here = np.flatnonzero(after >= 0)
        note(here, after[here])
        while order:
            rank = heappop(order)
            found = index.pop(rank)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[(ids[at] >= 0) & (after[at] >= 0)]
            at = at[self.ranks_of(ids[at], ids[after[at]]) == rank]
            if not len(at):
                continue
            own = word[at]
            first = np.ones(len(at), bool)
            first[1:] = own[1:] != own[:-1]
            if not first.all():
                index[rank] = [at[~first]]
                heappush(order, rank)
                at = at[first]
            gone = after[at]
            after[at] = following = after[gone]
            ids[at], ids[gone] = rank, -1
            inner = following >= 0
            before[following[inner]] = at[inner]
            ahead = before[at]
            note(np.concatenate([ahead[ahead >= 0], at[inner]]), np.concatenate([at[ahead >= 0], following[inner]]))
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept)[stops - 1] * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_long(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers.

        All words lie in one array of positions. The lowest rank present is merged
        first, in order of position, and a merge looks again only at the pairs with its two
        neighbours; a new pair of a lower rank comes next. A word thus sees its own merges in the
        order of the usual loop over its pairs, at a cost that grows with n log n.
        """
        ids = [self.single[b] for word in words for b in word]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        starts, at = [], 0
        for word in words:
            starts.append(at)
            at += len(word)
            before[starts[-1]] = -1
            after[at - 1] = -1
        index: dict[int, list[int]] = {}
        for i, j in enumerate(after):
            if j >= 0 and (rank := self.rank_of(ids[i], ids[j])) >= 0:
                index.setdefault(rank, []).append(i)
        order = sorted(index)
        while order:
            rank = order[0]
            places = index[rank]
            if not places:
                heappop(order)
                del index[rank]
                continue
            i = heappop(places)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.rank_of(ids[i], ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (new := self.rank_of(ids[left], ids[right])) >= 0:
                    if new not in index:
                        index[new] = []
                        heappush(order, new)
                    heappush(index[new], left)
        flat = np.array(ids, np.int64)
        stops = [*starts[1:], len(flat)]
        return [(x := flat[a:b])[x >= 0].astype("<u4").tobytes() for a, b in zip(starts, stops, strict=True)]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        cuts = [self.cut(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        fresh = sorted({w for words in cuts for w in words if w not in known})
        short, long, extra = [], [], {}
        for w in fresh:
            raw = w.encode("utf-8")
            if (whole := self.ranks.get(raw)) is not None:
                known[w] = whole.to_bytes(4, "little")
            else:
                (short if len(raw) <= LONG_WORD else long).append((w, raw))
        if short:
            known.update(zip([w for w, _ in short], self.encode_short([raw for _, raw in short]), strict=True))
        if long:
            extra = dict(zip([w for w, _ in long], self.encode_long([raw for _, raw in long]), strict=True))
            return [b"".join([known[w] if w in known else extra[w] for w in words]) for words in cuts]
        return [b"".join([known[w] for w in words]) for words in cuts]

    def decode(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode(docs: DataFrame, vocabulary: Vocabulary, decoded: bool = False) -> DataFrame:
    """``(doc_id, ids)`` for every row, ids as little-endian unsigned 32-bit integers; with ``decoded``, their bytes again.

    Each match of the pattern is encoded by itself; there are no special tokens. A
    task takes its texts in slices, replays the merges over the distinct words of a
    slice that it has not met, and remembers up to ``REMEMBERED`` of them, so memory has
    a bound and no text is shuffled. Null and empty texts have no ids; repeated rows
    stay; other columns are not looked at. The vocabulary (a fixed file) is broadcast.
    """
    vocabulary.pairs  # made once, here
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        replay = Replay(shared.value)

        def run(texts):
            ids = replay.encode([t or "" for t in texts])
            return [ids, [replay.decode(x) for x in ids]] if decoded else [ids]

        return run

    return map_texts(docs, ["doc_id"], start, {"ids": "binary"} | ({"decoded": "binary"} if decoded else {}), SLICE)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``; bytes that are not UTF-8 become the replacement character."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = Replay(shared.value)
        for batch in batches:
            texts = [replay.decode(ids or b"").decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
