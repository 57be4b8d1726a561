"""Sampled seeds and chains against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from conftest import rows, shuffled_rows
from pyspark.sql import functions as F

from readloom.operators import chaining, seeding


def least(text, k, w):
    words = [(hashlib.md5(text[i : i + k].encode()).hexdigest(), i + 1) for i in range(len(text) - k + 1)]
    return sorted({min(words[s : s + w])[1] for s in range(max(len(words) - w + 1, 1))}) if words else []


def letters(rnd, n):
    return "".join(rnd.choice("ACGT") for _ in range(n))


@pytest.mark.parametrize("k,w,spans", [(5, 4, (64, 16)), (15, 8, (1 << 16, 1 << 11, 1 << 7)), (3, 1, (7,))])
def test_minimisers_are_brute_force(frame, monkeypatch, k, w, spans):
    monkeypatch.setattr(chaining, "_SPANS", spans)
    rnd = random.Random(k)
    texts = [letters(rnd, n) for n in (0, k - 1, k, k + w - 2, k + w, 60, 700)] + ["a" * 100, "é\U0001f600" * 40]
    df = frame([*enumerate(texts), (99, None)], "t int, text string")
    got = rows(chaining.minimisers(df, ["t"], "text", k, w, F.md5))
    assert got == sorted((t, i, text[i - 1 : i - 1 + k]) for t, text in enumerate(texts) for i in least(text, k, w))


def brute_chains(reads, targets, k, w, places, min_score):
    words = lambda texts: {t: [(i, text[i - 1 : i - 1 + k]) for i in least(text, k, w)] for t, text in texts}
    theirs = words(targets)
    where = {}
    for t, found in theirs.items():
        for i, word in found:
            where.setdefault(word, []).append((t, i))
    best = {}
    for r, found in words(reads).items():
        seeds = sorted((len(where[word]), i, word) for i, word in found if word in where)
        taken, total = {}, 0
        for n, (often, i, word) in enumerate(seeds):
            total += often
            if total <= places or n == 0:
                for t, y in where[word]:
                    taken.setdefault(t, []).append((y, i))
        for t, hits in taken.items():
            bands = {}
            for y, x in hits:
                for half in (0, 1):
                    bands.setdefault((half, (y - x + half * 64) // 128), []).append((y, x))
            for inside in bands.values():
                done = []
                for y, x in sorted(inside):
                    f = k
                    for py, px, pf in done:
                        if px < x and py < y:
                            f = max(f, pf + min(x - px, y - py, k) - -(-abs((x - px) - (y - py)) // 4))
                    done.append((y, x, f))
                end = min((-f, y, x) for y, x, f in done)
                best[r, t] = min(best.get((r, t), end), end)
    return sorted((r, t, -f, y - x) for (r, t), (f, y, x) in best.items() if -f >= min_score)


def test_chains_are_brute_force(frame):
    rnd = random.Random(6)
    targets = [(i, letters(rnd, n)) for i, n in enumerate([0, 14, 40, 600, 900, 900])]
    targets += [(10, targets[3][1][100:400] + targets[4][1][:200]), (11, "ACAC" * 200), (12, "A" * 300)]
    reads = []
    for i in range(30):
        source = targets[3 + i % 3][1]
        s = rnd.randrange(len(source) - 200)
        text = source[s : s + 200]
        # Gaps of both kinds, and wrong letters.
        cut = rnd.randrange(40, 160)
        text = [text, text[:cut] + text[cut + 7 :], text[:cut] + letters(rnd, 9) + text[cut:]][i % 3]
        text = "".join(rnd.choice("ACGT") if rnd.random() < 0.02 else c for c in text)
        reads.append((i, text))
    reads += [(100, "AC" * 50), (101, "A" * 60), (102, "ACG"), (103, None)]
    got = chaining.chain_reads(frame(reads, "r int, text string"), frame(targets, "t int, text string"), "r", "t", order=F.md5, places=20)
    want = brute_chains([r for r in reads if r[1]], targets, 15, 8, 20, 30)
    assert rows(got) == want and len({r for r, *_ in want}) >= 28
    # A gap keeps its read in one chain.
    assert sum(max([s for r, t, s, _ in want if r == i and t < 10], default=0) > 60 for i in range(30)) >= 25


def test_chains_agree_with_votes_where_nothing_repeats(frame):
    rnd = random.Random(7)
    targets = frame([(i, letters(rnd, 2000)) for i in range(6)], "t int, text string")
    texts = {r.t: r.text for r in targets.collect()}
    reads = frame([(i, texts[i % 6][50 * i : 50 * i + 120]) for i in range(36)], "r int, text string")
    voted = {r.r: (r.t, r.diag) for r in seeding.seed_place(reads, targets, "r", "t").collect()}
    chained = chaining.chain_reads(reads, targets, "r", "t")
    best = {r.r: (r.t, r.diag) for r in seeding.best_placement(chained.withColumnRenamed("score", "votes"), "r", "t").collect()}
    assert best == voted and len(best) == 36


def test_a_frequent_seed_stays_linear(frame):
    rnd = random.Random(8)
    common = letters(rnd, 40)

    def found(n):
        targets = frame([(i, letters(rnd, 60) + common + letters(rnd, 60)) for i in range(n)], "t int, text string")
        texts = [r.text for r in targets.collect()]
        reads = frame([(i, texts[i][20:140]) for i in range(n)], "r int, text string")
        seeds = lambda df, key: chaining.minimisers(df, [key], "text")
        return chaining.anchors(seeds(reads, "r"), seeds(targets, "t"), "r", "t").count()

    small, large = found(100), found(200)
    # All reads and targets share seeds, but every read has rarer ones.
    assert large < 2.5 * small and large < 200 * (chaining.PLACES + 1)


def test_seeds_that_no_read_has_are_not_shuffled(frame):
    rnd = random.Random(9)
    targets = frame([(i, letters(rnd, 3000)) for i in range(20)], "t int, text string")
    text = targets.where("t = 3").first().text
    reads = frame([(1, text[500:640])], "r int, text string")
    seeds = chaining.minimisers(targets, ["t"], "text")
    assert shuffled_rows(seeds) == 0 and seeds.count() > 10_000
    found = chaining.anchors(chaining.minimisers(reads, ["r"], "text"), seeds, "r", "t")
    assert shuffled_rows(found) < 500 and {(r.t, r.y - r.x) for r in found.collect()} == {(3, 500)}


def test_no_partner_is_left_out(frame):
    rnd = random.Random(10)
    common = letters(rnd, 70)
    targets = [(i, letters(rnd, 30) + common + letters(rnd, 30)) for i in range(90)]
    reads = [(i, targets[i][1][10:120]) for i in range(3)] + [(7, common), (8, "AC" * 40)]
    targets += [(200, "ACAC" * 60), (201, common + letters(rnd, 9) + common)]
    got = rows(chaining.chain_reads(frame(reads, "r int, text string"), frame(targets, "t int, text string"), "r", "t", order=F.md5))
    assert got == brute_chains(reads, targets, 15, 8, 10**9, 30)
    assert all({t for r, t, *_ in got if r == i} >= set(range(90)) for i in (0, 1, 2, 7))


@pytest.mark.parametrize("k,w,piece", [(15, 8, 1 << 16), (5, 4, 16), (3, 1, 7), (1, 3, 5)])
def test_minimisers_among_words(frame, monkeypatch, k, w, piece):
    monkeypatch.setattr(chaining, "PIECE", piece)
    rnd = random.Random(k)
    texts = [letters(rnd, n) for n in (0, k - 1, k, k + w - 2, k + w, 60, 700)] + ["a" * 100, "é\U0001f600" * 40, "AC" * 50]
    df = frame([*((str(t), text) for t, text in enumerate(texts)), ("99", None)], "t string, text string")
    all_of = {(str(t), i, text[i - 1 : i - 1 + k]) for t, text in enumerate(texts) for i in least(text, k, w)}
    words = sorted({word for *_, word in all_of})[::3]
    got = rows(chaining.minimisers_among(df, ["t"], "text", frame([(x,) for x in words], "word string"), k, w, F.md5))
    assert len(got) == len(set(got)) and set(got) <= all_of
    assert {g for g in got if g[2] in set(words)} == {a for a in all_of if a[2] in set(words)}
    # Words are sifted: of random k-mers few others pass.
    assert k < 15 or len(got) < 1.1 * sum(a[2] in set(words) for a in all_of) + 3
    none = frame([], "word string")
    assert rows(chaining.minimisers_among(df, ["t"], "text", none, k, w, F.md5)) == []


def test_best_end_is_brute_force():
    rnd = random.Random(11)
    for n in (1, 5, 60, 400):
        for _ in range(10):
            places = sorted({(x + rnd.randrange(128), x) for x in (rnd.randrange(n + 9) for _ in range(n))})
            done = []
            for y, x in places:
                steps = [pf + min(x - px, y - py, 15) - -(-abs((x - px) - (y - py)) // 4) for py, px, pf in done if px < x and py < y]
                done.append((y, x, max([15, *steps])))
            want = min((-f, y, x) for y, x, f in done)
            assert chaining.best_end(*zip(*places, strict=True), 15) == (-want[0], *want[1:])
