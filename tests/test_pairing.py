"""Placement of pairs and duplicates of pairs against plain Python."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from readloom.operators import duplicates, pairing

SIZE = 60


def flip(text):
    return text.translate(str.maketrans("ACGT", "TGCA"))[::-1]


@pytest.fixture(scope="module")
def genome():
    rnd = random.Random(4)
    ref = ["".join(rnd.choice("ACGT") for _ in range(4000)) for _ in range(2)]
    # A stretch of contig 0 comes again in it and on contig 1.
    ref[0] = ref[0][:2500] + ref[0][1000:1400] + ref[0][2900:]
    ref[1] = ref[1][:500] + ref[0][1000:1400] + ref[1][900:]
    return ref


@pytest.fixture(scope="module")
def placed(spark, genome):
    rnd = random.Random(8)
    contigs = spark.createDataFrame([(i + 1, f"chr{i + 1}", 4000) for i in range(2)], "ref_idx int, contig string, length int")
    chunks = spark.createDataFrame(
        [(f"chr{c + 1}", s + 1, text[s : s + 200 + 23]) for c, text in enumerate(genome) for s in range(0, 4000, 200)],
        "contig string, chunk_start int, bases string",
    )
    reads, truth = [], {}

    def add(name, c, start, length, turned, change=lambda s: s):
        fragment = genome[c][start : start + length]
        ends = [fragment[:SIZE], flip(fragment[-SIZE:])]
        places = [(c + 1, start + 1, False), (c + 1, start + length - SIZE + 1, True)]
        if turned:
            ends.reverse(), places.reverse()
        ends[1] = change(ends[1])
        truth[name] = places
        reads.extend((name, m + 1, ends[m], "".join(rnd.choice("EF") for _ in range(SIZE))) for m in (0, 1))

    for i in range(200):
        c = i % 2
        start = rnd.randrange(3000, 3600) if c == 0 else rnd.randrange(1000, 3600)
        add(f"u{i}", c, start, rnd.randrange(280, 320), i % 3 == 0)
    # One end in the repeat, the other outside it: the mate tells the copy.
    for i, (c, at) in enumerate([(0, 1000), (0, 2500), (1, 500)] * 4):
        add(f"r{i}", c, at + 350 - 20 * (i // 3), 300, i % 2 == 0)
    # A second end that differs every 12 bases has no long seed and is found near its mate.
    def worn(s):
        return "".join(flip(b)[0] if k % 12 == 11 else b for k, b in enumerate(s))

    for i in range(6):
        add(f"w{i}", 1, 1500 + 70 * i, 300, i % 2 == 0, worn)
    add("far", 1, 100, 3000, False)
    reads += [("noise", 1, genome[0][100:160], "E" * SIZE), ("noise", 2, "".join(rnd.choice("ACGT") for _ in range(SIZE)), "E" * SIZE)]
    reads += [("lone", 1, genome[0][3100:3160], "E" * SIZE), ("lone2", 2, flip(genome[0][3200:3260]), "E" * SIZE)]
    reads += [("none", 1, None, None), ("none", 2, "ACGT", "EEEE")]
    df = spark.createDataFrame(reads, "name string, mate int, seq string, qual string").selectExpr("'c' as chunk", "name as pair_id", "*")
    found = pairing.place_pairs(df, chunks, contigs, ["chunk", "pair_id"])
    alignments = pairing.as_alignments(found, contigs)
    return truth, {(r["name"], r["mate"]): r for r in found.collect()}, reads, alignments


def test_every_end_lies_where_it_was_drawn(placed):
    truth, got, reads, _ = placed
    assert len(got) == len(reads)
    for name, places in truth.items():
        for m in (1, 2):
            r = got[name, m]
            assert (r["ref_idx"], r["pos"], r["flag"] & 16 > 0) == places[m - 1], name
            assert (r["mate_ref"], r["mate_pos"], r["flag"] & 32 > 0) == places[2 - m], name
            assert r["flag"] & 0x1 and r["flag"] & (0x40 if m == 1 else 0x80) and not r["flag"] & 0xC
            assert bool(r["flag"] & 0x2) == (name != "far") and r["mapq"] == 60
            left, right = sorted(p[1] for p in places)
            assert r["tlen"] == (right + SIZE - left) * (1 if r["pos"] == left else -1)


def test_repeats_are_resolved_and_worn_ends_found(placed):
    truth, got, _, _ = placed
    assert any(got[f"w{i}", m]["votes"] >= pairing.RESCUE_VOTES for i in range(6) for m in (1, 2))
    assert {got[f"r{i}", 1]["ref_idx"] for i in range(12)} == {1, 2}


def test_single_and_lost_ends(placed):
    _, got, _, _ = placed
    assert (got["noise", 1]["flag"], got["noise", 2]["flag"]) == (0x1 | 0x8 | 0x40, 0x1 | 0x4 | 0x80)
    assert got["noise", 1]["mate_ref"] == -1 and got["noise", 1]["tlen"] == got["noise", 2]["pos"] == 0
    assert (got["lone", 1]["flag"], got["lone2", 2]["flag"]) == (0, 16)
    assert got["none", 1]["flag"] == got["none", 2]["flag"] == 4


def test_alignments_name_the_mate(placed):
    _, got, _, alignments = placed
    lines = {(r["qname"], bool(r["flag"] & 0x80)): r for r in alignments.collect()}
    assert lines["c:u1", False]["mate_contig"] == "=" and lines["c:u1", False]["template"] == "c:u1"
    assert lines["c:noise", False]["mate_contig"] == "*"
    r = lines["c:u1", True]
    assert (r["mate_pos"], r["tlen"]) == (got["u1", 2]["mate_pos"], got["u1", 2]["tlen"])


def test_few_pairs_are_placed_singly(spark, genome):
    contigs = spark.createDataFrame([(1, "chr1", 4000)], "ref_idx int, contig string, length int")
    chunks = spark.createDataFrame([("chr1", 1, genome[0])], "contig string, chunk_start int, bases string")
    reads = [("a", 1, genome[0][100:160], "E" * SIZE), ("a", 2, flip(genome[0][300:360]), "E" * SIZE)]
    df = spark.createDataFrame(reads, "name string, mate int, seq string, qual string")
    found = {r["mate"]: r for r in pairing.place_pairs(df, chunks, contigs, ["name"]).collect()}
    assert (found[1]["flag"], found[2]["flag"]) == (0x1 | 0x20 | 0x40, 0x1 | 0x10 | 0x80)
    assert (found[1]["tlen"], found[2]["tlen"]) == (260, -260)
    assert pairing.place_pairs(df.where("false"), chunks, contigs, ["name"]).count() == 0
    # Tables of pairs and sequences grow with the reads, whatever the planner takes their size for.
    plan = pairing.place_pairs(df, chunks, contigs, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


# Duplicates ---------------------------------------------------------------------


def brute(reads, within=False):
    def end(r):
        clips = r["cigar"].split("S")
        five = r["pos"] - (int(clips[0]) if len(clips) > 1 and clips[0].isdigit() else 0)
        if r["neg"]:
            tail = r["cigar"].rsplit("M", 1)[1]
            n = int(r["cigar"].rsplit("M", 1)[0].split("S")[-1])
            five = r["pos"] + n - 1 + (int(tail[:-1]) if tail else 0)
        return (r["ref_idx"], five, r["neg"]) + ((r["lib"],) if within else ())

    by = {}
    for r in reads:
        by.setdefault((r["name"], r["lib"] if within else 0), []).append(r)
    pairs, singles = {}, {}
    for key, group in by.items():
        if key[0] is not None and len(group) == 2:
            ends = tuple(sorted(map(end, group)))
            pairs.setdefault(ends, []).append((-sum(-1 if r["score"] is None else r["score"] for r in group), min(r["id"] for r in group), group))
        else:
            for r in group:
                singles.setdefault(end(r), []).append((1 if r["score"] is None else -r["score"], r["id"]))
    dup = {}
    for group in pairs.values():
        for k, (_, _, ends) in enumerate(sorted(group, key=lambda x: x[:2])):
            dup |= {r["id"]: k > 0 for r in ends}
    taken = {e for ends in pairs for e in ends}
    for e, group in singles.items():
        for k, (_, i) in enumerate(sorted(group)):
            dup[i] = k > 0 or e in taken
    return sorted(dup.items())


@pytest.mark.parametrize("within", [False, True])
def test_pair_duplicates_are_brute_force(frame, within):
    rnd = random.Random(1)
    reads = []
    for i in range(600):
        name = None if i % 50 == 0 else f"t{rnd.randrange(330)}"
        cigar = rnd.choice(["50M", "5S45M", "45M5S", "50M"])
        reads.append((i, name, rnd.randrange(1, 3), rnd.randrange(1, 14), cigar, rnd.random() < 0.5, rnd.choice([None, 3, 3, 9]), i % 2))
    columns = ["id", "name", "ref_idx", "pos", "cigar", "neg", "score", "lib"]
    df = frame(reads, "id long, name string, ref_idx int, pos int, cigar string, neg boolean, score int, lib int")
    got = duplicates.mark_pair_duplicates(df, "id", ["name"], within=["lib"] if within else [])
    assert rows(got.select("id", "is_dup")) == brute([dict(zip(columns, r, strict=True)) for r in reads], within)
    assert got.columns == [*df.columns, "is_dup", "dup_of"]


def test_a_clipped_mate_splits_no_group_and_other_fragments_stay(frame):
    schema = "id long, name string, ref_idx int, pos int, cigar string, neg boolean, score int"
    same = [(1, "a", 1, 101, "50M", False, 10), (2, "a", 1, 301, "50M", True, 10), (3, "b", 1, 104, "3S47M", False, 9), (4, "b", 1, 301, "45M5S", True, 9)]
    # Unclipped, b's reverse end would stop five bases later than a's.
    same[3] = (4, "b", 1, 301, "45M5S", True, 9)
    marked = lambda data: rows(duplicates.mark_pair_duplicates(frame(data, schema), "id", ["name"]).select("id", "is_dup"))
    assert marked(same) == [(1, False), (2, False), (3, True), (4, True)]
    # One end in common is another fragment.
    other = [*same[:2], (5, "c", 1, 101, "50M", False, 30), (6, "c", 1, 401, "50M", True, 30)]
    assert not any(d for _, d in marked(other))
    # A read whose mate has no place loses to a pair with the same end, whatever its score.
    assert marked([*same[:2], (7, "d", 1, 101, "50M", False, 99)]) == [(1, False), (2, False), (7, True)]
    assert marked([]) == []


def test_aggregations_of_pair_duplicates_are_by_hash(frame):
    df = frame([(1, "a", 1, 101, "50M", False, 10)], "id long, name string, ref_idx int, pos int, cigar string, neg boolean, score int")
    plan = duplicates.mark_pair_duplicates(df, "id", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_duplicates_name_what_they_equal_and_optical_ones_lie_near_it(frame):
    at = lambda i, name, pos, score, neg=False: (i, name, 1, pos, "50M", neg, score)
    tile = lambda n, x, y: f"m:1:f:1:{n}:{x}:{y}"
    names = [tile(7, 500, 500), tile(7, 580, 430), tile(7, 601, 500), tile(8, 500, 500), "no place"]
    reads = []
    for k, name in enumerate(names):
        reads += [at(2 * k, name, 101, 50 - k), at(2 * k + 1, name, 301, 50 - k, True)]
    reads += [at(20, tile(7, 1, 1), 901, 9), at(21, tile(7, 90, 101), 901, 5), at(22, tile(7, 500, 500) + " x", 101, 5)]
    df = frame(reads, "id long, qname string, ref_idx int, pos int, cigar string, neg boolean, score int")
    marked = duplicates.with_optical(duplicates.mark_pair_duplicates(df, "id", ["qname"]), "id")
    got = {r["id"]: r for r in marked.collect()}
    assert [got[i]["dup_of"] for i in (0, 2, 9, 20, 21, 22)] == [None, 0, 0, None, 20, None]
    assert sorted(i for i in got if got[i]["is_optical"]) == [2, 3, 21]
    m = duplicates.pair_metrics(marked, ["qname"]).first()
    assert (m["pairs"], m["pair_dups"], m["pair_optical"], m["single"], m["single_dups"]) == (5, 4, 1, 3, 2)
    # 4 pairs drawn, 1 different: x solves 1 / x = 1 - exp(-4 / x).
    assert m["library_size"] == 1


@pytest.mark.parametrize("size,drawn", [(1000, 500), (50_000, 60_000), (10**9, 10**6)])
def test_library_size_solves_its_equation(frame, size, drawn):
    import math

    distinct = round(size * (1 - math.exp(-drawn / size)))
    found = frame([(drawn, distinct), (7, 7), (0, 0)], "n long, c long").select(
        duplicates.library_size(F.col("n"), F.col("c")).alias("x")
    ).collect()
    assert found[1].x is None and found[2].x is None
    assert abs(distinct / found[0].x - (1 - math.exp(-drawn / found[0].x))) < 1 / found[0].x


def test_optical_copies_of_a_large_group_meet_in_parts(spark, frame):
    # Half of the copies lie beside the read that stays; the names of reads that equal none say a place too.
    reads = [(i, f"m:1:{500 if i % 2 == 0 else 900}:500", i > 0, 0 if i > 0 else None) for i in range(400)]
    reads += [(1000 + i, "m:1:500:500", True, None) for i in range(400)]
    df = frame(reads, "id long, qname string, is_dup boolean, dup_of long")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        found = duplicates.with_optical(df, "id", copies=10)
        assert sorted(r.id for r in found.where("is_optical").collect()) == list(range(2, 400, 2)) and found.count() == 800
        tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Reads without dup_of stay where they were, in at most as many tasks as the input has; the copies are spread.
    assert len(tasks) > 20
