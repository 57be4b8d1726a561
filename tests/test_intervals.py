import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from readloom.operators import intervals as I
from readloom.operators.reads import with_contig


def merge(spans, gap):
    """Merge as a scan over the sorted spans of a key."""
    out = []
    for key, s, e in sorted(spans):
        if out and out[-1][0] == key and s <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], e)
            out[-1][3] += 1
        else:
            out.append([key, s, e, 1])
    return sorted(map(tuple, out))


def spans(seed, n=400, contigs=3, reach=2000, longest=300):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        s = rnd.randint(1, reach)
        length = rnd.choice([0, 1, 5, 20, longest])
        out.append((rnd.randint(1, contigs), s, s + length))
    return out + out[: n // 3]  # copies


@pytest.mark.parametrize("bits", [0, 3, 6, 16])
@pytest.mark.parametrize("gap", [-1, 0, 1, 51])
def test_merge_matches_scan(frame, bits, gap):
    data = spans(bits * 100 + gap)
    if bits == 0:
        data = data[:60]
    df = frame(data, "k int, s int, e int")
    assert rows(I.merge_intervals(df, ["k"], "s", "e", gap, bits=bits)) == merge(data, gap)


@pytest.mark.parametrize("gap", [0, 1, 2])
def test_merge_around_bin_edges(frame, gap):
    # Ends and starts on both sides of an edge of bins of 8; each case is a key.
    data = []
    for a in range(4, 12):
        for b in range(a - 2, a + 6):
            key = a * 100 + b
            data += [(key, a - 2, a), (key, b, b + 3), (key, 30, 30)]
    df = frame(data, "k int, s int, e int")
    assert rows(I.merge_intervals(df, ["k"], "s", "e", gap, bits=3)) == merge(data, gap)


def test_gap_of_covered_intervals(frame):
    reads = frame([(1, 100, 200), (1, 251, 300), (1, 352, 400), (2, 1, 1)], "ref_idx int, pos int, end_pos int")
    # 251 = 200 + 51 joins; 352 = 300 + 52 does not; the last read is an interval of its own.
    assert rows(I.merge_reads(reads)) == [(1, 100, 300, 2), (1, 352, 400, 1), (2, 1, 1, 1)]


def test_contained_read_keeps_the_larger_end(frame):
    reads = frame([(1, 1, 500), (1, 10, 20), (1, 540, 560)], "ref_idx int, pos int, end_pos int")
    assert rows(I.merge_reads(reads)) == [(1, 1, 560, 3)]


def test_merge_ranges_is_strict_and_ignores_case(frame):
    df = frame([("chr1", 5, 100), ("CHR1", 110, 120), ("chr1", 131, 140)], "contig string, s int, e int")
    # 110 - 10 < 100 is false; 131 - 12 < 120 is true.
    assert rows(I.merge_ranges(df, 10)) == [("CHR1", 100, 120), ("chr1", 1, 100), ("chr1", 121, 140)]
    assert rows(I.merge_ranges(df, 12)) == [("chr1", 1, 140)]


def test_merge_ranges_without_overlap(frame):
    df = frame([("a", 5, 5), ("a", 5, 5), ("a", 5, 9), ("a", 8, 8), ("a", 9, 12)], "contig string, s int, e int")
    assert rows(I.merge_ranges(df, 0)) == [("a", 5, 5), ("a", 5, 5), ("a", 5, 9), ("a", 9, 12)]
    with pytest.raises(ValueError):
        I.merge_ranges(df, -1)


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_intersect_matches_all_pairs(frame, bits):
    rnd = random.Random(bits)

    def make(n):
        return [(rnd.randint(1, 2), s := rnd.randint(0, 300), s + rnd.choice([1, 3, 10, 90]), i) for i in range(n)]

    a, b = make(80), make(60)
    want = sorted(
        (c, max(s, t), min(e, f), i) for c, s, e, i in a for d, t, f, _ in b if c == d and s < f and t < e
    )
    schema = "ref_idx int, start0 int, end0 int, name int"
    assert rows(I.intersect_intervals(frame(a, schema), frame(b, schema), bits=bits)) == want


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_restrict_matches_exists(frame, bits):
    rnd = random.Random(bits + 7)
    a = [(rnd.randint(1, 2), s := rnd.randint(0, 900), s + rnd.choice([1, 4, 200]), i) for i in range(200)]
    b = [(rnd.randint(1, 2), s := rnd.randint(0, 900), s + rnd.choice([1, 2, 9, 40])) for _ in range(25)]
    want = sorted(x for x in a if any(x[0] == c and x[1] < e and s < x[2] for c, s, e in b))
    got = I.restrict(
        frame(a, "ref_idx int, start0 int, end0 int, name int"), frame(b, "ref_idx int, start0 int, end0 int"), bits=bits
    )
    assert rows(got) == want


def test_previous_end(frame):
    data = [(1, 0, 3), (1, 5, 6), (1, 9, 11), (1, 40, 44), (1, 45, 90), (1, 91, 92), (2, 7, 8)]
    df = frame(data, "k int, s int, e int")
    got = {(r.k, r.s): r.prev_end for r in I.with_previous_end(df, ["k"], "s", "e", 3).collect()}
    assert got == {(1, 0): None, (1, 5): 3, (1, 9): 6, (1, 40): 11, (1, 45): 44, (1, 91): 90, (2, 7): None}


def test_indels_to_targets(frame):
    reads = frame(
        [(1, 1, "5M2D5M"), (1, 1, "5M2D5M"), (1, 20, "6M1I4M"), (1, 100, "10M"), (2, 50, "2M1I1M1D3M")],
        "ref_idx int, pos int, cigar string",
    )
    loci = I.indel_loci(reads)
    assert rows(loci) == [(1, 6, "D", 2), (1, 26, "I", 1), (2, 52, "I", 1), (2, 53, "D", 1)]
    # 6 + 10 meets 26 - 10; the first start is kept at 1.
    assert rows(I.indel_targets(loci)) == [(1, 1, 36, 3), (2, 42, 63, 2)]


def test_text_forms(frame):
    covered = frame([(1, 1, 300, 3), (1, 400, 410, 1)], "ref_idx int, s int, e int, n long")
    contigs = frame([(1, "chr1", 1000)], "ref_idx int, contig string, length int")
    named = with_contig(covered, contigs)
    assert rows(I.bed_lines(named)) == [("chr1\t0\t300",), ("chr1\t399\t410",)]
    assert rows(I.region_strings(named)) == [("chr1:1-300",), ("chr1:400-410",)]
    span = I.interval_span(covered)
    assert rows(span) == [(1, 1, 410, 2)]
    assert rows(I.interval_label(with_contig(span, contigs))) == [("2regions_chr1-1",)]


def test_properties_of_merge(frame):
    data = spans(5, n=900)
    merged = I.merge_intervals(frame(data, "k int, s int, e int"), ["k"], "s", "e", 51, bits=7)
    out = merged.orderBy("k", "start").collect()
    assert sum(r.n for r in out) == len(data)
    assert all(b.start > a.end + 51 for a, b in zip(out, out[1:], strict=False) if a.k == b.k)


def test_hot_position_is_combined_before_the_shuffle(spark):
    reads = spark.range(30_000).select(
        F.lit(1).alias("ref_idx"),
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id")).cast("int").alias("pos"),
    )
    merged = I.merge_reads(reads.withColumn("end_pos", F.col("pos") + 9))
    assert rows(merged.select("s", "e", "n")) == [(1, 30_008, 30_000)]


def test_mismatch_clusters(frame):
    at = lambda p, wrong, n=8: [(1, p, 30, i < wrong) for i in range(n)]
    bases = at(100, 4) + at(105, 1) + at(109, 2) + at(118, 8) + at(128, 3) + at(140, 3, 3) + at(141, 4) + at(300, 4) + at(304, 4)
    loci = I.mismatch_loci(frame(bases, "ref_idx int, p int, q int, mm boolean"))
    # One in eight is too little, three reads are too few.
    assert sorted(r.p for r in loci.collect()) == [100, 109, 118, 128, 141, 300, 304]
    # 128 is ten bases after 118: that is no longer within the window.
    clusters = I.mismatch_clusters(loci)
    assert rows(clusters.select("s", "e", "n")) == [(100, 118, 3), (300, 304, 2)]
    gaps = frame([(1, 130, "D", 5), (1, 500, "I", 1)], "ref_idx int, locus int, op string, n long")
    assert rows(I.realignment_targets(gaps, clusters).select("s", "e", "support")) == [(90, 140, 8), (290, 314, 2), (490, 510, 1)]
