import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from readloom.operators import duplicates, quality, reads, regions
from readloom.operators.ordering import layout, ranked


def test_placed_drops_unmapped_chrm_and_random(frame):
    df = frame(
        [(-1, 4, "a"), (0, 0, "b"), (1, 0, "c"), (24, 16, "d"), (25, 0, "e"), (3, 4, "f")],
        "ref_idx int, flag int, name string",
    )
    assert [r[2] for r in rows(reads.placed(df))] == ["c", "d"]
    assert [r[1] for r in rows(reads.placed(df.drop("flag")))] == ["c", "f", "d"]


def test_clean(frame):
    contigs = frame([(1, "chr1", 120)], "ref_idx int, contig string, length int")
    df = frame(
        [
            ("in", 1, 0, 21, 50, "100M"),
            ("over", 1, 0, 61, 50, "100M"),
            ("past", 1, 0, 121, 50, "100M"),
            ("unmapped", -1, 4, 0, 50, "*"),
        ],
        "name string, ref_idx int, flag int, pos int, mapq int, cigar string",
    )
    got = {r.name: (r.flag, r.cigar, r.clipped, r.mapq) for r in reads.clean(df, contigs).collect()}
    assert got == {"in": (0, "100M", 0, 50), "over": (0, "60M40S", 40, 50), "past": (4, "*", 0, 0), "unmapped": (4, "*", 0, 0)}
    got = {r.name: (r.cigar, r.clipped, r.mapq) for r in reads.clean(df.drop("flag"), contigs).collect()}
    assert got == {"in": ("100M", 0, 50), "over": ("60M40S", 40, 50), "past": ("*", 0, 0), "unmapped": ("*", 0, 0)}


def test_ranked_keeps_null_groups(frame):
    df = frame([(None, 1), (None, 2), ("a", 1)], "g string, x int")
    got = {(r.g, r.x, r.rn) for r in ranked(df, ["x"], ["g"]).collect()}
    assert got == {(None, 1, 1), (None, 2, 2), ("a", 1, 1)}


def test_a_null_score_never_wins(frame):
    df = frame([(1, None), (2, 50), (3, 40)], "id int, mapq int").selectExpr(
        "id", "mapq", "1 as ref_idx", "5 as pos", "'10M' as cigar", "false as neg"
    )
    got = {r.id: r.is_dup for r in duplicates.mark_duplicates(df, ["id"]).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_read_groups(frame):
    df = frame([(1,)], "x int")
    assert tuple(reads.with_read_group(df, rg_sm="S2").first()) == (1, "GROUP1", "LIB1", "ILLUMINA", "UNIT1", "S2")
    with pytest.raises(ValueError):
        reads.with_read_group(df, sample="S2")


def test_chunks(frame):
    a, b = frame([(1, "x")], "i int, c string"), frame([("y", 2), ("y", 3)], "c string, i int")
    both = reads.union_chunks([a, b])
    assert rows(both) == [(1, "x"), (2, "y"), (3, "y")]
    assert rows(reads.stage_counts(both, "c")) == [("x", 1), ("y", 2)]


def deal(counts, k):
    loads, out = [0] * k, []
    for c, contig in sorted((-c, contig) for contig, c in counts):
        i = loads.index(min(loads))
        loads[i] -= c
        out.append((contig, i + 1))
    return sorted(out)


@pytest.mark.parametrize("k", [1, 4, 6])
def test_balance(frame, k):
    rnd = random.Random(k)
    counts = [(i, rnd.choice([5, 5, 7, 90, 400])) for i in range(1, 25)]
    df = frame(counts, "ref_idx int, c long")
    assert rows(regions.balance_regions(df, k)) == deal(counts, k)
    load = regions.region_load(df, regions.balance_regions(df, k))
    assert sum(r.n for r in load.collect()) == sum(c for _, c in counts)


def test_balance_ties_and_few_contigs(frame):
    df = frame([(3, 10), (1, 10), (2, 10)], "ref_idx int, c long")
    assert rows(regions.balance_regions(df)) == [(1, 1), (2, 2), (3, 3)]
    assert rows(regions.balance_regions(frame([], "ref_idx int, c long"))) == []


def test_many_contigs_are_balanced_in_linear_time(spark):
    counts = spark.range(200_000).selectExpr("cast(id as int) as ref_idx", "id % 1000 as c")
    got = regions.balance_regions(counts, 3)
    load = [r.n for r in regions.region_load(counts, got).collect()]
    assert got.count() == 200_000 and max(load) - min(load) <= 1000


def test_contig_counts_largest_first(frame):
    df = frame([(2,), (1,), (2,), (3,), (1,)], "ref_idx int")
    assert [tuple(r) for r in regions.contig_counts(df).collect()] == [(1, 2), (2, 2), (3, 1)]


@pytest.fixture
def uncoalesced(spark):
    """Small partitions are else merged at run time."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_region_partitions_follow_each_other(uncoalesced):
    spark = uncoalesced
    df = spark.range(4000).select(
        (F.col("id") % 3 + 1).cast("int").alias("region"),
        (F.col("id") % 7).cast("int").alias("ref_idx"),
        # A third of the reads at one position.
        F.when(F.col("id") % 3 == 0, F.lit(9)).otherwise(F.hash("id") % 1000).alias("pos"),
        "id",
    )
    parts = regions.region_partitions(df, ["id"]).rdd.glom().collect()
    keys = [(r.region, r.ref_idx, r.pos, r.id) for part in parts for r in part]
    assert keys == sorted(keys) and len(keys) == 4000
    assert sum(1 for part in parts if part) > 1


def test_ranked(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(1, 3), 9 if i % 3 == 0 else rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, pos int, id int").repartition(7)
    want = []
    for g in (1, 2, 3):
        want += [(*r, n) for n, r in enumerate(sorted(x for x in data if x[0] == g), 1)]
    assert rows(ranked(df, ["pos", "id"], ["g"]).select("g", "pos", "id", "rn")) == sorted(want)
    everything = ranked(df, ["g", "pos", "id"]).select("g", "pos", "id", "rn")
    assert rows(everything) == sorted((*r, n) for n, r in enumerate(sorted(data), 1))


def test_layout_splits_one_hot_position(uncoalesced):
    df = uncoalesced.range(8000).select(F.lit(1).alias("ref_idx"), F.lit(5).alias("pos"), "id")
    sizes = [len(p) for p in layout(df, ["ref_idx", "pos", "id"]).rdd.glom().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000 / 2


def dup_rows(frame):
    data = [
        # id, ref, pos, cigar, neg, mapq, mate contig, mate pos, mate neg
        (1, 1, 100, "50M", False, 10, "=", 300, True),
        (2, 1, 110, "10S40M", False, 30, "=", 300, True),  # the same 5' base, better
        (3, 1, 100, "50M", True, 60, "=", 300, True),  # other strand
        (4, 1, 90, "60M", True, 60, "=", 300, True),  # ends with 3, a tie on score
        (5, 1, 100, "50M", False, 5, "=", 400, True),  # other mate
        (6, 2, 100, "50M", False, 5, "=", 300, True),  # alone
    ]
    schema = "id int, ref_idx int, pos int, cigar string, neg boolean, mapq int, mc string, mp int, mn boolean"
    return frame(data, schema)


def test_mark_duplicates(frame):
    df = dup_rows(frame)
    marked = duplicates.mark_duplicates(df, ["id"])
    assert [r.id for r in marked.where("is_dup").orderBy("id").collect()] == [1, 4, 5]
    assert marked.columns == [*df.columns, "is_dup"]
    paired = duplicates.mark_duplicates(df, ["id"], mate=["mc", "mp", "mn"])
    assert [r.id for r in paired.where("is_dup").orderBy("id").collect()] == [1, 4]
    assert rows(duplicates.duplicate_counts(df)) == [(6, 3)]
    assert rows(duplicates.dup_metrics(marked)) == [(6, 3, 0.5)]


def test_mark_duplicates_with_nulls_and_repeated_ids(frame):
    df = frame(
        [(1, 1, 5, "9M", False, 7, None), (1, 1, 5, "9M", True, 7, None), (2, 1, 5, "9M", False, None, None)],
        "id int, ref_idx int, pos int, cigar string, neg boolean, mapq int, lib string",
    )
    marked = duplicates.mark_duplicates(df, ["id"], within=["lib"])
    assert marked.count() == 3
    assert marked.where("not is_dup").groupBy("neg").count().count() == 2


def test_one_read_kept_per_key(spark):
    df = spark.range(6000).select(
        "id",
        F.lit(1).alias("ref_idx"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("pos"),
        F.lit("10M").alias("cigar"),
        (F.col("id") % 2 == 0).alias("neg"),
        (F.col("id") % 61).cast("int").alias("mapq"),
    )
    kept = duplicates.mark_duplicates(df, ["id"]).where("not is_dup")
    keys = df.select("pos", "neg").distinct().count()
    assert kept.count() == keys == kept.select("pos", "neg").distinct().count()


def test_first_read_decides_for_its_region(frame):
    df = frame(
        [
            (1, 4, 10, 1, [61, 40]),
            (1, 5, 2, 2, [40, 30]),  # negative once shifted; a later contig
            (2, 6, 10, 3, [60, 2]),
            (2, 6, 10, 4, [69, 40]),  # looks like Illumina, but its id comes later
            (3, 7, 10, 5, []),
        ],
        "region int, ref_idx int, pos int, id int, quals array<int>",
    )
    got = {r.id: (r.shift, r.quals, r.quality_error) for r in quality.rebase_region(df, ["id"]).collect()}
    assert got == {
        1: (True, [30, 9], None),
        2: (True, [9, -1], "quality below 0 when re-based: -1"),
        3: (False, [60, 2], None),
        4: (False, [69, 40], None),
        5: (False, [], None),
    }
    with pytest.raises(Exception, match="quality below 0 when re-based: -1"):
        quality.rebase_region(df, ["id"], strict=True).collect()


def test_packed_rank_is_hash_aggregated_and_keeps_the_order(frame):
    from readloom.operators import duplicates as D

    reads = frame(
        [(1, 50, None), (2, 50, 7), (-3, 50, 9), (4, 50, 9), (5, 80, None), (-6, 80, None), (9_000_000_000, 90, -(2**31)), (8, 90, None)],
        "id long, pos int, mapq int",
    ).selectExpr("id", "1 as ref_idx", "pos", "'10M' as cigar", "false as neg", "mapq")
    found = D.mark_duplicates(reads, ["id"])
    assert rows(found.where("not is_dup").select("id")) == [(-6,), (-3,), (9_000_000_000,)]
    as_struct = D.mark_duplicates(reads.withColumn("two", F.lit(0)), ["id", "two"])
    assert rows(as_struct.select("id", "is_dup")) == rows(found.select("id", "is_dup"))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
