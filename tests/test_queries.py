"""Every registered query against its SQL, and the shape of its plan."""

import math
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from readloom.plans.catalog import QUERIES
from readloom.plans.oracle import oracle

ORACLE = oracle()

SURVEY_KEYS = """
placed_reads alignment_end contig_sort_key contig_counts region_assignment region_load read_region sorted_alignments
chunk_counts chunk_union covered_intervals bed_lines region_strings interval_span interval_label merged_ranges
interval_intersect restrict_to_targets clean_clip read_groups quality_encoding quality_fix mark_duplicates dup_metrics
dup_counts indel_loci indel_targets recal_table recal_apply aligned_bases pileup_alleles pileup called_variants variants_per_region variants_sorted concordance
matched_variants missed_variants realignment_targets recal_by_levels genotypes gap_alleles gap_genotypes normalised_concordance seed_votes seed_best chained_seeds placed_singly placed_pairs pair_duplicates pair_metrics fastq_scan sam_scan contig_dict bed_scan vcf_scan fasta_scan
""".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    return con


def test_every_key_is_registered():
    assert set(SURVEY_KEYS) == set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def table(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_result(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, df.collect()) == table(names, cursor.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_pairing_of_all_rows(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", ["covered_intervals", "interval_intersect", "indel_targets", "restrict_to_targets"])
def test_windows_are_keyed_by_contig_and_bin(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows
    for line in windows:
        assert "_bin" in line or "_own" in line


@pytest.mark.parametrize(
    "name",
    ["interval_intersect", "restrict_to_targets", "mark_duplicates", "recal_table", "clean_clip", "sam_scan"],
)
def test_result_without_small_sides(spark, duck, name):
    """What is broadcast only for its size gives the same by shuffled joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = table(df.columns, df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    cursor = duck.execute(ORACLE[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ref_idx", "s", "e", "n"] and df.count() > 0
