from conftest import rows

from readloom.operators import variants
from readloom.plans.variant_job import compare_vcf


def test_concordance_counts_distinct_truth_keys(spark, tmp_path):
    truth = ["chr1 3 . A G 9", "chr1 3 . A G 50", "chr1 4 . A T 9", "chrX 1 . C G,T 9", "scaffold_7 1 . A C 9"]
    calls = ["chr1 3 . A G 1", "chrX 1 . C G 9", "chr5 5 . A C 9", "scaffold_7 1 . A C 9"]
    head = "##contig=<ID=chr1,length=9>\n##contig=<ID=chr2>\n#CHROM\tPOS\n"
    for name, lines in (("a", truth), ("b", calls)):
        (tmp_path / name).write_text(head + "".join(x.replace(" ", "\t") + "\n" for x in lines))
    result = compare_vcf(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert rows(result) == [(3, 1, 2)]


def test_matched_and_missed(frame):
    schema = "contig string, pos int, ref string, alt string"
    a = frame([("c", 1, "A", "C")] * 3 + [("c", 2, "A", "C"), ("c", None, "A", "C")], schema)
    b = frame([("c", 1, "A", "C"), ("c", 3, "A", "C"), ("c", None, "A", "C")], schema)
    assert variants.matched(a, b).count() == 2
    assert rows(variants.missed(a, b)) == [("c", 2, "A", "C")]
    assert rows(variants.concordance(a, b)) == [(3, 2, 1)]
    assert rows(variants.concordance(a.limit(0), b)) == [(0, 0, 0)]
