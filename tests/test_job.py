"""From files to calls on a small made-up genome with planted variants."""

import gzip
import random

import pytest
from conftest import rows

from readloom import sources
from readloom.operators import recal, seeding
from readloom.plans.variant_job import call_variants, place_and_call

LENGTH = 3000
WIDTH = 1 << recal.BASE_BITS
TARGETS = [("chr1", 0, 1400), ("chr1", 2000, 3000), ("chrX", 0, 3000)]


def genome():
    rnd = random.Random(11)
    ref = {c: "".join(rnd.choice("ACGT") for _ in range(LENGTH)) for c in ("chrM", "chr1", "chrX")}
    variants = {}
    for c, pos in [("chr1", 501), ("chr1", 1024), ("chr1", 1025), ("chr1", 1700), ("chrX", 2500)]:
        old = ref[c][pos - 1]
        variants[c, pos] = (old, "ACGT"[("ACGT".index(old) + 1) % 4])
    return ref, variants


def sample(ref, variants, rnd, n):
    """Reads of 80 bases, half from an allele with the variants, with errors of 1 in 250."""
    own = {c: list(s) for c, s in ref.items()}
    for (c, pos), (_, alt) in variants.items():
        own[c][pos - 1] = alt
    for i in range(n):
        c = rnd.choice(["chr1", "chrX"])
        s = rnd.randrange(LENGTH - 80)
        seq = list((own if i % 2 else ref)[c][s : s + 80])
        for j in range(80):
            if rnd.random() < 0.004:
                seq[j] = rnd.choice("ACGT")
        yield c, s + 1, "".join(seq), rnd.random() < 0.5


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    ref, variants = genome()
    rnd = random.Random(5)
    (folder / "g.dict").write_text("@HD\n" + "".join(f"@SQ\tSN:{c}\tLN:{LENGTH}\n" for c in ref))
    fasta = "".join(
        f">{c}\n" + "".join(s[i : i + 60] + "\n" for i in range(0, LENGTH, 60)) for c, s in ref.items()
    )
    (folder / "g.fa").write_text(fasta)
    (folder / "t.bed").write_text("track\n" + "".join(f"{c}\t{s}\t{e}\n" for c, s, e in TARGETS))
    known = ("chr1", 501)
    (folder / "known.vcf").write_text(f"##x\n{known[0]}\t{known[1]}\trs\tA\tC\t.\t.\t.\n")
    sam, fastq = [], {0: [], 1: []}
    for i, (c, pos, seq, neg) in enumerate(sample(ref, variants, rnd, 2600)):
        sam.append(f"r{i}\t{16 if neg else 0}\t{c}\t{pos}\t60\t80M\t*\t0\t0\t{seq}\t{'E' * 80}")
        if neg:
            seq = seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        fastq[i % 2].append(f"@r{i}\n{seq}\n+\n{'E' * 80}\n")
    # Exact copies that would pass for evidence: one wrong base, sixty times.
    wrong = list(ref["chrX"][1000:1080])
    wrong[40] = "ACGT"[("ACGT".index(wrong[40]) + 1) % 4]
    sam += [f"copy{i}\t0\tchrX\t1001\t60\t80M\t*\t0\t0\t{''.join(wrong)}\t{'0' * 80}" for i in range(60)]
    sam += ["u\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tEEEE", f"m\t0\tchrM\t5\t60\t4M\t*\t0\t0\t{ref['chrM'][4:8]}\tEEEE", "broken\tline"]
    (folder / "x.sam").write_text("@HD\n" + "\n".join(sam) + "\n")
    (folder / "fq").mkdir()
    for chunk, records in fastq.items():
        with gzip.open(folder / "fq" / f"chunk{chunk}.fq.gz", "wt") as f:
            f.write("".join(records))
    return folder, variants


def inputs(spark, folder, overlap=0):
    contigs = sources.read_contigs(spark, str(folder / "g.dict"))
    return {
        "contigs": contigs,
        "ref_chunks": sources.read_fasta(spark, str(folder / "g.fa"), WIDTH, overlap),
        "known_sites": sources.read_vcf(spark, str(folder / "known.vcf")),
        "targets": sources.read_bed(spark, str(folder / "t.bed")),
    }


def expected(variants):
    return sorted(
        (c, p, *alleles)
        for (c, p), alleles in variants.items()
        if any(c == t and s < p <= e for t, s, e in TARGETS)
    )


def test_sam_to_vcf(spark, files, tmp_path):
    folder, variants = files
    given = inputs(spark, folder)
    alignments = sources.read_sam(spark, str(folder / "x.sam"), given["contigs"])
    result = call_variants(alignments, **given)

    # Two contigs hold reads; the fuller one is dealt first.
    assert sorted(r.region for r in result.contig_region.collect()) == [1, 2]
    assert result.reads.count() == 2660
    metrics = result.metrics.first()
    assert metrics.rg_lb == "LIB1" and metrics.n == 2660 and metrics.dups >= 59
    assert all(r.n > 0 for r in result.recal_table.collect())
    bed = rows(result.intervals.select("contig", "start0", "end0"))
    assert len(bed) == 3 and all(e - s > 900 for _, s, e in bed)
    assert result.indel_targets.count() == 0
    # Neighbouring differences are a target without any gap.
    assert [(r.s, r.e) for r in result.realignment_targets.collect()] == [(1014, 1035)]

    called = rows(result.variants.select("contig", "p", "ref", "alt"))
    assert called == expected(variants)
    sources.write_vcf(result.variants, str(tmp_path / "vcf"))
    text = [x for p in sorted((tmp_path / "vcf").glob("part-*")) for x in p.read_text().splitlines()]
    assert [tuple(x.split("\t")[:2]) for x in text] == [(c, str(p)) for c, p, *_ in expected(variants)]
    sources.write_vcf(result.variants, str(tmp_path / "by"), by_region=True)
    assert sorted(p.name for p in (tmp_path / "by").glob("region=*")) == ["region=1", "region=2"]


def test_deletion_and_genotypes_reach_the_vcf(spark, files):
    folder, _ = files
    given = inputs(spark, folder)
    ref, _ = genome()
    # A repeat of three units loses one on one allele; the gaps lie at different units.
    text = ref["chr1"]
    at = next(i for i in range(100, 1200) if text[i] != text[i + 1] and text[i : i + 2] == text[i + 2 : i + 4])
    start = next(s for s in range(at, 0, -1) if text[s - 1] != text[s + 1])
    sam = []
    for i in range(40):
        first = at - 30 - i % 7
        shift = 2 * (i % 2)
        if i % 2:
            left = start + shift - first
            seq, cigar = text[first : start + shift] + text[start + shift + 2 : first + 82], f"{left}M2D{80 - left}M"
        else:
            seq, cigar = text[first : first + 80], "80M"
        sam.append(f"d{i}\t{16 * (i % 4 // 2)}\tchr1\t{first + 1}\t60\t{cigar}\t*\t0\t0\t{seq}\t{'E' * 80}")
    path = folder / "deletion.sam"
    path.write_text("\n".join(sam) + "\n")
    alignments = sources.read_sam(spark, str(path), given["contigs"])
    result = call_variants(alignments, **given)
    [r] = result.variants.collect()
    assert (r.p, r.ref, r.alt, r.gt) == (start, text[start - 1 : start + 2], text[start - 1], "0/1")
    assert r.line.split("\t")[8] == "GT:DP:AD:GQ:PL" and r.line.split("\t")[9].startswith("0/1:")
    [t] = result.indel_targets.collect()
    assert t.s <= start + 1 <= t.e


def test_a_repeat_is_called_in_the_copy_of_the_mates(spark, tmp_path):
    rnd = random.Random(21)
    unit = "".join(rnd.choice("ACGT") for _ in range(300))
    parts = ["".join(rnd.choice("ACGT") for _ in range(700)) for _ in range(3)]
    text = parts[0] + unit + parts[1] + unit + parts[2]
    second = 700 + 300 + 700
    differs = second + 150
    alt = "ACGT"[("ACGT".index(text[differs]) + 1) % 4]
    own = text[:differs] + alt + text[differs + 1 :]
    flip = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    records = []
    for i in range(500):
        size = rnd.randrange(330, 370)
        s = rnd.randrange(0, len(own) - size)
        ends = [own[s : s + 80], flip(own[s + size - 80 : s + size])]
        records += [f"@p{i}/{m + 1}\n{ends[m]}\n+\n{'E' * 80}\n" for m in (0, 1)]
    (tmp_path / "fq").mkdir()
    (tmp_path / "fq" / "x.fq").write_text("".join(records))
    (tmp_path / "g.dict").write_text(f"@HD\n@SQ\tSN:chrM\tLN:9\n@SQ\tSN:chr1\tLN:{len(text)}\n")
    (tmp_path / "g.fa").write_text(f">chr1\n{text}\n")
    (tmp_path / "t.bed").write_text(f"chr1\t0\t{len(text)}\n")
    (tmp_path / "k.vcf").write_text("##x\nchr1\t5\trs\tA\tC\t.\t.\t.\n")
    contigs = sources.read_contigs(spark, str(tmp_path / "g.dict"))
    result = place_and_call(
        sources.read_fastq(spark, str(tmp_path / "fq"), split=20_000),
        sources.read_fasta(spark, str(tmp_path / "g.fa"), 256, seeding.K - 1),
        contigs,
        known_sites=sources.read_vcf(spark, str(tmp_path / "k.vcf")),
        targets=sources.read_bed(spark, str(tmp_path / "t.bed")),
    )
    [r] = result.variants.collect()
    assert (r.p, r.ref, r.alt, r.gt) == (differs + 1, text[differs], alt, "1/1")


def test_fastq_to_calls(spark, files):
    folder, variants = files
    given = inputs(spark, folder, seeding.K - 1)
    fastq = sources.read_fastq(spark, str(folder / "fq"))
    result = place_and_call(fastq, given.pop("ref_chunks"), given.pop("contigs"), **given)
    assert rows(result.variants.select("contig", "p", "ref", "alt")) == expected(variants)
    # Reads of a region, their contigs and the reads counted agree.
    per_region = result.reads.groupBy("region").count()
    assert sum(r["count"] for r in per_region.collect()) == result.reads.count() > 2500
