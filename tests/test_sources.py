import gzip
import io
import os
import random
import subprocess
import sys

import pytest
from conftest import rows, shuffled_rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from readloom import sources
from readloom.sources import fastq


def test_dictionary(spark, tmp_path):
    path = tmp_path / "x.dict"
    path.write_text("@HD\tVN:1.0\n@SQ\tSN:chrM\tLN:16571\tUR:file:/a:b\n@SQ SN:chr1 LN:abc\n@SQ\tSN:HLA:1\tLN:7")
    assert rows(sources.read_contigs(spark, str(path))) == [(0, "chrM", 16571), (1, "chr1", 0), (2, "HLA:1", 7)]


def test_sam(spark, tmp_path, frame):
    path = tmp_path / "x.sam"
    good = "r1\t16\tchr1\t5\t60\t4M\t=\t9\t-3\tACGT\t@III\tNM:i:1\tRG:Z:a"
    bad = ["short\t0\tchr1", "r2\tx\tchr1\t5\t60\t4M\t=\t9\t-3\tACGT\tIIII"]
    none = "r3\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*"
    path.write_text("\n".join(["@HD\tVN:1.0", "@SQ\tSN:chr1\tLN:9", good, *bad, none]) + "\n")
    contigs = frame([(1, "chr1", 9)], "ref_idx int, contig string, length int")
    got = {r.qname or r._corrupt: r for r in sources.read_sam(spark, str(path), contigs).collect()}
    assert set(got) == {"r1", *bad, "r3"}
    r1 = got["r1"]
    assert (r1.flag, r1.contig, r1.ref_idx, r1.pos, r1.mapq, r1.cigar) == (16, "chr1", 1, 5, 60, "4M")
    assert (r1.mate_contig, r1.mate_pos, r1.tlen, r1.seq, r1.qual) == ("=", 9, -3, "ACGT", "@III")
    assert r1.tags == ["NM:i:1", "RG:Z:a"] and r1.quals == [31, 40, 40, 40] and r1._corrupt is None
    assert got["r3"].ref_idx == -1 and got["r3"].quals is None and got["r3"].tags == []
    assert got[bad[0]].flag is None


def test_bed(spark, tmp_path):
    path = tmp_path / "x.bed"
    path.write_text("browser hide\ntrack name=a\n#c\ntrack1\t0\t10\nchr2\t5\t9\tname\t7\n\n")
    assert rows(sources.read_bed(spark, str(path))) == [("chr2", 5, 9, "name\t7"), ("track1", 0, 10, None)]
    assert rows(sources.bed_header(spark, str(path))) == [("#c",), ("browser hide",), ("track name=a",)]


def test_vcf_keeps_its_lines(spark, tmp_path):
    path = tmp_path / "x.vcf"
    lines = ["chrX\t7\t.\tA\tG,T\t50\tPASS\tDP=3\tGT\t0/1", "chr1\t3\trs1\tC\tT\t.\t.\t."]
    path.write_text("##contig=<ID=chr1,length=9>\n#CHROM\tPOS\n" + "\n".join(lines) + "\n")
    got = sources.read_vcf(spark, str(path)).orderBy("contig").collect()
    assert [r.line for r in got] == [lines[1], lines[0]]
    assert (got[1].pos, got[1].alt, got[1].qual, got[1].info) == (7, "G,T", 50.0, "DP=3")
    assert got[0].qual is None


def record(name, seq, qual):
    return f"@{name}\n{seq}\n+\n{qual}\n"


def test_fastq(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    with gzip.open(folder / "chunk0.fq.gz", "wt") as f:
        f.write(record("a/1", "ACGT", "@III") + record("a/2", "GG", "@+") + record("b/1", "T", "I") + record("b/2", "C", "+"))
    (folder / "chunk1.fq").write_text(record("c/1", "A", "@").rstrip("\n"))
    (folder / "_SUCCESS").write_text("")
    got = sources.read_fastq(spark, str(folder))
    assert rows(got) == [
        ("chunk0", 0, 1, "a/1", "ACGT", "@III"),
        ("chunk0", 0, 2, "a/2", "GG", "@+"),
        ("chunk0", 1, 1, "b/1", "T", "I"),
        ("chunk0", 1, 2, "b/2", "C", "+"),
        ("chunk1", 0, 1, "c/1", "A", "@"),
    ]
    assert got.rdd.getNumPartitions() == 2
    assert sources.read_fastq(spark, str(tmp_path / "missing")).count() == 0
    assert sources.read_fastq(spark, str(folder / "chunk1.fq")).count() == 1


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_plain_fastq_in_ranges(spark, tmp_path, ending):
    rnd = random.Random(9)
    records = []
    for i in range(400):
        n = rnd.choice([1, 2, 30, 31])
        seq, qual = "".join(rnd.choice("ACGTN") for _ in range(n)), "".join(rnd.choice("@+I") for _ in range(n))
        records.append(f"@r{i // 2}/{i % 2 + 1}{ending}{seq}{ending}+{'@x' if i % 7 == 0 else ''}{ending}{qual}{ending}")
    (tmp_path / "a.x.fq").write_bytes("".join(records).encode() + ending.encode())
    (tmp_path / "b.fq").write_text(record("z", "A", "@"))
    whole = rows(sources.read_fastq(spark, str(tmp_path)))
    assert [r[:3] for r in whole if r[0] == "a"] == [("a", i // 2, i % 2 + 1) for i in range(400)]
    for split in (64, 997, 9000):
        got = sources.read_fastq(spark, str(tmp_path), split=split)
        assert rows(got) == whole and got.rdd.getNumPartitions() > (tmp_path / "a.x.fq").stat().st_size // split


def test_every_seam_finds_its_record(tmp_path, monkeypatch):
    monkeypatch.setattr(fastq, "_BLOCK", 64)
    rnd = random.Random(2)
    texts = []
    for i in range(40):
        n = rnd.randrange(3, 12)
        texts.append(f"@r{i}\n{'ACGT' * n}\n+\n{''.join(rnd.choice('@+') for _ in range(4 * n))}\n")
    path = tmp_path / "x.fq"
    path.write_text("".join(texts))
    starts = [sum(map(len, texts[:i])) for i in range(len(texts) + 1)]
    with open(path, "rb") as raw:
        for at in range(starts[-1] - 1):
            want = min(s for s in starts if s >= at)
            found = fastq._first_record(raw, fastq._Range(str(path), "x", at, at + 50))
            assert (starts[-1] if found is None else found) == want


def test_doubtful_seams_raise(spark, tmp_path):
    (tmp_path / "c.fq").write_text("@a\nAC\n+\nIII\n" * 50)
    with pytest.raises(Exception, match="cannot tell where records start"):
        sources.read_fastq(spark, str(tmp_path), split=100).collect()


def test_fastq_folders(spark, tmp_path):
    for lane in ("l1", "l2"):
        (tmp_path / lane).mkdir()
        (tmp_path / lane / "s.fq").write_text(record(lane, "A", "I"))
    (tmp_path / "l2" / "t.fq").write_text(record("t", "A", "I"))
    got = sources.read_fastq(spark, [str(tmp_path / "l1"), str(tmp_path / "l2")])
    assert [r[0] for r in rows(got)] == ["l1/s", "l2/s", "l2/t"]
    assert sorted(r[0] for r in rows(sources.read_fastq(spark, [str(tmp_path / "l1" / "s.fq"), str(tmp_path / "l2" / "t.fq")]))) == ["s", "t"]


def test_fastq_source_travels_without_the_package(spark, tmp_path):
    sources.read_fastq(spark, str(tmp_path))  # marks the module
    (tmp_path / "source").write_bytes(cloudpickle.dumps(fastq.FastqSource))
    code = "import pickle, sys; print(pickle.load(open(sys.argv[1], 'rb')).name())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code, str(tmp_path / "source")], cwd="/", env=env, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip() == "fastq", done.stderr


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_fastq_blocks(block, ending, monkeypatch):
    monkeypatch.setattr(fastq, "_BLOCK", block)
    lines = [x for i in range(9) for x in (f"@r{i}", "ACGT"[: i % 5], "+", "@II+"[: i % 5])]
    text = ending.join(lines) + ending * 2
    groups = list(fastq._line_groups(io.BytesIO(text.encode())))
    assert [x.decode() for g in groups for x in g] == lines and all(len(g) % 4 == 0 for g in groups)


@pytest.mark.parametrize("text", ["@a\nAC\n+\nII\n@b\nA\n", "@a\nAC\n+\nII\nb\nA\n+\nI\n"])
def test_broken_fastq_fails(spark, tmp_path, text):
    (tmp_path / "c.fq").write_text(text)
    with pytest.raises(Exception, match="record"):
        sources.read_fastq(spark, str(tmp_path)).collect()


def fasta_chunks(contigs, width, overlap):
    return sorted((n, i + 1, s[i : i + width + overlap]) for n, s in contigs.items() for i in range(0, len(s), width))


@pytest.mark.parametrize("split", ["128m", "64b", "23b"])
@pytest.mark.parametrize("width,overlap", [(16, 0), (7, 3), (100, 5), (3, 9)])
def test_fasta_in_any_split(spark, tmp_path, split, width, overlap):
    contigs = {"c1": "ACGT" * 33 + "N", "c2": "T", "c3": "GATTACA" * 20}
    text = ""
    for i, (name, seq) in enumerate(contigs.items()):
        line = 10 + i
        text += f">{name} about it\n" + "".join(seq[j : j + line] + "\n" for j in range(0, len(seq), line)) + "\n" * (i == 1)
    (tmp_path / "g.fa").write_text(text + ">empty\n")
    (tmp_path / "h.fa").write_text(">other\r\nAC\r\nGT\r\n")
    contigs["other"] = "ACGT"
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = rows(sources.read_fasta(spark, str(tmp_path), width, overlap))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == fasta_chunks(contigs, width, overlap)


def lines_in_order(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_vcf_sinks(spark, frame, tmp_path):
    data = [("chrM", 1), ("chrX", 5), ("chr10", 2), ("chr2", 30), ("chr2", 4), ("chrY", 1), ("chr1", 9)]
    df = frame([(c, p, f"{c}\t{p}\t50", 1 + i % 2) for i, (c, p) in enumerate(data)], "contig string, pos int, line string, region int")
    order = [("chr1", 9), ("chr2", 4), ("chr2", 30), ("chr10", 2), ("chrX", 5), ("chrY", 1), ("chrM", 1)]
    sources.write_vcf(df, str(tmp_path / "all"))
    assert lines_in_order(tmp_path / "all") == [f"{c}\t{p}\t50" for c, p in order]
    sources.write_vcf(df, str(tmp_path / "split"), by_region=True)
    odd = [o for o in order if data.index(o) % 2 == 0]
    assert lines_in_order(tmp_path / "split" / "region=1") == [f"{c}\t{p}\t50" for c, p in odd]
    with pytest.raises(Exception, match="no sort key for contig chrM"):
        sources.write_vcf(df, str(tmp_path / "strict"), strict=True)
    with pytest.raises(Exception, match="already exists"):
        sources.write_vcf(df, str(tmp_path / "all"))


def test_interval_and_alignment_sinks(spark, frame, tmp_path):
    covered = frame([("chr1", 1, 300), ("chr2", 5, 6)], "contig string, s int, e int")
    sources.write_bed(covered, str(tmp_path / "bed"))
    back = sources.read_bed(spark, str(tmp_path / "bed"))
    assert rows(back) == [("chr1", 0, 300, None), ("chr2", 4, 6, None)]
    sources.write_region_strings(covered, str(tmp_path / "regions"))
    assert sorted(lines_in_order(tmp_path / "regions")) == ["chr1:1-300", "chr2:5-6"]

    reads = spark.range(3000).select(
        (F.col("id") % 5).cast("int").alias("ref_idx"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.abs(F.hash("id")) % 99).alias("pos"),
        F.concat(F.lit("r"), "id").alias("qname"),
        F.lit(0).alias("flag"),
    )
    sources.write_alignments(reads, str(tmp_path / "sorted"))
    keys = []
    for part in sorted((tmp_path / "sorted").glob("part-*")):
        keys += [(r.ref_idx, r.pos, r.qname) for r in spark.read.parquet(str(part)).collect()]
    assert keys == sorted(keys) and len(keys) == 3000


def test_fasta_line_of_any_length(spark, tmp_path):
    rnd = random.Random(1)
    text = "".join(rnd.choices("ACGT", k=3_000_000))
    (tmp_path / "x.fa").write_text(f">a\n{text}\n>b\nAC\n")
    got = {r.chunk_start: r.bases for r in sources.read_fasta(spark, str(tmp_path / "x.fa"), 1000, 10).where("contig = 'a'").collect()}
    assert got == {i + 1: text[i : i + 1010] for i in range(0, len(text), 1000)}


def test_fasta_shuffles_only_what_blocks_share(spark, tmp_path):
    rnd = random.Random(2)
    contigs = {f"c{i}": "".join(rnd.choices("ACGT", k=100_000 + i)) for i in range(5)}
    lines = [f">{name}\n" + "\n".join(seq[i : i + 60] for i in range(0, len(seq), 60)) for name, seq in contigs.items()]
    (tmp_path / "x.fa").write_text("\n".join(lines) + "\n>last")
    found = sources.read_fasta(spark, str(tmp_path / "x.fa"), 256, 16)
    # About 8,400 lines and 1,950 chunks, in 65 blocks.
    assert shuffled_rows(found) < 250 and rows(found) == fasta_chunks(contigs, 256, 16)
