import pytest
from pyspark.sql import functions as F

from readloom import functions as fn


def one(frame, schema, row, **columns):
    return frame([row], schema).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    "cigar,end",
    [
        ("100M", 199),
        ("10S90M", 189),
        ("50M2D48M", 199),
        ("40M3I57M", 196),
        ("60M20N40M", 219),
        ("5=1X4M", 109),
        ("3H2S5M1P5M", 109),
        ("*", 99),
    ],
)
def test_alignment_end(frame, cigar, end):
    assert one(frame, "pos int, cigar string", (100, cigar), e=fn.alignment_end("pos", "cigar")).e == end


@pytest.mark.parametrize(
    "cigar,forward,reverse",
    [("10S90M", 90, 189), ("3H7S80M5S2H", 90, 186), ("90M10S", 100, 199), ("50M", 100, 149)],
)
def test_five_prime(frame, cigar, forward, reverse):
    r = one(
        frame,
        "pos int, cigar string",
        (100, cigar),
        f=fn.five_prime("pos", "cigar", F.lit(False)),
        r=fn.five_prime("pos", "cigar", F.lit(True)),
    )
    assert (r.f, r.r) == (forward, reverse)


def test_aligned_blocks(frame):
    r = one(frame, "pos int, cigar string", (10, "2H3S4M1I5M2D6M3N1X1S"), b=fn.aligned_blocks("pos", "cigar"))
    assert [tuple(b) for b in r.b] == [(10, 3, 4), (14, 8, 5), (21, 13, 6), (30, 19, 1)]


def test_indels(frame):
    r = one(frame, "pos int, cigar string", (10, "3S4M1I5M2D6M"), b=fn.indels("pos", "cigar"))
    assert [tuple(b) for b in r.b] == [(14, "I"), (19, "D")]


@pytest.mark.parametrize(
    "cigar,room,expected",
    [
        ("100M", 60, "60M40S"),
        ("10S90M", 60, "10S60M30S"),
        ("50M2D48M", 51, "50M48S"),
        ("50M2D48M", 53, "50M2D1M47S"),
        ("40M3I57M", 40, "40M60S"),
        ("60M20N40M", 70, "60M40S"),
        ("2H90M5S3H", 10, "2H10M85S3H"),
    ],
)
def test_trim_to(frame, cigar, room, expected):
    assert one(frame, "room int, cigar string", (room, cigar), c=fn.trim_to("cigar", F.col("room"))).c == expected


@pytest.mark.parametrize(
    "name,key",
    [("chr1", 1), ("chr22", 22), ("chrX", 25), ("chrx", 25), ("chry", 26), ("chrM", None), ("chr1_gl000191_random", None)],
)
def test_contig_key(frame, name, key):
    assert one(frame, "c string", (name,), k=fn.contig_key("c")).k == key


def test_contig_key_strict(frame):
    with pytest.raises(Exception, match="no sort key for contig chrM"):
        one(frame, "c string", ("chrM",), k=fn.contig_key("c", strict=True))
    assert one(frame, "c string", ("chrX",), k=fn.contig_key("c", strict=True)).k == 25


@pytest.mark.parametrize("quals,encoding", [([60, 2], "SANGER"), ([3, 61], "ILLUMINA"), ([], None)])
def test_guess_encoding(frame, quals, encoding):
    assert one(frame, "q array<int>", (quals,), e=fn.guess_encoding("q")).e == encoding


def test_rebase_and_error(frame):
    r = one(frame, "q array<int>", ([31, 40, 30, 2],), n=fn.rebase("q"), e=fn.quality_error("q"))
    assert r.n == [0, 9, -1, -29]
    assert r.e == "quality below 0 when re-based: -1"
    assert one(frame, "q array<int>", ([31, 40],), e=fn.quality_error("q")).e is None


def test_phred_round_trip(frame):
    r = one(frame, "s string", ("!@~I",), q=fn.decode_phred("s"))
    assert r.q == [0, 31, 93, 40]
    assert one(frame, "q array<int>", ([0, 31, 93, 40],), s=fn.encode_phred("q")).s == "!@~I"
    assert one(frame, "s string", ("*",), q=fn.decode_phred("s")).q is None


@pytest.mark.parametrize("rounds", [(8, 4, 2), (1000, 3), (5,)])
def test_pieces_of_long_texts(frame, rounds):
    from readloom.functions import texts

    given = ["", "a", "\U0001f600é" * 40 + "x", "abcdefg" * 9, None]
    df = frame(list(enumerate(given)), "id int, t string")
    size = rounds[-1]
    blocks = [r.b for r in df.select(texts.blocks_of(F.col("t"), rounds).alias("b")).collect()]
    for text, got in zip(given[:4], blocks, strict=False):
        assert got == [text[i : i + size] for i in range(0, len(text), size)]
    for start, n in [(0, 1), (1, 5), (7, 0), (3, 40), (0, 200)]:
        cut = texts.piece(texts.blocks_of(F.col("t"), rounds), F.lit(start), F.lit(n), size).alias("p")
        assert [r.p for r in df.where("id < 4").select(cut).collect()] == [t[start : start + n] for t in given[:4]]


def test_running_max(frame):
    from readloom.functions import texts

    rows = [[], [3], [1, 5, 2, 7, 7, 1, 9, 0, 3, 4, 12]]
    df = frame([(x,) for x in rows], "x array<int>")
    got = [r.m for r in df.select(texts.running_max(F.col("x"), F.lit(2)).alias("m")).collect()]
    assert got == [[max([2, *x[:i]]) for i in range(len(x))] for x in rows]
