import numpy as np
from pyspark.sql import functions as F

from readloom.llm import mih
from readloom.llm.queries import op9_multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, asks string, i string, rank string"


def brute(ids, x, queries, k=5):
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    out = {}
    for q in queries:
        score = x @ x[ids.index(q)]
        out[q] = [ids[j] for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-score[j], ids[j]))[:k]]
    return out


def recall(got, wanted):
    return np.mean([len(set(got.get(q, [])) & set(w)) / len(w) for q, w in wanted.items()])


def neighbours(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_query_recall(spark):
    for sf in ("sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}"
        rows = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").collect()
        ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
        wanted = brute(ids, x, [i for i in ids if i % 50 == 0])
        got = neighbours(op9_multi_index(spark, path))
        assert set(got) == set(wanted) and all(len(v) == 5 for v in got.values())
        assert recall(got, wanted) >= 0.95


def test_scores_are_cosines(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()}
    for r in op9_multi_index(spark, "/root/testdata/sf0.01").collect():
        a, b = rows[r["query_id"]], rows[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_odd_vectors(frame):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(60)]
    rows += [(100 + i, [1.0] * 8) for i in range(30)] + [(50, [1.0] * 8), (50, [1.0] * 8)]
    bad = [(200, None), (250, [0.0] * 8), (300, [float("nan")] * 8), (350, [float("inf")] + [1.0] * 7), (400, [None] + [1.0] * 7), (450, [1.0, 2.0]), (None, [1.0] * 8), (500, [])]
    df = frame([(*r, 1, "a", "i", "r") for r in rows + bad], SCHEMA)
    got = neighbours(mih.nearest(df, F.col("vec_id") % 50 == 0, block=16))
    assert set(got) == {0, 50, 100}
    assert got[100] == [50, 101, 102, 103, 104]
    assert mih.nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2
    assert mih.nearest(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert mih.nearest(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_equal_vectors_tie_over_all_blocks(frame):
    rng = np.random.default_rng(6)
    groups = [[float(v) for v in rng.normal(size=64)] for _ in range(4)]
    rows = [(int(i), groups[i % 4], 1, "a", "i", "r") for i in rng.permutation(400)]
    rows += [(1000 + i, [float(v) for v in rng.normal(size=64)], 1, "a", "i", "r") for i in range(100)]
    for block in (16, 64, 8192):
        got = neighbours(mih.nearest(frame(rows, SCHEMA), F.col("vec_id") % 50 == 0, block=block))
        for q in range(0, 400, 50):
            assert got[q] == [i for i in range(q % 4, 28, 4) if i != q][:5]
        scores = {r["score"] for r in mih.nearest(frame(rows, SCHEMA), F.col("vec_id") == 0, block=block).collect()}
        assert len(scores) == 1 and abs(scores.pop() - 1) < 1e-12


def test_every_length_answers(frame):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in rng.normal(size=16)]) for i in range(119)]
    rows += [(200 + i, [float(v) for v in rng.normal(size=8)]) for i in range(60)] + [(500, [1.0, 2.0, 3.0]), (501, [1.0, 2.0, 3.0])]
    for block in (32, 100, 8192):
        got = neighbours(mih.nearest(frame([(*r, 1, "a", "i", "r") for r in rows], SCHEMA), F.col("vec_id") % 50 == 0, block=block))
        assert set(got) == {0, 50, 100, 200, 250, 500} and got[500] == [501]
        for low, high in ((0, 119), (200, 260)):
            some = [r for r in rows if low <= r[0] < high]
            ids, x = [r[0] for r in some], np.array([r[1] for r in some])
            wanted = brute(ids, x, [i for i in ids if i % 50 == 0])
            assert recall({q: got[q] for q in wanted}, wanted) >= (1 if block == 8192 else 0.8)
