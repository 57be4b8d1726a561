import numpy as np
import pytest

from readloom.llm import hnsw
from readloom.llm.queries import op2_small_world

SF = "/root/testdata"
SCHEMA = "vec_id long, embedding array<float>, label int, node string, part string, able string"


def brute(rows, threshold=0.98):
    """``{vec_id: (n_links, component_id)}``."""
    able = [i for i, (v, e, lab) in enumerate(rows) if v is not None and lab is not None and e and all(c is not None and np.isfinite(c) for c in e) and any(e)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in able}
    x = {i: v / np.sqrt(v @ v) for i, v in x.items()}
    for k, i in enumerate(able):
        for j in able[:k]:
            if rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (v, *_) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((rows[i][0], links[i], least.get(find(i))) for i in range(len(rows))), key=str)


def result(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_is_brute_force(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/{sf}/embeddings.parquet").collect()]
    got = op2_small_world(spark, f"{SF}/{sf}")
    assert result(got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.collect())


@pytest.mark.parametrize("shard", [40, 8192])
def test_groups_over_shards_and_odd_rows(frame, shard):
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for centre in rng.normal(size=(5, 16)):
        for _ in range(60):
            rows.append((n, [float(v) for v in centre + 0.035 * np.linalg.norm(centre) / 4 * rng.normal(size=16)], n % 2))
            n += 1
    rows += [(1000 + i, [1.0, 2.0] * 8, 0) for i in range(30)]
    rows += [(2000 + i, [float(v) for v in rng.normal(size=16)], 1) for i in range(100)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [float("inf")] + [1.0] * 15, 1), (3004, [None] + [1.0] * 15, 1)]
    rows += [(3005, [1.0, 2.0] * 8, None), (3006, [], 0), (3007, [1.0], 0), (3008, [2.0], 0), (None, [1.0, 2.0] * 8, 0), (1000, [1.0, 2.0] * 8, 0)]
    got = hnsw.near_duplicates(frame([(*r, "n", "p", "a") for r in rows], SCHEMA), shard=shard)
    assert result(got) == brute(rows)


def test_empty(frame):
    assert hnsw.near_duplicates(frame([], SCHEMA)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x)
    found, _ = graph.search(x[:200].astype(np.float32), 64)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :5]
    hits = [len(set(graph.order[f].tolist()) & set(b.tolist())) for f, b in zip(found, best, strict=True)]
    assert np.mean(hits) / 5 >= 0.85


def test_rare_links_between_shards_are_found(monkeypatch):
    monkeypatch.setattr(hnsw, "BEAM", 2)  # Too narrow, so the audit has to widen it.
    rng = np.random.default_rng(9)
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 1500, 256)))
    # No query that the audit draws has a link: every tenth other one is near a node.
    drawn = set(np.linspace(0, len(q) - 1, hnsw.AUDIT).astype(int).tolist())
    at = np.array([i for i in range(0, len(q), 10) if i not in drawn])
    q[at] = hnsw.planted(x[at], 0.981)
    u, v = hnsw.linked(x, np.arange(1500), q, np.arange(1500, 3000), 0.98)
    assert len(u) >= 0.985 * len(at)
