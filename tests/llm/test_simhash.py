import numpy as np
import pytest
import xxhash

from readloom.llm import simhash
from readloom.llm.queries import op10_simhash

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, bits=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, v in enumerate(ids):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    prints = [brute_fingerprint(t) for _, t in docs]
    wanted = {(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, brute_components([d for d, _ in docs], prints), strict=True)}
    assert {tuple(r) for r in op10_simhash(spark, SF).collect()} == wanted


def test_golay_keys_meet_at_one_bit():
    rng = np.random.default_rng(1)
    fp = rng.integers(-(2**63), 2**63 - 1, 300)
    assert len(np.unique(simhash.ERRORS)) == 2048
    own = simhash.own_keys(fp)
    for flips in range(4):
        other = fp.copy()
        for _ in range(flips):
            other ^= np.int64(1) << rng.integers(0, 63, len(fp))
        rows, keys = simhash.near_keys(other)
        found = set(zip(rows.tolist(), keys.tolist(), strict=True))
        assert all(any((i, k) in found for k in own[i].tolist()) for i in range(len(fp)))


@pytest.mark.parametrize("small", [0, 4, 1000])
def test_dense_and_sparse_groups(spark, frame, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.integers(-(2**63), 2**63 - 1, 6)
    fp = [int(c) for c in centre for _ in range(40)]
    for i in range(len(fp)):
        for b in rng.integers(0, 63, rng.integers(0, 3)).tolist():
            fp[i] ^= 1 << b
    fp += rng.integers(-(2**63), 2**63 - 1, 60).tolist()
    ids = list(range(len(fp)))
    got = simhash.groups(frame(list(zip(ids, fp, strict=True)), "doc_id long, fp long")).collect()
    named = {r["fp"]: r["component_id"] for r in got}
    assert [named[x] for x in fp] == brute_components(ids, [x & (2**64 - 1) for x in fp])


def test_odd_rows(odd_documents):
    got = [tuple(r) for r in simhash.near_duplicates(odd_documents).select("doc_id", "fp", "component_id").collect()]
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    prints = [brute_fingerprint(t) for _, t in docs]
    comps = brute_components([d for d, _ in docs], prints)
    wanted = [(d, int(np.uint64(p).view(np.int64)), c) for (d, _), p, c in zip(docs, prints, comps, strict=True)]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_deduplicated_keeps_one_of_each_group(odd_documents):
    kept = simhash.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=str) == [1, 10, 4, 5, 6, 7, 8, None]


def test_empty(no_documents):
    assert simhash.near_duplicates(no_documents).count() == 0
    assert simhash.deduplicated(no_documents).count() == 0


def test_wanted_keys_are_never_broadcast(spark, frame):
    rng = np.random.default_rng(4)
    prints = simhash.stage(frame([(x,) for x in rng.integers(-(2**63), 2**63 - 1, 2_000).tolist()], "fp long"), "prints")
    found = simhash.link_fingerprints(prints)
    plans, broadcast = [found._jdf.queryExecution().executedPlan()], []
    while plans:
        plan = plans.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif plan.getClass().getSimpleName() == "BroadcastExchangeExec":
            broadcast.append(plan.toString())
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    assert not any("MapInPandas" in b for b in broadcast)
