import math
import re
from collections import Counter
from urllib.parse import unquote, urlparse

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from readloom.llm import k2treap, oracle
from readloom.llm.queries import op12_k2_treap

from llm.helpers import same

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // length
            score = 0
            for t in wanted & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted((tuple(r) for r in k2treap.search(docs, items, **options).collect()), key=str)


@pytest.fixture
def small_shards(monkeypatch):
    build = k2treap.build
    monkeypatch.setattr(k2treap, "build", lambda docs: build(docs, size=20_000))


def test_search_is_brute_force(spark, small_shards):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(docs, items) == wanted
    # Several blocks of items, and merging in two steps, change nothing.
    assert found(docs.repartition(7), items, block_terms=50) == wanted


def test_query_is_the_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert same(op12_k2_treap(spark, SF), con.sql(oracle.ranked_search()))


def test_ties_and_odd_rows(spark, odd_documents, no_documents, small_shards):
    items = spark.createDataFrame(
        [(1, "the fox"), (2, "FOX, the!"), (3, None), (4, "unheard"), (5, "mail one two"), (None, "text"), (6, "x@y.zz"), (6, "dog"), (7, "")],
        "item_id long, text string",
    )
    ties = spark.createDataFrame([(i, "same fox words") for i in (90, 31, 32, 33, 34, 35, 36, 37, 38, 39, 30, 91, None)], "doc_id long, text string")
    docs = odd_documents.select("doc_id", "text").unionAll(ties)
    pairs = [tuple(r) for r in docs.collect()]
    assert found(docs, items) == brute(pairs, [tuple(r) for r in items.collect()])
    clashing = odd_documents.withColumnsRenamed({"fp": "terms", "key": "item_id", "shard": "ids"})
    assert found(clashing, items) == brute([(r["doc_id"], r["text"]) for r in clashing.collect()], [tuple(r) for r in items.collect()])
    assert found(no_documents, items) == [] and found(odd_documents, items.where("false")) == []


def test_treap_finds_the_largest_sums():
    rng = np.random.default_rng(3)
    for _ in range(20):
        grid = rng.integers(0, 50, (37, 300)) * (rng.random((37, 300)) < 0.3)
        rows, columns = np.nonzero(grid)
        if not len(rows):
            continue
        treap = k2treap.Treap.of(rows, columns, grid[rows, columns])
        asked = rng.choice(37, 6, replace=False)
        weights = rng.integers(1, 9, 6)
        sums = weights @ grid[asked]
        got = dict(zip(*(x.tolist() for x in treap.best(asked, weights, 5)), strict=True))
        limit = np.sort(sums)[-5]
        wanted = {c: int(s) for c, s in enumerate(sums) if s > 0 and s >= limit}
        assert wanted.items() <= got.items()
        assert all(sums[c] == s for c, s in got.items())


def test_a_row_group_holds_one_grid(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").coalesce(1)
    shards = k2treap.build(docs, size=20_000).shards
    groups = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in shards.inputFiles()]
    sizes = [m.row_group(g).num_rows for m in groups for g in range(m.num_row_groups)]
    assert len(sizes) == shards.count() > 10 and set(sizes) == {1}
    # Both arrays of a grid's cells are packed.
    assert all(len(r["masks"]) + len(r["peaks"]) < 3 * r["cells"] for r in shards.collect())
