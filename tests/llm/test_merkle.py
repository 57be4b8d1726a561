import zlib
from hashlib import sha256

import duckdb
from pyspark.sql import functions as F

from readloom.llm import merkle, oracle
from readloom.llm.queries import op13_merkle_versions

from llm.helpers import same

SF = "/root/testdata/sf0.001"


def h(*parts):
    return sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in values))


def tree(nodes):
    """Root, and for each node its siblings and the places of its ancestors."""
    paths = [([], [i]) for i in range(len(nodes))]
    while len(nodes) > 1:
        for siblings, places in paths:
            first = places[-1] // 16 * 16
            siblings.append((nodes[first : places[-1]], nodes[places[-1] + 1 : first + 16]))
            places.append(places[-1] // 16)
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    trees = [tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names]
    root, upper = tree([t[0] for t in trees])
    out = []
    for k, name in enumerate(names):
        subroot, paths = trees[k]
        for (_, _, own, r), (siblings, places) in zip(sorted(sources[name], key=lambda x: x[:3]), paths, strict=True):
            whole = siblings + upper[k][0]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            at = leaf([*r[:4], r[4] and r[4].translate(lower)]) if tampered else own
            copies = [at]
            for before, after in whole:
                copies.append(h(*before, copies[-1], *after))
            levels = places + upper[k][1][1:]
            version = [(i, p, d) for i, (p, d) in enumerate(zip(levels, copies, strict=True))] if tampered else None
            proof = h(*(x for before, after in whole for x in (*before, *after)))
            out.append((r[0], own, subroot, root, proof, copies[-1], copies[-1] == root, version))
    return sorted(out, key=str)


def found(df):
    rows = merkle.manifest(df).collect()
    return sorted(((*r[:7], r[7] and [tuple(x) for x in r[7]]) for r in rows), key=str)


def test_manifest_is_brute_force_over_several_tiers(spark):
    # 5,000 rows of one source are 20 blocks, and so two passes; 300 sources are two blocks of sources.
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 5000, F.lit("hot")).when(F.col("id") < 5010, F.lit(None)).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 300).cast("string"))
        ).alias("source"),
        F.lit("en").alias("lang"),
        (F.col("id") % 7).alias("n_chars"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("Ää Text "), F.col("id").cast("string"))).alias("text"),
    )
    assert found(docs) == brute([tuple(r) for r in docs.collect()])


def test_odd_rows(odd_documents, no_documents):
    fields = odd_documents.select(*merkle.FIELDS)
    # Columns of other names are not looked at, whatever they are called.
    clashing = odd_documents.withColumns({c: F.lit("x") for c in ("leaf", "tree", "block", "place", "digest", "root", "changed")})
    assert found(clashing) == brute([tuple(r) for r in fields.collect()])
    one = fields.where("doc_id = 4")
    assert found(one) == brute([tuple(r) for r in one.collect()])
    got = found(one)[0]
    assert got[1] == got[2] == got[3] and got[4] == sha256(b"").hexdigest()
    assert found(no_documents) == []


def test_every_change_is_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = merkle.manifest(docs, F.lit(True)).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        assert r["verified"] == (not any("A" <= c <= "Z" for c in r["text"] or ""))
        assert r["version"][-1]["digest"] == r["folded_root"]


def test_query_is_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert same(op13_merkle_versions(spark, SF), con.sql(oracle.merkle()))
