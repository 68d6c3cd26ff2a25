import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from skytally.llm import merkle
from skytally.llm.oracles import ORACLES
from skytally.llm.queries import op13_merkle_manifest
from tests.llm.conftest import agrees_with_sql

SCHEMA = "text string, doc_id long, n_chars long, lang string, source string, digest string, tree string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in merkle.DOCUMENT)))


def climb(nodes):
    """(root, siblings of every node level by level, as (left, right)) of a list of digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for k, p in enumerate(at):
            paths[k].append((runs[p // 8][:p % 8], runs[p // 8][p % 8 + 1:]))
        at = [p // 8 for p in at]
        nodes = [sha(*r) for r in runs]
    return nodes[0], paths


def plain(rows):
    """What the query must give, by building the trees in memory."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        own = sorted(by_lang[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    if not trees:
        return []
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            claimed = r
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                claimed = r | {"text": r["text"].translate({c: c + 32 for c in range(65, 91)})}
            fold = leaf(claimed)
            for left, right in path + top:
                fold = sha(*left, fold, *right)
            proof = sha(*(x for left, right in path + top for x in left + right))
            out.append((r["doc_id"], leaf(r), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([tuple(r.get(c, "x") for c in ("text", "doc_id", "n_chars", "lang", "source", "digest", "tree"))
                                  for r in rows], SCHEMA)


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def document(i, lang, text="Some Text"):
    return {"doc_id": i, "lang": lang, "text": text, "n_chars": None if text is None else len(text), "source": None if i == 3 else "s"}


def test_query_agrees_with_sql(spark, tables):
    agrees_with_sql(op13_merkle_manifest, ORACLES["op13_merkle_manifest"], spark, tables)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "de": 1}, {"en": 9, None: 2}, {"en": 70, "de": 8, "": 17, None: 1, "é": 64, "zz": 3},
                                   {f"l{i}": 1 + i % 3 for i in range(11)}])
def test_trees_of_all_heights(spark, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append(document(i * 37 % 1009, lang, None if i % 13 == 0 else "" if i % 17 == 0 else f"Text {i} É"))
    got = rows_of(merkle.verify_documents(table(spark, rows).repartition(5), tampered()))
    assert got == plain(rows)
    assert len({r[3] for r in got}) == 1


def test_edges(spark):
    rows = [document(3, None, None), document(4, "en", "x"), document(4, "en", "x"), document(4, "en", "y"), document(None, "en", "Z"),
            document(None, None, ""), document(5, "de", "Long É " * 200_000), document(4, "en", "x")]
    df = table(spark, rows)
    assert rows_of(merkle.verify_documents(df, tampered())) == plain(rows)
    assert all(r[-1] for r in merkle.verify_documents(df).collect())
    assert merkle.verify_documents(df.limit(0), tampered()).count() == 0


def test_a_single_request_descends_alone(spark):
    rows = [document(i, "en" if i % 3 else "de", f"text {i}") for i in range(200)]
    leaves = table(spark, rows).select(merkle.tree_name(F.col("lang")).alias("tree"), "doc_id",
                                       merkle.leaf_digest(*map(F.col, merkle.DOCUMENT)).alias("digest"))
    manifest = merkle.build_manifest(leaves, ["doc_id"])
    wanted = {r[0]: r for r in plain(rows)}
    asked = manifest.rows.leaves.where("doc_id in (7, 150)").select("tree", "rank", "doc_id")
    nowhere = spark.createDataFrame([("=en", 1000, -1), ("=fr", 0, -2)], "tree string, rank long, doc_id long")
    found = merkle.prove(manifest, asked.union(nowhere)).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("segments")), merkle.folded(F.col("leaf"), F.col("segments"))).collect()
    assert {r[0] for r in found} == {7, 150}
    for r in found:
        assert tuple(r)[1:5] == wanted[r[0]][1:5] and r[5] == r[3]


def test_equal_nodes_share_a_record(spark):
    rows = [document(1, "en", "same")] * 128
    leaves = table(spark, rows).select(F.lit("=en").alias("tree"), "doc_id",
                                       merkle.leaf_digest(*map(F.col, merkle.DOCUMENT)).alias("digest"))
    manifest = merkle.build_manifest(leaves, ["doc_id"])
    assert manifest.rows.records.count() == 3
    assert rows_of(merkle.verify_documents(table(spark, rows), tampered())) == plain(rows)
