"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from textmill.llm import merkle
from textmill.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string, _row int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = [None if v is None else str(v) for v in row[:5]]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def climb(nodes):
    """Root of the nodes and the siblings of each, as (left, right) per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            run = i - i % 3
            p.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])))
        at = [i // 3 for i in at]
        nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain(rows, changed=lambda r: r):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(changed(r))))
    names = sorted(trees, key=lambda s: b"" if s is None else b"." + s.encode())
    grown = []
    for name in names:
        trees[name].sort()
        grown.append(climb([t[2] for t in trees[name]]))
    root, above = climb([g[0] for g in grown])
    out = []
    for name, (subroot, paths), rest in zip(names, grown, above):
        for (known, doc_id, own, tampered), path in zip(trees[name], paths):
            path, node = path + rest, tampered
            for left, right in path:
                node = digest(left, node, right)
            proof = digest(*[p for step in path for p in step])
            out.append((doc_id if known else None, own, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(n, sources=3):
    return [(i, f"s{i * i % sources}", "en", i % 7, f"text {i}\nmore") for i in range(n)]


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (1, None, "", 0, ""), (2, "", "en", 5, "é\n漢\U0001f600"),
    (3, "é", "x", 1, "\n"), (3, "é", "x", 1, "\n"), (3, "é", "x", 1, "y"), (4, "z", "x", None, "long \n" * 100_000), (-5, "z", "x", 1, " "),
]


@pytest.mark.parametrize("rows", [ODD, rows_of(1), rows_of(3, 1), rows_of(27, 1), rows_of(28, 1), rows_of(900), rows_of(120, 61)])
def test_proofs_against_a_plain_tree(spark, rows):
    # Names the operator uses for its own columns.
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.regexp_replace("text", "\n", ""))

    def changed(r):
        even = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        return (*r[:4], r[4].replace("\n", "")) if even else r

    got = merkle.tampered_proofs(df, cut)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, changed)


def test_three_checkpoints_and_single_proofs(spark):
    rows = rows_of(800, 1)
    manifest = merkle.build_manifest(spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA))
    assert len(manifest.sources) == 3
    wanted = spark.createDataFrame([(0,), (799,), (799,), (5000,)], "doc_id long")
    proofs = merkle.extract_proofs(manifest, wanted)
    got = {r["id"]: (r["leaf"], r["proof"]) for r in proofs.withColumn("proof", merkle.proof_digest(F.col("path"))).collect()}
    whole = {r[0]: (r[1], r[4]) for r in plain(rows)}
    assert got == {i: whole[i] for i in (0, 799)}
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.tampered_proofs(empty, F.lit("x")).count() == 0
    assert merkle.build_manifest(empty).root.count() == 0


def test_tampering_is_found(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op11_merkle"](spark, sf).collect():
        assert r["verified"] == ("\n" not in docs[r["doc_id"]] or zlib.crc32(str(r["doc_id"]).encode()) % 2 == 1)
