"""Merkle manifests against trees that are built whole in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from orelode.llm import merkle_manifest
from orelode.llm.queries import QUERIES


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves: list[str]) -> tuple[str, list[list]]:
    """The root, and for each leaf its siblings: (digest or None, whether on the left)."""
    paths, nodes, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            path.append((nodes[i ^ 1] if i ^ 1 < len(nodes) else None, i % 2 == 1))
        at = [i // 2 for i in at]
        nodes = [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def folded(leaf: str, path: list) -> str:
    for other, left in path:
        leaf = digest(leaf if other is None else other + leaf if left else leaf + other)
    return leaf


def leaf_of(row: tuple, more: int = 0) -> str:
    i, text, lang, source, n_chars = row
    n = None if n_chars is None else n_chars + more
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def expected(rows: list[tuple]) -> list[tuple]:
    """The query's rows for (doc_id, text, lang, source, n_chars) of different ids."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    own = {v: sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for v in langs}
    trees = {v: tree([leaf_of(r) for r in own[v]]) for v in langs}
    root, tops = tree([trees[v][0] for v in langs])
    out = []
    for v, top in zip(langs, tops, strict=True):
        for r, path in zip(own[v], trees[v][1], strict=True):
            whole = path + top
            more = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            claim = folded(leaf_of(r, more), whole)
            proof = digest("".join(h for h, _ in whole if h is not None))
            out.append((r[0], leaf_of(r), trees[v][0], root, proof, claim, claim == root))
    return out


def written(spark, folder, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tree string, hash string, carried int, at long"
    df = spark.createDataFrame([(*r, "t", "h", 1, 2) for r in rows], schema)
    df.repartition(5).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.mark.parametrize("stride", [1, 2, 6])
def test_query(spark, tmp_path, monkeypatch, stride):
    monkeypatch.setattr(merkle_manifest, "STRIDE", stride)
    lang = lambda i: [None, "en", "en", "en", "de", "\u00e9", "z"][i * i % 7] if i < 140 else "one"
    rows = [(i * 3, f"text {i}" * (i % 5), lang(i), None if i % 9 == 0 else "s", None if i % 11 == 0 else i) for i in range(141)]
    rows += [(None, "no id", "en", "s", 4), (1, None, None, None, None), (2, "", "en", "", 0)]
    out = QUERIES["op13_merkle_manifest"](spark, written(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(expected(rows), key=str)
    wrong = {r.doc_id for r in out if not r.verified}
    assert wrong == {r[0] for r in rows if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


def test_one_row_and_no_rows(spark, tmp_path):
    rows = [(7, "only", None, "s", 4)]
    (out,) = QUERIES["op13_merkle_manifest"](spark, written(spark, tmp_path / "one", rows)).collect()
    assert tuple(out) == expected(rows)[0] and out.leaf == out.subroot == out.root and out.proof_sha256 == digest("")
    assert QUERIES["op13_merkle_manifest"](spark, written(spark, tmp_path / "none", [])).collect() == []


def test_repeated_rows_and_proofs(spark, documents):
    rows = [(5, "same", "en")] * 70 + [(5, "other", "en"), (None, "x", "en"), (None, "x", "en"), (9, "de", "de")]
    df = documents(rows).selectExpr("doc_id", "lang", "sha2(text, 256) as leaf", "node", "text as tree")
    manifest = merkle_manifest.build(df, "lang", "doc_id")
    out = merkle_manifest.proofs(manifest).collect()
    order = sorted((r for r in rows if r[2] == "en"), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    subroot, paths = tree([digest(r[1]) for r in order])
    root = tree([digest("de"), subroot])[0]
    assert {r.root for r in out} == {root} and len(out) == len(rows)
    assert all(merkle_manifest.fold(r.leaf, [s.asDict() for s in r.siblings]) == root for r in out)
    found = sorted(([(s.hash, s.left) for s in r.siblings[:-1]] for r in out if r.tree == "en"), key=str)
    assert found == sorted(paths, key=str)


def test_changed_leaves_are_found(spark, documents):
    df = documents([(i, f"t{i}", "ab"[i % 2]) for i in range(300)]).selectExpr("doc_id", "lang", "sha2(text, 256) as leaf")
    claims = df.selectExpr("*", "case when doc_id = 17 then sha2('x', 256) when doc_id = 40 then null else leaf end as said")
    out = merkle_manifest.audit(merkle_manifest.build(claims, "lang", "doc_id"), "said").where("not coalesce(verified, false)")
    assert {r.carried.doc_id for r in out.collect()} == {17, 40}
