import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from basketry.llm import common, merkle_manifest, queries

from .helpers import EDGE_TEXTS, SMALL, edge_documents, empty_documents, rows

COLUMNS = queries.LEAF_COLUMNS
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """(root, path of each leaf), level by level."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            begin = i // 16 * 16
            paths[k].append(("".join(nodes[begin:i]), "".join(nodes[i + 1:begin + 16])))
            at[k] = i // 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0] if nodes else None, paths


def brute(docs):
    groups = {}
    for d in docs:
        values = [d[c] for c in COLUMNS]
        other = values[:4] + [None if values[4] is None else values[4].translate(LOWER)]
        tampered = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0
        groups.setdefault(d["source"], []).append((d["doc_id"] is not None, d["doc_id"] or 0, leaf(values), leaf(other) if tampered else None))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in groups[s]]) for s in names}
    root, over = tree([trees[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for x, path in zip(groups[s], trees[s][1], strict=True):
            path = path + over[k]
            folded = x[3] or x[2]
            for left, right in path:
                folded = h(left, folded, right)
            out.append((x[1] if x[0] else None, x[2], trees[s][0], root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=str)


def checked(docs):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle_manifest.check(docs, "source", "doc_id", COLUMNS, {"text": lower}, common.crc_mod(F.col("doc_id"), 5) == 0)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = rows(queries.op11_merkle_manifest(spark, SMALL))
    assert sorted(got, key=str) == brute(docs.collect()) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("depth", [1, 3])
def test_edge_cases_and_many_tiers(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle_manifest, "DEPTH", depth)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16 ** depth)
    for docs in (edge_documents(spark), sized(spark)):
        assert sorted(rows(checked(docs)), key=str) == brute(docs.collect())
    assert rows(checked(empty_documents(spark))) == []


def sized(spark):
    """Groups of 1, 15, 16, 17, 256, 257 and 700 rows, and 40 groups; copies of one row are a group of 300."""
    sizes = {None: 1, "": 15, "a": 16, "aé": 17, "aZ": 256, "b": 257, "c": 700} | {f"s{k}": 2 for k in range(33)}
    out = [(1000 * k + i, EDGE_TEXTS[6 + i % 3], None, s, i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    out += [(5, "Same", "en", "d", 4)] * 300
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long")


def test_manifest_tells_which_group_changed(spark):
    docs = sized(spark)
    changed = docs.withColumn("text", F.when((F.col("source") == "b") & (F.col("doc_id") % 1000 == 100), "new").otherwise(F.col("text")))
    before, after = (merkle_manifest.manifest_of(d, "source", "doc_id", COLUMNS) for d in (docs, changed))
    of = lambda m: {(r.g, r.n): r.subroot for r in m.subroots().collect()}
    a, b = of(before), of(after)
    assert {k for k in a if a[k] != b[k]} == {("+b", 257)} and a.keys() == b.keys()
    assert before.root().first() != after.root().first()
