import itertools
import random
import re

import pyarrow as pa
import pytest

from basketry.llm import minhash, queries

from .helpers import BODY, EDGE_TEXTS, MIDDLE, SMALL, edge_documents, empty_documents, rows


def shingled(text, size):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, size, num=80, den=100):
    """(key, n, component) by comparing all pairs of different sets that share a shingle."""
    sets = [(k, shingled(t, size)) for k, t in docs]
    parent = {k: k for k, _ in sets if k is not None}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    def link(a, b):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)

    groups = {}
    for k, s in sets:
        if s and k is not None:
            groups.setdefault(s, []).append(k)
    for ks in groups.values():
        for k in ks[1:]:
            link(ks[0], k)
    index = {}
    for s in groups:
        for g in s:
            index.setdefault(g, []).append(s)
    done = set()
    for lists in index.values():
        for a, b in itertools.combinations(lists, 2):
            if (id(a), id(b)) not in done:
                done.add((id(a), id(b)))
                if den * len(a & b) >= num * len(a | b):
                    link(groups[a][0], groups[b][0])
    return sorted(((k, len(s), top(k) if k is not None else None, k is None or top(k) == k) for k, s in sets), key=str)


def test_shingles_are_those_of_the_words():
    texts = [*EDGE_TEXTS, "A b\nA B a b a b"]
    for size in (1, 4, 5):
        assert [len(s) for s in minhash.shingles(pa.array(texts, pa.string()), size)] == [len(shingled(t, size)) for t in texts]
    a, b = minhash.shingles(pa.array([BODY, BODY.upper()], pa.string()), 4)
    assert a.tolist() == b.tolist()


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_components_of_given_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = rows(queries.op7_minhash(spark, folder))
    assert sorted(got, key=str) == brute(rows(docs), 4)


def test_chains_copies_and_shared_passages(spark):
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    base = [random.choice(vocabulary) for _ in range(120)]
    said, text = [], list(base)
    for k in range(60):  # a chain: each is near the one before, the ends are not
        said.append(" ".join(text))
        text = list(text)
        text[random.randrange(120)] = f"c{k}"
    for k in range(80):  # copies and near copies of one text
        near = list(base)
        near[k % 120] = f"n{k % 7}"
        said.append(" ".join(near))
    passage = " ".join(random.choice(vocabulary) for _ in range(60))
    said += [passage + " " + " ".join(random.choice(vocabulary) for _ in range(40)) for _ in range(100)]  # alike by half, not linked
    said += ["a b c d e f g h i j", "a b c d e f g h i j", "a b c d e f g h i j k", "short", "short", "SHORT", ""]
    rows_in = list(enumerate(said))
    random.shuffle(rows_in)
    docs = spark.createDataFrame(rows_in, "doc_id long, text string")
    assert sorted(rows(minhash.near_duplicates(docs, 4)), key=str) == brute(rows_in, 4)


def test_edge_cases(spark):
    docs = edge_documents(spark)
    got = rows(minhash.near_duplicates(docs, 4))
    assert sorted(got, key=str) == brute(rows(docs.select("doc_id", "text")), 4)
    kept = minhash.keep_one(docs, 4)
    assert kept.columns == docs.columns
    keys = [r.doc_id for r in kept.collect()]
    assert keys.count(None) == 2 and len(keys) == len(set(keys)) + 1


def test_shared_keys_with_different_texts(spark):
    """No link is lost and no text dropped where rows share a key but not their text."""
    words = [f"w{k}" for k in range(100)]
    a, b = " ".join(words), " ".join(f"v{k}" for k in range(100))
    near_a, near_b = a.replace("w50", "x"), b.replace("v50", "x")
    for said in ([(5, a), (5, b), (9, near_b)], [(5, a), (5, b), (3, near_a), (3, None), (9, near_b), (9, near_b), (7, "alone"), (None, b)],
                 [(5, a), (5, b), (9, near_b), (9, near_a)], [(4, None), (4, ""), (4, a)]):
        docs = spark.createDataFrame(said, "doc_id long, text string")
        assert sorted(rows(minhash.near_duplicates(docs, 4)), key=str) == brute(said, 4)
    docs = spark.createDataFrame([(5, a, 1), (5, b, 2), (9, near_b, 3), (5, a, 4), (6, "alone", 5), (6, "alone", 6), (3, near_a, 7), (None, b, 8)],
                                 "doc_id long, text string, key int")
    kept = {(r.doc_id, r.text, r.key) for r in minhash.keep_one(docs, 4).collect()}
    assert {t for _, t, _ in kept if t} & {a, near_a} and {t for k, t, _ in kept if k is not None} & {b, near_b}
    assert len(kept) == 4 and (6, "alone", 5) in kept and (None, b, 8) in kept


def test_empty_tables(spark):
    assert rows(minhash.near_duplicates(empty_documents(spark), 4)) == [] and rows(minhash.keep_one(empty_documents(spark), 4)) == []


def test_long_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert sorted(rows(minhash.near_duplicates(docs, 4)), key=str) == brute(rows(docs), 4)
