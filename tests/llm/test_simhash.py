import random
import re

import numpy as np
import pytest
import xxhash

from basketry.llm import queries, simhash

from .helpers import BODY, EDGE_TEXTS, MIDDLE, SMALL, edge_documents, empty_documents, rows


def plain(text, size=4):
    """The fingerprint, counted bit by bit."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def labelled(fps):
    """A component label of each fingerprint, all pairs compared."""
    fps = np.array(fps, np.uint64)
    label = list(range(len(fps)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1:
            a, b = top(i), top(int(j))
            label[max(a, b)] = min(a, b)
    return [top(k) for k in range(len(fps))]


def brute(docs):
    fps = [plain(t) for _, t in docs]
    label = labelled(fps)
    least = {}
    for (key, _), c in zip(docs, label, strict=True):
        least[c] = min((k for k in (least.get(c), key) if k is not None), default=None)
    return sorted([(key, f"{fp:016x}", least[c]) for (key, _), fp, c in zip(docs, fps, label, strict=True)], key=str)


def test_fingerprints_of_odd_texts():
    for t in [*EDGE_TEXTS, "A b\nA B a b a b", "a b c d", "a b c", "İ I i"]:
        assert simhash.fingerprint(t, 4) == plain(t)


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_given_tables(spark, folder):
    docs = rows(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    assert sorted(rows(queries.op12_simhash(spark, folder)), key=str) == brute(docs)


def test_edge_cases(spark):
    docs = edge_documents(spark)
    assert sorted(rows(simhash.near_duplicates(docs)), key=str) == brute(rows(docs.select("doc_id", "text")))
    assert rows(simhash.near_duplicates(empty_documents(spark))) == []


def test_covers_hold_in_any_four_positions():
    from itertools import combinations
    for width, n in ((2, 7), (3, 20), (4, 70)):
        sets = simhash.covers(width)
        assert len(sets) == n and all(any(set(c) <= set(four) for c in sets) for four in combinations(range(8), 4))


def test_shared_bytes_are_counted():
    random.seed(3)
    for _ in range(500):
        x = sum((random.choice([0, 1, 0x80, 0xFF, random.randrange(256)])) << (8 * p) for p in range(8))
        assert simhash.shared_bytes(np.array([x], np.uint64))[0] == sum((x >> 8 * p) & 0xFF == 0 for p in range(8))


@pytest.mark.parametrize("limit", [8, 64, 1024])
def test_components_of_dense_groups_and_chains(spark, monkeypatch, limit):
    """Groups around centres, chains of single bits, and links at exactly four and five bits, with short and long lists."""
    monkeypatch.setattr(simhash, "LIST", limit)
    random.seed(limit)
    fps = set()
    for _ in range(4):
        centre = random.getrandbits(64)
        for _ in range(90):
            fps.add(centre ^ sum(1 << b for b in random.sample(range(64), random.randrange(7))))
    x = random.getrandbits(64)
    for _ in range(40):
        x ^= sum(1 << b for b in random.sample(range(64), random.choice([4, 5])))
        fps.add(x)
    fps |= {random.getrandbits(64) for _ in range(300)} | {0, 0xF, (1 << 64) - 1, (1 << 64) - 16}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    got = {(a, b) for a, b in rows(simhash.links(nodes))}
    place = {x - (1 << 64) if x >> 63 else x: k for k, x in enumerate(fps)}
    label = list(range(len(fps)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in got:
        a, b = sorted((top(place[a]), top(place[b])))
        label[b] = a
    assert [top(k) for k in range(len(fps))] == labelled(fps)
    assert len(got) < 105 * len(fps)


def test_width_grows_with_the_nodes():
    assert [simhash.width_for(n) for n in (0, 200_000, 20_000_000, 10 ** 11)] == [2, 2, 3, 4]
