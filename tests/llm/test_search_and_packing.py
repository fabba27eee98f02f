import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketry.llm import ball_tree, bin_completion, common, queries

from .helpers import MIDDLE, edge_documents, empty_documents, rows

VECTORS = "vec_id long, embedding array<float>, label int, id string"


def brute(data, asked, k):
    usable = [(i, [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v]) for i, v, *_ in data
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in sorted(usable, reverse=True) if i in asked}.items():
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("shard", [40, 4096])
def test_top_k_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", shard)
    monkeypatch.setattr(ball_tree, "BLOCK_QUERIES", 3)
    random.seed(3)
    data = [(k, [random.gauss(0, 0.2) for _ in range(6)], 0, "clash") for k in range(400)]
    data += [(1000 + k, [0.5] * 6, 0, "") for k in range(300)]  # ties
    data += [(700, None, 0, ""), (702, [0.1, None] * 3, 0, ""), (704, [float("nan")] * 6, 0, ""), (706, [float("inf")] * 6, 0, ""),
             (720, [0.1, 0.2], 0, ""), (721, [0.3, 0.2], 0, ""), (740, [], 0, ""), (None, [0.5] * 6, 0, ""), (1000, [0.5] * 6, 0, "")]
    table = spark.createDataFrame(data, VECTORS)
    got = rows(ball_tree.top_k(table, table.where("vec_id % 20 = 0"), 5))
    assert sorted(got) == brute(data, {i for i, *_ in data if i is not None and i % 20 == 0}, 5)


def test_top_k_of_an_empty_table(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert rows(ball_tree.top_k(empty, empty, 5)) == []


def test_neither_blocks_nor_trees_are_joined_or_broadcast(spark, monkeypatch):
    """A task holds a team's trees and the blocks stream past them: what reaches the driver does not grow with blocks times shards."""
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 40)
    monkeypatch.setattr(ball_tree, "BLOCK_QUERIES", 3)
    random.seed(7)
    data = [(k, [random.gauss(0, 0.2) for _ in range(6)], 0, "") for k in range(200)]
    table = spark.createDataFrame(data, VECTORS)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = ball_tree.top_k(table, table.where("vec_id % 20 = 0"), 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Broadcast" not in plan and "vectors" not in "".join(x for x in plan.splitlines() if "Join" in x)
    assert sorted(rows(found)) == brute(data, {k for k in range(0, 200, 20)}, 5)


def test_queries_of_a_block_meet_a_leaf_together(monkeypatch):
    """A leaf is multiplied once for all queries that may still find something there."""
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(0, 200, (256, 8)))
    ids, v, balls = ball_tree.build(np.arange(256), v)
    asked, qs = np.arange(50), v[np.argsort(ids)][:50]
    calls = []
    monkeypatch.setattr(ball_tree, "all_dots", lambda a, b, f=ball_tree.all_dots: calls.append(1) or f(a, b))
    best = [[] for _ in asked]
    ball_tree.search(asked, qs, 5, ids, v, balls, np.full((50, len(balls["radius"])), np.inf), best)
    assert best == [sorted((-int(x @ q), int(i)) for i, x in zip(ids, v) if i != j)[:5] for j, q in zip(asked, qs)]
    assert len(calls) == 4


def test_a_team_is_bounded_and_has_a_shard(monkeypatch):
    assert ball_tree.teams_of(5, 64, 12) == 5
    assert ball_tree.teams_of(3662, 64, 12) == 3662 // 32 + 1
    assert ball_tree.teams_of(100, 100_000, 12) == 100
    assert ball_tree.teams_of(1, 0, 12) == 1


def least(sizes, capacity):
    """Fewest bins, by trying everything."""
    best = len(sizes)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity and bins[i] not in bins[:i]:
                put(k + 1, bins[:i] + [bins[i] + sizes[k]] + bins[i + 1:])
        put(k + 1, [*bins, sizes[k]])

    put(0, [])
    return best


def test_plans_are_valid_and_small_ones_optimal():
    random.seed(5)
    for _ in range(60):
        sizes = sorted((random.randint(1, 20) for _ in range(random.randint(1, 9))), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        plan = bin_completion.complete_bins(counts, 20)
        used = {}
        for times, items in plan:
            assert sum(items) <= 20
            for s in items:
                used[s] = used.get(s, 0) + times
        assert used == counts
        assert sum(t for t, _ in plan) == least(sizes, 20) >= bin_completion.least_bins(counts, 20)
    assert bin_completion.complete_bins({}, 20) == []
    large = {s: random.randint(1, 500) for s in range(1, 1025)}
    bins = sum(t for t, _ in bin_completion.complete_bins(large, 1024))
    assert bin_completion.least_bins(large, 1024) <= bins <= sum(t for t, _ in bin_completion.best_fit_decreasing(large, 1024))


def check_places(docs, places):
    t = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want = []
    for r in docs.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first, at, piece = len(ids) % 1024 or 1024, 0, 0
        while at < len(ids):
            n = first if piece == 0 else 1024
            want.append((r.doc_id, piece, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at, piece = at + n, piece + 1
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted((tuple(p)[:5] for p in places), key=order) == sorted(want, key=order)
    by = {}
    for p in places:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(by) >= -(-sum(p.length for p in places) // 1024)
    return len(by)


def test_packing_of_edge_texts_and_middle_table(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    for docs in (edge_documents(spark), spark.read.parquet(f"{MIDDLE}/documents.parquet")):
        places, pieces = bin_completion.pack_documents(docs, path)
        found = places.collect()
        counts = {}
        for p in found:
            counts[p.length] = counts.get(p.length, 0) + 1
        assert check_places(docs, found) == sum(t for t, _ in bin_completion.complete_bins(counts, 1024))
        assert pieces.where("length != length(ids) / 2").count() == 0  # the real output: ids of every piece
    assert rows(bin_completion.pack_documents(empty_documents(spark), path)[0]) == []


def test_long_fillings_do_not_overflow():
    for capacity in (4096, 8192):
        counts = {3: 9000, 1: 500, 700: 9}
        plan = bin_completion.complete_bins(counts, capacity)
        used = {}
        for n, items in plan:
            assert sum(items) <= capacity
            for i in items:
                used[i] = used.get(i, 0) + n
        assert used == counts
