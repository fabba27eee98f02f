"""Exact top-k by integer inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by a hash of their id; a shard of at most ``SHARD_ROWS``
becomes one row with its vectors, reordered along its tree, and the tree's balls.
Query blocks meet the shards in two rounds.  In the first a block searches one shard;
the scores it has then (each query's current kth) go with the block to all other
shards, where a node is opened only for queries whose bound ``q.c + |q| r`` can still reach
them, best bound first; the queries of a block go down together.

Shards are dealt to teams of at most ``TEAM_BYTES`` (or one shard).  A task holds a team's
trees and the blocks stream past them, so a tree is sent once a round and a block once for each
team; no block, tree or pair of them is broadcast or joined, and the driver gets counts only.

Defined cases: vectors that are null, or hold null or non-finite components, take no
part; vectors are compared with those of the same length only; rows with the query's
id are its own; of repeated query ids the smallest vector asks; repeated candidate
rows count each; ties go to the smaller id; scores beyond a long are held at its
limits; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

SHARD_ROWS = 4096
BLOCK_QUERIES = 128
LEAF_ROWS = 64
SCALE = 1024
#: Vectors that a task holds at once.
TEAM_BYTES = 64 << 20

PACKED = "bucket int, dim int, ids binary, vectors binary, first binary, last binary, least_id binary, radius binary, center binary"
EXACT = 2.0**52


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors with finite components only, as floor(SCALE * x) in doubles."""
    return (vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.forall("v", lambda x: x.isNotNull()))
            .where(F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
            .select("id", F.transform("v", lambda x: x.cast("double") * F.lit(float(SCALE))).alias("v")))


def build(ids: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Reordered ids and vectors, and the balls: rows [first, last), center, radius, least id; children are 2i+1 and 2i+2 of a full tree.

    Node i is a leaf if ``first`` and ``last`` of node 2i+1 are both 0.
    """
    order = np.arange(len(ids))
    nodes: dict[int, tuple[int, int, np.ndarray, float, int]] = {}
    todo = [(0, 0, len(ids))]
    while todo:
        i, a, b = todo.pop()
        rows = order[a:b]
        x = v[rows]
        center = x.mean(axis=0)
        far = np.sqrt(((x - center) ** 2).sum(axis=1))
        radius = float(far.max())
        nodes[i] = (a, b, center, radius, int(ids[rows].min()))
        if b - a > LEAF_ROWS and radius > 0:
            one = x[far.argmax()]
            other = x[((x - one) ** 2).sum(axis=1).argmax()]
            half = (b - a) // 2
            order[a:b] = rows[np.argpartition(x @ (other - one), half)]
            todo += [(2 * i + 1, a, a + half), (2 * i + 2, a + half, b)]
    size = 2 * max(nodes) + 3
    balls = {"first": np.zeros(size, np.int64), "last": np.zeros(size, np.int64), "least_id": np.zeros(size, np.int64),
             "radius": np.zeros(size), "center": np.zeros((size, v.shape[1]))}
    for i, (a, b, center, radius, least) in nodes.items():
        balls["first"][i], balls["last"][i], balls["center"][i], balls["radius"][i], balls["least_id"][i] = a, b, center, radius, least
    return ids[order], v[order], balls


def dots(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products as long integers, held at the limits of a long."""
    if v.shape[1] * np.abs(v).max(initial=0) * np.abs(q).max(initial=0) < EXACT:
        return (v @ q).astype(np.int64)
    whole = [int(x) for x in q.tolist()]
    top = 2**63 - 1
    return np.array([max(-top - 1, min(top, sum(int(x) * y for x, y in zip(row, whole, strict=True)))) for row in v.tolist()], np.int64)


def all_dots(v: np.ndarray, qs: np.ndarray) -> np.ndarray:
    """``dots`` of each query, a row each."""
    if v.shape[1] * np.abs(v).max(initial=0) * np.abs(qs).max(initial=0) < EXACT:
        return (qs @ v.T).astype(np.int64)
    return np.array([dots(v, q) for q in qs], np.int64).reshape(len(qs), len(v))


def search(asked: np.ndarray, qs: np.ndarray, k: int, ids: np.ndarray, v: np.ndarray, balls: dict[str, np.ndarray], bounds: np.ndarray,
           best: list[list[tuple[int, int]]]) -> None:
    """Bring ``best``, the k best (-score, id) of each query, sorted, up to date with the shard; ``bounds``: of each query and node.

    The queries of a block go down the tree together, the child with the best bound first; only those whose bound still reaches
    their kth score go on, and a leaf is multiplied with all of them at once.
    """
    first, last, least = balls["first"], balls["last"], balls["least_id"]
    kth = np.array([-b[-1][0] if len(b) == k else -2**63 for b in best], np.int64)
    todo = [(0, np.arange(len(asked)))]
    while todo:
        i, who = todo.pop()
        full = np.array([len(best[j]) == k for j in who], bool)
        who = who[~full | (bounds[who, i] >= kth[who])]
        if not len(who):
            continue
        left = 2 * i + 1
        if left < len(last) and last[left]:
            children = sorted((left, left + 1), key=lambda c: bounds[who, c].max())
            todo += [(c, who) for c in children]
            continue
        a, b = first[i], last[i]
        if balls["radius"][i] == 0:
            alike = all_dots(v[a:a + 1], qs[who])[:, 0].tolist()
            who = who[np.array([len(best[j]) < k or (-s, int(least[i])) <= best[j][-1] for j, s in zip(who, alike, strict=True)], bool)]
            if not len(who):
                continue
        these = ids[a:b]
        scores = all_dots(v[a:b], qs[who])
        hit = (scores >= kth[who][:, None]) & (these[None, :] != asked[who][:, None])
        for r in np.flatnonzero(hit.any(axis=1)).tolist():
            j, s, x = who[r], scores[r][hit[r]], these[hit[r]]
            top = np.lexsort((x, -s))[:k]
            best[j] = sorted(best[j] + [(-int(s[t]), int(x[t])) for t in top])[:k]
            if len(best[j]) == k:
                kth[j] = -best[j][-1][0]


def pack(rows: DataFrame, bucket, most: int, parts: int, tree: bool) -> DataFrame:
    """Rows (id, v) put together by bucket and dimension into single rows of at most ``most`` vectors."""
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PACKED.split(", ")]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
        now, ids, vectors = None, [], []

        def closed() -> pa.RecordBatch:
            x, v = np.array(ids, np.int64), np.floor(np.array(vectors, np.float64).reshape(len(ids), now[1]))
            parts = {n: np.zeros(0) for n in names[4:]}
            if tree:
                x, v, parts = build(x, v)
            row = [*now, x.tobytes(), v.tobytes(), *(parts[n].tobytes() for n in names[4:])]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for b, d, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (b, d) or len(ids) >= most:
                    if ids:
                        yield closed()
                    now, ids, vectors = (b, d), [], []
                ids.append(i)
                vectors.append(v)
        if ids:
            yield closed()

    return (rows.select(bucket.cast("int").alias("bucket"), F.size("v").alias("dim"), "id", "v")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "dim", "id").mapInArrow(together, PACKED))


def teams_of(shards: int, dim: int, parts: int) -> int:
    """Teams that the shards are dealt to: as many as there are tasks, more where a team would pass ``TEAM_BYTES``, at most one a shard."""
    most = max(1, TEAM_BYTES // (8 * SHARD_ROWS * max(1, dim)))
    return min(shards, max(parts, -(-shards // most)))


def tree_of(row: dict) -> dict:
    """The arrays of a packed shard."""
    ids = np.frombuffer(row["ids"], np.int64)
    radius = np.frombuffer(row["radius"])
    return {"bucket": row["bucket"], "dim": row["dim"], "ids": ids, "v": np.frombuffer(row["vectors"]).reshape(len(ids), row["dim"]),
            "balls": {n: np.frombuffer(row[n], np.int64) for n in ("first", "last", "least_id")} | {"radius": radius},
            "center": np.frombuffer(row["center"]).reshape(len(radius), row["dim"])}


def search_block(row: dict, trees: list[dict], k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score): what the trees add to the best k of each query of a block."""
    asked_ids = np.frombuffer(row["ids"], np.int64)
    qs = np.frombuffer(row["vectors"]).reshape(len(asked_ids), row["dim"])
    length = np.sqrt((qs**2).sum(axis=1))
    kth = {q: (s, i) for q, s, i in zip(*(row[n] or [] for n in ("h_query", "h_score", "h_id")), strict=True)}
    asked = asked_ids.tolist()
    held = [[(-kth[q][0], kth[q][1])] * k if q in kth else [] for q in asked]
    best = list(held)
    for t in trees:
        radius = t["balls"]["radius"]
        bounds = qs @ t["center"].T + length[:, None] * radius[None, :]
        bounds += 1e-9 * (length[:, None] * (np.sqrt((t["center"]**2).sum(axis=1)) + radius)[None, :]) + 1.0  # rounding
        search(asked_ids, qs, k, t["ids"], t["v"], t["balls"], bounds, best)
    new = [b[:b.index(h[0])] if h and h[0] in b else b for b, h in zip(best, held, strict=True)]
    return [(q, i, -s) for q, b in zip(asked, new, strict=True) for s, i in b]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products over all vectors."""
    spark = vectors.sparkSession
    ship(spark)
    points, asked = usable(vectors, key, vector), usable(queries, key, vector)
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    (n_points, dim), n_asked = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first(), asked.count()
    shards, blocks = max(1, -(-n_points // SHARD_ROWS)), max(1, -(-n_asked // BLOCK_QUERIES))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    teams = teams_of(shards, dim or 0, parts)
    trees = stored(pack(points, F.pmod(F.xxhash64("id"), F.lit(shards)), SHARD_ROWS, min(parts, shards), True), "ball-trees")
    packed = stored(pack(asked, F.pmod(F.xxhash64("id"), F.lit(blocks)), BLOCK_QUERIES, min(parts, blocks), False)
                    .select("bucket", "dim", "ids", "vectors").withColumnRenamed("bucket", "block"), "query-blocks")

    found = "query_id bigint, vec_id bigint, score bigint"
    kth_columns = ("h_query", "h_score", "h_id")
    team = F.floor(F.col("bucket") * F.lit(teams) / F.lit(shards)).cast("int")
    held = trees.withColumns({"team": team, "asks": F.lit(False)})

    def rounds(asking: DataFrame, at_home: bool) -> DataFrame:
        """What ``asking`` (team, bucket: its home shard, a block, the current kth) finds in its home shard, or in the others of the team."""
        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, here = None, []
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                    if row["team"] != now:
                        now, here = row["team"], []
                    if not row["asks"]:
                        here.append(tree_of(row))
                        continue
                    out = search_block(row, [t for t in here if t["dim"] == row["dim"] and (t["bucket"] == row["bucket"]) == at_home], k)
                    columns = list(zip(*out, strict=True)) or [[]] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        # a team's trees come before the blocks that ask it
        rows = held.unionByName(asking.withColumn("asks", F.lit(True)), allowMissingColumns=True)
        return rows.repartitionById(teams, "team").sortWithinPartitions("team", "asks").mapInArrow(searched, found)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    asking = packed.select("block", "dim", "ids", "vectors", home.alias("bucket"))
    nothing = [F.lit(None).cast("array<bigint>").alias(n) for n in kth_columns]
    first = stored(ranked(rounds(asking.select("dim", "ids", "vectors", "bucket", *nothing, team.alias("team")), True)), "first-shard")
    #: the current kth score and id of each query of a block, where it has k already
    kth = (first.where(F.col("rank") == k)
           .groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))  # a block's queries at most, unless ids collide
           .agg(*(F.collect_list(c).alias(n) for c, n in zip(("query_id", "score", "vec_id"), kth_columns, strict=True))))
    every = F.explode(F.sequence(F.lit(0), F.lit(teams - 1))).alias("team")
    rest = rounds(asking.join(kth.hint("merge"), "block", "left").select("dim", "ids", "vectors", "bucket", *kth_columns, every), False)
    return ranked(first.select("query_id", "vec_id", "score").unionByName(rest)).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
