"""Near duplicates: one-permutation MinHash, optimal densification, banded buckets, star-shaped candidates.

1. Each whole text becomes its set of word shingles (64-bit hashes).  One hash per
   shingle fills ``BINS`` bins, each keeping its least value; an empty bin takes the
   value of the first full one along its own fixed probing order (optimal
   densification).  Equal sets are put together by a 128-bit digest first.
2. Runs of ``ROWS`` bins are bucket keys.  In a bucket only the pairs (hub, member)
   are candidates, the hub being the member of least hash everywhere, so that buckets
   of one group propose the same pairs and their number grows with the members.
3. Candidates are confirmed on the full sets; links join components by min-label rounds.
4. A star misses a link between two members that are both unlike its hub.  So members
   of a bucket that are still in different components after that are compared with
   each other, in blocks, by signature; pairs that may reach the threshold are
   confirmed on the full sets too, and the components joined again.

Every pair that shares a bucket and is not joined otherwise is thus tried.  A pair at
the threshold of 0.8 misses all 32 buckets with probability about 5e-8.

Defined cases: a null or empty text, or one without words, has the empty set and is
linked with nothing; fewer words than a shingle count as one shingle; rows that
share a key, but not their text, are nodes of their own when texts are compared, and linked with each other in
what ``near_duplicates`` returns (``keep_one`` does not link them); rows with a null key are linked with nothing and are
kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_keys
from .common import ship, stored
from .tokens import slices

BINS = 128
ROWS = 4
BANDS = BINS // ROWS
#: Share of equal bins under which a signature rules a pair out, by shingles of its smaller set: five or more
#: standard deviations under the threshold of 0.8 for as many full bins as such a set has.
LEAST_EQUAL = ((128, 0.6), (48, 0.45))
#: Members of a bucket compared with each other in one group.
BLOCK = 2000
#: Least hashes of a set that are compared there: of a smaller set all, so that its similarity is exact; of a larger
#: one a sample, trusted to rule a pair out below the share (five standard deviations under 0.8).
LEAST_HASHES = 256
LEAST_SHARED = 0.675

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mixed(_LOWER * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))  # a random code of each lower-cased byte
_BASE = 0xD1342543DE82EF95  # odd: has an inverse modulo 2^64
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for ``n`` positions."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, from its bytes."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    body = raw.buffers()[2]
    data = np.frombuffer(body, np.uint8)[at[0]:at[-1]] if body is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if not len(data):
        return [np.zeros(0, np.uint64)] * len(texts)
    up, down = _power_tables(len(data))
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[data] * up, dtype=np.uint64)])
    word = mixed((summed[last + 1] - summed[first]) * down[first] + (last - first).astype(np.uint64))
    begin = np.searchsorted(first, at)
    together = word.copy()
    n = len(word)
    for k in range(1, size):
        together[:n - k] = mixed(together[:n - k] * np.uint64(0x9E3779B97F4A7C15) + word[k:])
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(together[a:b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            one = word[a:a + 1].copy()
            for k in range(a + 1, b):
                one = mixed(one * np.uint64(0x9E3779B97F4A7C15) + word[k:k + 1])
            out.append(mixed(one + np.uint64(b - a)))
        else:
            out.append(word[:0])
    return out


def _probes() -> np.ndarray:
    """For each bin a fixed random order of the others, to take a value from."""
    random = np.random.default_rng(20_017)
    return np.stack([random.permutation(BINS) for _ in range(BINS)])


PROBES = _probes()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Densified one-permutation signatures of non-empty sets, a row each."""
    sig = np.full((len(sets), BINS), _EMPTY)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    for k, s in enumerate(sets):  # sorted: the first hash of a bin is its least
        bins = (s >> shift).astype(np.int64)
        new = np.concatenate([[True], bins[1:] != bins[:-1]])
        sig[k, bins[new]] = s[new]
    full = sig != _EMPTY
    dense = sig.copy()
    todo = ~full
    columns = np.arange(BINS)
    for step in range(BINS):
        if not todo.any():
            break
        rows, cols = np.nonzero(todo)
        source = PROBES[cols, step]
        got = full[rows, source]
        dense[rows[got], cols[got]] = mixed(sig[rows[got], source[got]] + columns[cols[got]].astype(np.uint64))
        todo[rows[got], cols[got]] = False
    return dense


SKETCH = "key bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sig binary"


def sketch(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: size and digest of the set, bucket keys and a short signature (16 bits of each bin)."""
    ship(docs.sparkSession)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for i, j in slices(batch.column(1), 3 << 20):
                    sets = shingles(batch.column(1).slice(i, j - i), size)
                    n = np.array([len(s) for s in sets], np.int64)
                    d1 = np.array([np.bitwise_xor.reduce(mixed(s + np.uint64(11))) if len(s) else 0 for s in sets], np.uint64)
                    d2 = np.array([mixed(s + np.uint64(77)).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                    some = np.flatnonzero(n)
                    dense = signatures([sets[k] for k in some])
                    keys = np.zeros((len(some), BANDS), np.uint64)
                    for r in range(ROWS):
                        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + dense[:, r::ROWS])
                    # a key also tells its band
                    keys = mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    short = (mixed(dense) & np.uint64(0xFFFF)).astype(np.uint16)
                    place = {int(k): p for p, k in enumerate(some)}
                    bands = [keys[place[k]].tolist() if k in place else [] for k in range(len(n))]
                    sig = [short[place[k]].tobytes() if k in place else b"" for k in range(len(n))]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                         pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                        ["key", "n_shingles", "d1", "d2", "bands", "sig"])

    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("t")).mapInArrow(sketched, SKETCH)


def alike(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether short signatures, a row each, leave it open that the sets are near; ``least``: shingles of the smaller set."""
    floor = np.zeros(len(least))
    for shingles_from, share in reversed(LEAST_EQUAL):
        floor[least >= shingles_from] = share
    return (a == b).mean(axis=-1) >= floor


def texts_of(docs: DataFrame, keys: DataFrame, key: str, text: str) -> DataFrame:
    """(key, t): one text for each of the keys; rows that share a key are one node."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("t"))
    return rows.join(keys, "key", "left_semi").groupBy("key").agg(F.min("t").alias("t"))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``num / den``; ``texts`` as of ``texts_of``."""
    ship(pairs.sparkSession)
    both = (pairs.join(texts.withColumnsRenamed({"key": "a", "t": "ta"}), "a").join(texts.withColumnsRenamed({"key": "b", "t": "tb"}), "b")
            .select("a", "b", "ta", "tb"))

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for i, j in slices(batch.column(2), 2 << 20):
                    left = shingles(batch.column(2).slice(i, j - i), size)
                    right = shingles(batch.column(3).slice(i, j - i), size)
                    keep = []
                    for x, y in zip(left, right, strict=True):
                        common = np.intersect1d(x, y, assume_unique=True).size
                        keep.append(den * common >= num * (len(x) + len(y) - common) and common > 0)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(confirmed, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(key, component): the least key reachable over the links (a, b), for every linked key.

    Alternating large-star and small-star rounds on stored edges: each joins every node
    with the least neighbour it knows, until every node but the least of its component
    has one edge, to that least.
    """
    def large(edges: DataFrame) -> DataFrame:
        """Neighbours above a node go to the least of the node and its neighbours."""
        e = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        return e.join(least, e.a == least.n).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(edges: DataFrame) -> DataFrame:
        """Neighbours below a node, and the node, go to the least of them."""
        e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        out = e.join(least, e.a == least.n).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    edges = links.where("a != b")
    while True:
        edges = stored(small(large(edges)), "edges")
        ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .union(edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not seen.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).limit(1).count():
            break
    flat = edges.select(F.col("a").alias("key"), F.col("b").alias("component"))
    return flat.union(flat.select(F.col("component").alias("key"), "component").distinct())


def near_duplicates(docs: DataFrame, size: int = 4, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; links are pairs of sets with ``den * common >= num * union``.

    Rows that share a key are one node of the result, however many sets they have.
    """
    rows, texts, several = _nodes(docs, size, key, text)
    found = _joined(rows, texts, size, num, den)
    if several:  # a key with several texts links their components, and names them
        found = stored(found, "near-duplicates")
        keyed = found.where("key is not null and n_shingles > 0")
        same = (keyed.groupBy("key").agg(F.min("component").alias("a"), F.collect_set("component").alias("z"))
                .select("a", F.explode("z").alias("b")).where("a <> b").distinct())
        whole = components(stored(same, "shared-keys")).select(F.col("component").alias("whole"), F.col("key").alias("component"))
        found = found.join(whole, "component", "left").withColumn("component", F.coalesce("whole", "component"))
        least = found.where("key is not null and n_shingles > 0").groupBy("component").agg(F.min("key").alias("least"))
        found = found.join(least, "component", "left").withColumn("component", F.coalesce("least", "key"))
    return found.select("key", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("key") == F.col("component"), F.lit(True)).alias("kept"))


def _nodes(docs: DataFrame, size: int, key: str, text: str) -> tuple[DataFrame, DataFrame, bool]:
    """(stored sketches, whose ``key`` is the node and ``real`` the row's key; (key, t) of each node; whether a key has several texts).

    A node is a key, or, where rows share a key but not their text, a text of that key: those get numbers after the
    greatest key.
    """
    plain = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("t"))
    rows = stored(sketch(plain, size, "key", "t"), "sketches")
    sets = F.struct("n_shingles", "d1", "d2")
    shared = stored(rows.where("key is not null").groupBy("key").agg(F.min(sets).alias("lo"), F.max(sets).alias("hi"))
                    .where("lo <> hi").select("key"), "shared-keys")
    if not shared.limit(1).count():
        return rows.select("*", F.col("key").alias("real")), plain, False
    most = rows.agg(F.max("key")).first()[0]
    own = plain.join(shared, "key", "left_semi")
    numbered = stored(assign_keys(own.distinct(), ["key", "t"], "node", start=most + 1), "shared-key-nodes")
    nodes = own.join(numbered.withColumnsRenamed({"key": "_k", "t": "_t"}), (F.col("key") == F.col("_k")) & F.col("t").eqNullSafe(F.col("_t"))) \
        .select("key", "t", "node")
    texts = plain.join(shared, "key", "left_anti").unionByName(numbered.select(F.col("node").alias("key"), "t"))
    again = sketch(nodes, size, "node", "t").join(numbered.select(F.col("node").alias("key"), F.col("key").alias("real")), "key")
    other = rows.join(shared, "key", "left_anti").select("*", F.col("key").alias("real"))
    return stored(other.unionByName(again.select(*other.columns)), "node-sketches"), texts, True


def _joined(rows: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(key, node, n_shingles, component) of every row: components of nodes, of which ``docs`` has the texts.

    Equal sets are one node, their least; only such nodes take part in what follows.
    """
    key, text = "key", "t"
    named = rows.where(F.col("key").isNotNull() & (F.col("n_shingles") > 0))
    digest = ["n_shingles", "d1", "d2"]
    groups = stored(named.groupBy(*digest).agg(F.min("key").alias("rep"), F.min_by(F.struct("bands", "sig"), "key").alias("s"))
                    .select(*digest, "rep", "s.*"), "groups")
    owned = stored(rows.select("key", "real", *digest).join(groups.select(*digest, "rep"), digest, "left")
                   .select("key", "real", "n_shingles", F.when(F.col("key").isNotNull(), F.col("rep")).alias("rep")), "owners")

    members = groups.select(F.col("rep").alias("key"), "n_shingles", F.explode("bands").alias("band"))
    rank = F.struct(F.xxhash64("key").alias("h"), F.col("key"), F.col("n_shingles"))
    hubs = members.groupBy("band").agg(F.min(rank).alias("hub"), F.count(F.lit(1)).alias("m")) \
        .where(F.col("m") > 1).select("band", F.col("hub.key").alias("hub"), F.col("hub.n_shingles").alias("hub_n"))
    shared = stored(members.join(hubs, "band"), "buckets")  # rows of buckets with two members or more
    may = den * F.least("n_shingles", "hub_n") >= num * F.greatest("n_shingles", "hub_n")  # sizes alone rule out the others
    stars = shared.where(F.col("key") != F.col("hub")).where(may).select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    stars = stored(_alike(stars, groups), "stars")
    texts = stored(texts_of(docs, shared.select("key").distinct(), key, text), "bucket-texts", compression="zstd")
    joined = stored(components(confirm(stars, texts, size, num, den)), "components")

    rest = stored(_apart(shared, joined, groups, texts, size, num, den), "rest")
    more = confirm(rest, texts, size, num, den)
    # what the second look links are components, so only those are joined again
    of = lambda side: joined.select(F.col("key").alias(side), F.col("component").alias(f"c{side}"))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct()
    again = components(stored(between, "more-links")).select(F.col("component").alias("final"), F.col("key").alias("component"))
    final = (joined.select("key", "component")
             .union(again.select(F.col("component").alias("key"), "component").join(joined.select("key"), "key", "left_anti"))
             .join(again, "component", "left").select(F.col("key").alias("rep"), F.coalesce("final", "component").alias("component")))
    return owned.join(final, "rep", "left").select(F.col("real").alias("key"), F.col("key").alias("node"), "n_shingles",
                                                   F.coalesce("component", "rep", "key").alias("component"))


def _alike(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures do not rule them out."""
    sides = groups.select(F.col("rep").alias("key"), "n_shingles", "sig")

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BINS) for c in (2, 3))
            least = batch.column(4).to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(alike(x, y, least)))

    both = (pairs.join(sides.select(F.col("key").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa")), "a")
            .join(sides.select(F.col("key").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb", F.least("na", "nb").alias("least")).mapInArrow(ruled, "a bigint, b bigint")


def _least_hashes(texts: DataFrame, size: int) -> DataFrame:
    """(key, least): the least shingle hashes of each text, in order, as the upper 32 bits of each."""
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for i, j in slices(batch.column(1), 3 << 20):
                    least = [(s[:LEAST_HASHES] >> np.uint64(32)).astype("<u4").tobytes() for s in shingles(batch.column(1).slice(i, j - i), size)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(least, pa.binary())], ["key", "least"])

    return texts.mapInArrow(sampled, "key bigint, least binary")


def _similar(group: list[tuple], num: int, den: int) -> tuple[list[int], list[int]]:
    """Pairs of keys of a group (band, x, y, block, key, n, c, bands, least) that may reach ``num / den``.

    Pairs in one component, of sizes too different, or that share an earlier bucket are
    left out.  The others are compared by their least hashes, one member with all others at once.
    """
    band, x, y = group[0][:3]
    block, keys, n, c = (np.array([g[i] for g in group], np.int64) for i in (3, 4, 5, 6))
    bands = np.array([g[7] for g in group], np.int64)
    sets = [np.frombuffer(g[8], "<u4") for g in group]
    sizes = np.array([len(s) for s in sets])
    cut = np.where(n > sizes, np.array([int(s[-1]) if len(s) else 0 for s in sets]), 1 << 32)  # hashes above are not known
    hashes = np.concatenate(sets)
    _, ids = np.unique(hashes, return_inverse=True)
    at = np.concatenate([[0], np.cumsum(sizes)])
    mine = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    first, second = np.flatnonzero(block == x), np.flatnonzero(block == y)
    out: tuple[list[int], list[int]] = [], []
    for i in first.tolist():
        js = second[(c[second] != c[i]) & (den * np.minimum(n[second], n[i]) >= num * np.maximum(n[second], n[i]))]
        if x == y:
            js = js[keys[js] > keys[i]]
        if not len(js):
            continue
        same = bands[js] == bands[i]
        js = js[bands[i][same.argmax(axis=1)] == band]  # met in their first common bucket
        if not len(js):
            continue
        mine[ids[at[i]:at[i + 1]]] = True
        take = np.repeat(at[js] - np.concatenate([[0], np.cumsum(sizes[js])[:-1]]), sizes[js]) + np.arange(sizes[js].sum())
        starts = np.concatenate([[0], np.cumsum(sizes[js])[:-1]])
        top = np.minimum(cut[js], cut[i])
        common = np.add.reduceat(mine[ids[take]].astype(np.int64), starts)
        theirs = np.add.reduceat((hashes[take] <= np.repeat(top, sizes[js])).astype(np.int64), starts)
        own = np.searchsorted(sets[i], top, "right")
        floor = np.where(top < 1 << 32, LEAST_SHARED, num / den - 1e-9)
        near = js[common >= floor * (own + theirs - common)]
        mine[ids[at[i]:at[i + 1]]] = False
        out[0].extend(np.minimum(keys[near], keys[i]).tolist())
        out[1].extend(np.maximum(keys[near], keys[i]).tolist())
    return out


def _apart(shared: DataFrame, joined: DataFrame, groups: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs of one bucket in different components that may reach the threshold, each once.

    Members of a bucket are dealt to blocks of ``BLOCK`` by hash, and each two blocks
    meet in a group, so a bucket of any length is dealt to many groups of two blocks.
    """
    labelled = (shared.select("band", "key", "n_shingles").join(joined, "key", "left")
                .select("band", "key", "n_shingles", F.coalesce("component", "key").alias("c")))
    mixed_buckets = labelled.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")) \
        .where("lo != hi").select("band", "m")
    members = stored(labelled.join(mixed_buckets, "band"), "mixed-buckets")
    keys = members.select("key").distinct()
    traits = _least_hashes(texts.join(keys, "key", "left_semi").select("key", "t"), size) \
        .join(groups.select(F.col("rep").alias("key"), "bands"), "key")
    of = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    rows = (members.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).withColumn("block", of)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "key", "n_shingles", "c")
            .join(traits, "key")
            .select("band", "x", "y", "block", "key", "n_shingles", "c", "bands", "least"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()) for k in _similar(group, num, den)], ["a", "b"])

        now, group = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != row[:3] and group:
                    yield found(group)
                    group = []
                now = row[:3]
                group.append(row)
        if group:
            yield found(group)

    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "band", "x", "y").sortWithinPartitions("band", "x", "y").mapInArrow(pairs, "a bigint, b bigint")


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document, with all its columns, of each group of near duplicates.

    Texts decide, not keys: of rows that share a key each text that is like no other stays, and of rows alike in
    key and text the least one.
    """
    rows, texts, several = _nodes(docs, size, key, text)
    found = stored(_joined(rows, texts, size, num, den), "near-duplicates")
    first = found.where("key is not null").groupBy("component").agg(F.min("node").alias("node"))
    kept = stored(found.join(first, ["component", "node"]).groupBy("key", "node").agg(F.count(F.lit(1)).alias("rows")), "kept")
    plain = (F.col("node") == F.col("key"))
    once, more = (kept.where(plain & c).select(F.col("key").alias(key)) for c in (F.col("rows") == 1, F.col("rows") > 1))
    least = docs.join(more, key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("_r")).select("_r.*")
    out = docs.join(once, key, "left_semi").select(*docs.columns).unionByName(least).unionByName(docs.where(F.col(key).isNull()))
    if not several:
        return out
    shared = kept.where(~plain).join(texts.withColumnRenamed("key", "node"), "node")
    named = shared.select(F.col("key").alias("_k"), F.col("t").alias("_t"))
    same = (F.col(key) == F.col("_k")) & F.col(text).eqNullSafe(F.col("_t"))
    each = docs.join(named, same, "left_semi").groupBy(key, text).agg(F.min(F.struct(*docs.columns)).alias("_r")).select("_r.*")
    return out.unionByName(each)
