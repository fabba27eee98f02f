"""SimHash near duplicates: inverted index over byte positions, count filtering, verification.

1. Each whole text becomes a 64-bit fingerprint, eight positional bytes.  Equal fingerprints are one
   node; copies are not compared.
2. Fingerprints that differ in at most ``MAX_BITS`` = 4 bits differ in at most four bytes, so they share
   at least four of the eight positional bytes.  The index lists nodes by a few positions and their bytes
   together: position sets are chosen so that any four positions hold one of them (``covers``), which
   loses no pair.  The more nodes, the more positions a list has (two, three or four), so lists stay short.
3. In a list each pair's shared positional bytes are tallied; pairs with four or more are retained
   and verified on all 64 bits.
4. Lists longer than ``LIST`` (groups of near copies) are split by further positions until
   four are fixed; a list still longer is dealt to blocks, of which each two meet in a task.
5. A list gives the links of a spanning forest, not all pairs, and components are joined over nodes.

The answer is exact: no list and no partner is left out.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any
other; fewer words than a shingle count as one; rows are nodes by their fingerprint, so rows that
share a key, but not the text, are separate; rows with a null key take part, and their component is
the least key that is not null (null if there is none); an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .minhash import components
from .tokens import slices

POSITIONS = 8
MAX_BITS = 4
LEAST_SHARED = POSITIONS - MAX_BITS
SEED = 42
#: Members of a list that one task compares with each other; a matter of cost, not of results.
LIST = 1024

_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of the space-joined shingles of a text, repeats included; of the whole sequence if it is shorter."""
    from xxhash import xxh64_intdigest

    text = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(text, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    begins = [0, *ends[:-size]]
    return np.fromiter((xxh64_intdigest(text[i:j - 1], SEED) for i, j in zip(begins, ends[size - 1:], strict=True)), np.uint64, len(begins))


def majority(h: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[k:k + (1 << 16)].astype(">u8"))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprint(text: str | None, size: int) -> int:
    """Unsigned fingerprint of a text: A-Z are lower-cased, and words end at the six ASCII white-space characters."""
    words = (text or "").encode().lower().split()
    return majority(hashes(words, size)) if words else 0


def fingerprints(docs: DataFrame, size: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of every row; ``fp`` is the fingerprint as a signed 64-bit number."""
    ship(docs.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(1)):
                found = np.array([fingerprint(t, size) for t in batch.column(1).slice(i, j - i).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(found.view(np.int64))], ["key", "fp"])

    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("t")).mapInArrow(made, "key bigint, fp bigint")


def covers(width: int) -> list[tuple[int, ...]]:
    """Sets of ``width`` positions such that any ``LEAST_SHARED`` positions hold one of them.

    The positions form three groups in a ring.  Of four positions two are in one group; and three are in
    one group, or two in one and the third in the next.
    """
    if width == LEAST_SHARED:
        return list(combinations(range(POSITIONS), width))
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    if width == 2:
        return [c for c in combinations(range(POSITIONS), 2) if group[c[0]] == group[c[1]]]
    if width == 3:
        def fits(c):
            held = sorted(group[p] for p in c)
            return held[0] == held[2] or any(held == sorted((g, g, (g + 1) % 3)) for g in range(3))
        return [c for c in combinations(range(POSITIONS), 3) if fits(c)]
    raise ValueError(f"no cover of width {width}")


def width_for(nodes: int) -> int:
    """Positions of a list: as few as keep lists of evenly spread fingerprints under an eighth of ``LIST``."""
    return next((w for w in (2, 3) if nodes / 256 ** w <= LIST / 8), LEAST_SHARED)


def _list_key(positions: tuple[int, ...]) -> Column:
    """(which positions, their bytes) as one number: a bit mask above the bytes in place."""
    mask = sum(0xFF << (8 * p) for p in positions)
    signed = mask - (1 << 64) if mask >= 1 << 63 else mask
    return F.struct(F.lit(sum(1 << p for p in positions)).alias("positions"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bytes"))


def _short_and_long(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (k, fp) of the lists of two members or more: those of up to ``LIST``, and the longer ones, with their length."""
    sizes = index.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    known = stored(index.join(sizes, "k"), "simhash-lists")
    return known.where(F.col("n") <= LIST), known.where(F.col("n") > LIST)


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of fingerprints that connect whatever fingerprints at most ``MAX_BITS`` bits apart connect."""
    spark = nodes.sparkSession
    ship(spark)
    count = nodes.count()
    width = width_for(count)
    index = nodes.select(F.explode(F.array(*[_list_key(c) for c in covers(width)])).alias("k"), "fp")
    short, long = _short_and_long(index)
    groups = [short.select("k", F.lit(0).alias("x"), F.lit(0).alias("y"), "fp")]
    if width < LEAST_SHARED:
        # a pair that shares a list, and four positions in all, also shares a list of four positions that include it
        four = F.array(*[_list_key(c) for c in covers(LEAST_SHARED)])
        inside = F.filter(four, lambda k: k["positions"].bitwiseAND(F.col("k.positions")) == F.col("k.positions"))
        short, long = _short_and_long(long.select(F.explode(inside).alias("k"), "fp").distinct())
        groups.append(short.select("k", F.lit(0).alias("x"), F.lit(0).alias("y"), "fp"))
    # two blocks meet in each group: all pairs of a longer list are in one
    dealt = (long.withColumn("blocks", F.ceil(F.col("n") * 2 / LIST).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block != other"))
    groups.append(dealt.select("k", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "fp"))
    rows = groups[0]
    for g in groups[1:]:
        rows = rows.unionByName(g)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(F.col("k.positions").alias("p"), F.col("k.bytes").alias("v"), "x", "y", "fp")
    found = rows.repartition(parts, "p", "v", "x", "y").sortWithinPartitions("p", "v", "x", "y").mapInArrow(_compare, "a bigint, b bigint")
    return found.distinct()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a spanning forest of each group (p, v, x, y), whose rows come one after the other."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)]))
        rows = np.concatenate(held, axis=1)
        last = np.flatnonzero((rows[:4] != rows[:4, -1:]).any(axis=0))
        whole = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
        if whole:
            yield _forest(rows[:, :whole])
        held = [rows[:, whole:]]
    if held:
        yield _forest(held[0])


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many positional bytes are equal, given the bits that differ."""
    differs = (((x & _LOW) + _LOW) | x) & _HIGH  # the high bit of each byte that is not zero
    return POSITIONS - np.bitwise_count(differs).astype(np.int64)


def _forest(rows: np.ndarray) -> pa.RecordBatch:
    n = rows.shape[1]
    fp = rows[4].view(np.uint64) if rows[4].flags.c_contiguous else np.ascontiguousarray(rows[4]).view(np.uint64)
    new = np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)])
    group = np.cumsum(new) - 1
    ends = np.append(np.flatnonzero(new)[1:], n)[group]  # where each row's group ends
    label = np.arange(n)
    left, right = [], []
    at = np.arange(n)
    step = 0
    while len(at):
        step += 1
        at = at[at + step < ends[at]]
        x = fp[at] ^ fp[at + step]
        near = at[shared_bytes(x) >= LEAST_SHARED]  # count filter
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= MAX_BITS]
        left.append(near)
        right.append(near + step)
    i, j = np.concatenate([*left, label[:0]]), np.concatenate([*right, label[:0]])
    while True:  # least label of each component
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(rows[4][label[linked]]), pa.array(rows[4][linked])], ["a", "b"])


def near_duplicates(docs: DataFrame, size: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row."""
    rows = stored(fingerprints(docs, size, key, text), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("key").alias("least")), "fingerprint-nodes")
    joined = components(links(nodes.select("fp"))).withColumnsRenamed({"key": "fp", "component": "label"})
    labelled = nodes.join(joined, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of = stored(labelled.join(least, "label").select("fp", "component_id"), "fingerprint-components")
    return rows.join(of, "fp").select("key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
