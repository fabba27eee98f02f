"""Best-fit packing of token pieces into sequences by bin completion.

The search runs over the histogram of piece lengths, which has at most ``capacity``
entries however many pieces there are: around the largest length left it enumerates
undominated fillings (no filling whose items fit into the items of another is kept),
takes each as often as the counts allow, and prunes a branch when the waste made so
far already costs as many sequences as the incumbent.  The incumbent is best-fit
decreasing.  The plan's rows are then dealt to the pieces by rank within their length.

Defined cases: a null or empty text is its end id alone; every row, repeated or not,
is packed on its own; null keys are packed like others; an empty table gives no
pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .tokens import encoder, id_bytes, slices

#: Bounds of the search: bins filled in all, fillings kept for each bin, steps to enumerate them.
BINS_TRIED = 6000
FILLINGS = 4
STEPS = 400
#: Items of a filling after which it is completed largest first.
DEEP = 256
#: Pieces that are ranked within one window group, about.
RANK_GROUP = 50_000

Plan = list[tuple[int, tuple[int, ...]]]

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text and ``end_id``, cut only where longer than ``capacity``; the first piece takes the odd rest.

    ``ids`` holds little-endian unsigned ids, of 16 bits if the vocabulary fits, else 32; ``ids_crc32`` is the
    checksum of them as 32-bit integers.
    """
    ship(docs.sparkSession)
    kind = f"<u{id_bytes(tokenizer, end_id)}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False)
        for batch in batches:
            for i, j in slices(batch.column(1)):
                keys = batch.column(0).slice(i, j - i).to_pylist()
                ids, at = enc.encode(batch.column(1).slice(i, j - i))
                wide, narrow, at = ids.astype("<u4"), ids.astype(kind), at.tolist()
                end4, end2 = np.array([end_id], "<u4").tobytes(), np.array([end_id], kind).tobytes()
                rows = []
                for k, key_value in enumerate(keys):
                    begin, n = at[k], at[k + 1] - at[k] + 1
                    size = n % capacity or capacity
                    place, number = 0, 0
                    while place < n:
                        last = place + size == n
                        to = begin + place + size - last
                        crc = zlib.crc32(wide[begin + place:to].tobytes())
                        rows.append((key_value, number, place, size, zlib.crc32(end4, crc) if last else crc,
                                     narrow[begin + place:to].tobytes() + (end2 if last else b"")))
                        place, size, number = place + size, capacity, number + 1
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).mapInArrow(cut, PIECES)


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Incumbent: the largest length left, then always the largest that fits; each filling as often as it can be had."""
    left = dict(counts)
    sizes = sorted(left)
    plan: Plan = []
    while sizes:
        items, room, taken = [], capacity, {}
        k = len(sizes) - 1
        while k >= 0:
            size = sizes[k]
            if size <= room and left[size] > taken.get(size, 0):
                items.append(size)
                taken[size] = taken.get(size, 0) + 1
                room -= size
            else:
                k = min(k - 1, bisect_right(sizes, room) - 1) if size > room else k - 1
        times = min(left[s] // n for s, n in taken.items())
        plan.append((times, tuple(items)))
        for s, n in taken.items():
            left[s] -= times * n
        sizes = [s for s in sizes if left[s]]
    return plan


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """Lower bound: items over half take a bin each, and items of ``k`` or more only fit where that leaves room for them."""
    number, amount = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for s, n in counts.items():
        number[s] += n
        amount[s] += s * n
    number, amount = np.cumsum(number), np.cumsum(amount)  # of items up to a size
    half = capacity // 2
    best = -(-int(amount[-1]) // capacity)
    for k in range(1, half + 1):
        large = int(number[-1] - number[capacity - k])
        middle, middle_sum = int(number[capacity - k] - number[half]), int(amount[capacity - k] - amount[half])
        small_sum = int(amount[half] - amount[k - 1])
        best = max(best, large + middle + max(0, -(-(small_sum - (middle * capacity - middle_sum)) // capacity)))
    return best


def _fits_into(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the items of ``small`` can be put into the items of ``large`` (each a room of its size)."""
    def put(k: int, rooms: tuple[int, ...]) -> bool:
        if k == len(small):
            return True
        seen = set()
        for i, r in enumerate(rooms):
            if r >= small[k] and r not in seen:
                seen.add(r)
                if put(k + 1, (*rooms[:i], r - small[k], *rooms[i + 1:])):
                    return True
        return False

    return sum(small) <= sum(large) and put(0, large)


def fillings(left: dict[int, int], sizes: list[int], room: int, width: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the lengths left, least waste first, larger items first; up to ``width``."""
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = 0
    smallest = sizes[0] if sizes else room + 1

    def greedy(items: list[int], rest: int, top: int) -> tuple[int, tuple[int, ...]]:
        whole = list(items)
        for k in range(top, -1, -1):
            more = min(left[sizes[k]] - items.count(sizes[k]), rest // sizes[k])
            whole += [sizes[k]] * more
            rest -= more * sizes[k]
        return rest, tuple(whole)

    def extend(items: list[int], rest: int, top: int, run: int) -> bool:
        """``run``: how many of the last item are used already.  True: stop."""
        nonlocal steps
        steps += 1
        if len(items) >= DEEP:  # the rest of so long a filling is not branched on
            found.append(greedy(items, rest, top))
            return steps > STEPS or sum(w == 0 for w, _ in found) >= width
        if rest < smallest:
            found.append((rest, tuple(items)))
            return steps > STEPS or sum(w == 0 for w, _ in found) >= width
        grown = False
        for k in range(min(top, bisect_right(sizes, rest) - 1), -1, -1):
            size = sizes[k]
            used = run if items and items[-1] == size else 0
            if left[size] <= used:
                continue
            grown = True
            items.append(size)
            stop = extend(items, rest - size, k, used + 1)
            items.pop()
            if stop or steps > STEPS:
                return True
        if not grown:
            found.append((rest, tuple(items)))
        return sum(w == 0 for w, _ in found) >= width or steps > STEPS

    extend([], room, len(sizes) - 1, 0)
    found.sort(key=lambda x: (x[0], [-s for s in x[1]]))
    kept: list[tuple[int, ...]] = []
    for _, items in found[:4 * width]:
        if len(items) > 8 or not any(len(k) <= 8 and _fits_into(items, k) for k in kept):
            kept.append(items)
        if len(kept) == width:
            break
    return kept


def complete_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Plan with few bins: (times, lengths in one bin), by branch and bound over fillings of the largest length left.

    Optimal whenever it reaches ``least_bins``; otherwise the best plan found within
    ``BINS_TRIED`` bins, the incumbent at worst.
    """
    counts = {s: n for s, n in counts.items() if n}
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError(f"a length is outside 1 to {capacity}")
    best = best_fit_decreasing(counts, capacity)
    best_bins = sum(t for t, _ in best)
    total = sum(s * n for s, n in counts.items())
    lower = least_bins(counts, capacity)
    tried = 0
    #: (counts left, plan so far as a linked list, bins, waste)
    stack = [(counts, None, 0, 0)]
    while stack and best_bins > lower and tried < BINS_TRIED:
        left, plan, bins, waste = stack.pop()
        while tried < BINS_TRIED:
            tried += 1
            if not left:
                if bins < best_bins:
                    best, best_bins = [], bins
                    while plan:
                        best.append(plan[0])
                        plan = plan[1]
                    best.reverse()
                break
            if -(-(total + waste) // capacity) >= best_bins:
                break  # the waste so far already costs as many bins
            sizes = sorted(left)
            top = sizes[-1]
            after = {**left, top: left[top] - 1}
            options = []
            for items in fillings(after, [s for s in sizes if after[s]], capacity - top) or [()]:
                bin_items = (top, *items)
                need: dict[int, int] = {}
                for s in bin_items:
                    need[s] = need.get(s, 0) + 1
                times = min(left[s] // n for s, n in need.items())
                rest = {s: n - times * need.get(s, 0) for s, n in left.items()}
                options.append(({s: n for s, n in rest.items() if n}, ((times, bin_items), plan), bins + times,
                                waste + times * (capacity - sum(bin_items))))
            stack.extend(reversed(options[1:]))
            left, plan, bins, waste = options[0]
    return best


def plan_rows(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies in a bin, offset) for each length of each filling."""
    rows, ranks, sequence = [], {}, 0
    for times, items in plan:
        offset = 0
        for size in dict.fromkeys(items):
            copies = items.count(size)
            begin = ranks.get(size, 0)
            ranks[size] = begin + times * copies
            rows.append((size, begin, ranks[size], sequence, copies, offset))
            offset += copies * size
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (a column ``length``), packed into few sequences.

    ``order`` names the columns that tell pieces of a length apart.  Ranks within a
    length come from two steps, so that a length that many pieces share is spread:
    counts of (length, hash bucket) give each bucket's first rank, and a window ranks
    inside a bucket.  Only the histogram, ``capacity`` rows at most, reaches the driver.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = complete_bins(counts, capacity)
    dealt = spark.createDataFrame(plan_rows(plan), "p_length long, p_from long, p_to long, p_sequence long, p_copies long, p_offset long")
    buckets = max(16, -(-max(counts.values(), default=0) // RANK_GROUP))
    salted = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    firsts = (salted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .select("length", "_bucket", F.coalesce(F.sum("_n").over(
                  Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first")))
    ranked = (salted.withColumn("_inner", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1)
              .join(firsts, ["length", "_bucket"]).withColumn("_rank", F.col("_first") + F.col("_inner")))
    # a few rows for each length, whatever the number of pieces: bounded by the capacity
    placed = ranked.join(F.broadcast(dealt), (F.col("length") == F.col("p_length"))
                         & (F.col("_rank") >= F.col("p_from")) & (F.col("_rank") < F.col("p_to")))
    nth = F.col("_rank") - F.col("p_from")
    return placed.select(*pieces.columns, (F.col("p_sequence") + F.floor(nth / F.col("p_copies"))).alias("sequence_id"),
                         (F.col("p_offset") + (nth % F.col("p_copies")) * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(places, pieces): the place of every piece, and the stored pieces with their ids.

    Join both on (doc_id, piece) to write sequences of ids; the places alone are shuffled here.
    """
    pieces = stored(token_pieces(docs, tokenizer, end_id, capacity, key, text), "pieces", compression="zstd")
    places = pack(pieces.drop("ids"), capacity, ["doc_id", "piece", "start", "ids_crc32"])
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"), pieces
