"""Two tokenizers aligned over a corpus: external counting of linked id pairs, and each document's share.

1. Each whole text is encoded by both tokenizers, and their byte offsets are laid over each other: a link is
   a pair of tokens whose ranges overlap, a group ends where both end.  Texts are cut only where both
   vocabularies surely end a token (``tokens.cuts``, and no piece of the second goes across), so a distinct
   part is aligned once and a bounded number are remembered.
2. A document's distinct pairs (a, b) are pair-document records.  A task radix-partitions the records of a
   slice of documents by their A id and writes each partition as a sorted zstd run: the pairs in order,
   how many documents hold each, and these documents' places.  A document is in one slice only.
3. Counting: runs of one radix partition meet ``MERGE`` at a time; a heap of their cursors gives the
   next stretch of keys that is complete in all of them.  Merged runs are merged again, until a partition
   has one.  Order is by A id first, so the last merge also yields each A id's highest count in passing.
   A pair in every document is one entry of each run, so no id is hot.
4. Contributions: the counts of a radix partition go, once for each ``MERGE`` runs, to the runs again, which are
   streamed past them: every document gets the counts of its pairs, and the partitions' sums meet by slice.

The shuffles carry compressed runs, and a task holds about ``MERGE`` of them.

Defined cases: a null or empty text, and one whose tokens' bytes are not a space and the text (a text with
U+2581, which the second vocabulary reads as a space) have no tokens: zeros and an empty digest; rows that
share a key, or have a null key, are documents of their own; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import struct
from collections.abc import Iterator
from itertools import chain, groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .tokens import cuts, slices

#: Radix partitions of A ids, runs that a task merges, and records (at least; to the end of a text slice) of a run.
RADIX = 32
MERGE = 64
RECORDS = 1_000_000
#: Entries of a zstd frame: what a cursor holds of a run.
FRAME = 8192
#: Bytes of text aligned at once (a longer single text is aligned whole).
SLICE = 2 << 20
#: Bounds of a worker's memory of aligned parts.
KNOWN_PARTS = 250_000
KNOWN_BYTES = 48


# --- alignment ----------------------------------------------------------------------
class Aligner:
    """Aligns parts of texts; ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model with byte fallback."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printed}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printed))}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table], np.int64) for table in
                                          ([self.bytes_a.get(i, b"") for i in range(self.a.get_vocab_size())], self.bytes_b))
        # a text may be cut before a space, around a newline, and before a mark after a letter, if no piece goes across
        self.may_cut = not any("▁" in p.lstrip("▁") or "\n" in p or any(x.isalpha() and y in ".," for x, y in pairwise(p)) for p in pieces)
        self.known: dict[bytes, int] = {}
        self.kept = 0  # once full: parts up to the last one remembered
        self.groups: list[bytes | None] = []  # None: no alignment
        self.counts = np.zeros((1 << 12, 4), np.int64)
        self.pairs = np.zeros(1 << 14, np.uint64)
        self.offsets = np.zeros(1 << 12, np.int64)

    def _encode(self, parts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each part, with no sign of a beginning: the second tokenizer adds a space before its text, so a part's own
        first space is left to it, and other parts are put after a newline, a token of its own."""
        texts = [p.decode() for p in parts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[:1] == " " else "\n" + t for t in texts], num_threads=1)
        return ids_a, [ids if t[:1] == " " else ids[2:] for ids, t in zip(ids_b, texts, strict=True)]

    def _add(self, parts: list[bytes]) -> None:
        """Align new parts all at once, laid one after the other; they get the next numbers."""
        ids_a, ids_b = self._encode(parts)
        joined = [[b"".join([table[i] for i in ids]) for ids in side] for side, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b))]
        whole = [p == x == y for p, x, y in zip(parts, *joined, strict=True)]
        ids_a, ids_b = ([ids if w else [] for ids, w in zip(side, whole, strict=True)] for side in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (ids_a, ids_b))
        many_a, many_b = (np.fromiter(map(len, side), np.int64, len(parts)) for side in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])
        ends = np.union1d(ends_a, ends_b)  # each stretch between two ends is a link
        pairs = flat_a[np.searchsorted(ends_a, ends)].astype(np.uint64) << np.uint64(32) | flat_b[np.searchsorted(ends_b, ends)].astype(np.uint64)
        shut = np.intersect1d(ends_a, ends_b, assume_unique=True)
        part_ends = np.cumsum(np.where(whole, [len(p) for p in parts], 0))
        links = np.diff(np.searchsorted(ends, part_ends, "right"), prepend=0)
        closed = np.diff(np.searchsorted(shut, part_ends, "right"), prepend=0)
        names_a, names_b = (list(map(str, flat.tolist())) for flat in (flat_a, flat_b))
        to_a, to_b = ((np.searchsorted(e, shut) + 1).tolist() for e in (ends_a, ends_b))
        said = [",".join(names_a[i:k]) + "|" + ",".join(names_b[j:m])
                for i, k, j, m in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)]
        first, base = len(self.groups), int(self.offsets[len(self.groups)])
        at = 0
        for k, n in enumerate(closed.tolist()):
            self.groups.append(";".join(said[at:at + n]).encode() if whole[k] else None)
            at += n
            if len(self.known) < KNOWN_PARTS and len(parts[k]) <= KNOWN_BYTES:
                self.known[parts[k]] = first + k
                if len(self.known) == KNOWN_PARTS:
                    self.kept = first + k + 1
        last = len(self.groups)
        while last + 1 > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        while base + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.pairs[base:base + len(pairs)] = pairs
        self.offsets[first + 1:last + 1] = base + np.cumsum(links)
        self.counts[first:last] = np.stack([many_a, many_b, closed, links], axis=1)

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """((n_a, n_b, n_groups, n_links) a row each, digests, pair keys of all links one after another, links of each text)."""
        if self.kept:
            del self.groups[self.kept:]  # parts that were not remembered
        empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
        space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        prefixed = pc.binary_join_element_wise(space, pc.fill_null(texts.cast(pa.large_string()), ""), nothing).cast(pa.large_binary())
        at = np.frombuffer(prefixed.buffers()[1], np.int64)[prefixed.offset:prefixed.offset + len(prefixed) + 1]
        data = np.frombuffer(prefixed.buffers()[2], np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        cut = cuts(data)[0] if self.may_cut else np.zeros(len(data), bool)
        cut[at[:-1]] = True
        begins = np.append(np.flatnonzero(cut), len(data))
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        number = np.fromiter((self.known.get(p, -1) for p in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            number[missing] = len(self.groups) + np.arange(len(missing))
            self._add([distinct[k] for k in missing.tolist()])
        groups = [self.groups[k] for k in number.tolist()]
        failed = np.array([g is None for g in groups], bool)
        place = coded.indices.to_numpy(zero_copy_only=False)
        first = np.searchsorted(begins, at)
        bad = np.add.reduceat(failed[place], first[:-1], dtype=np.int64).astype(bool) | empty
        totals = np.add.reduceat(self.counts[number[place]], first[:-1], axis=0)
        totals[bad] = 0
        order = place.tolist()
        digests = ["" if b else hashlib.sha256(b";".join([groups[k] for k in order[i:j]])).hexdigest()
                   for b, i, j in zip(bad.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True)]
        take = number[place[np.repeat(~bad, np.diff(first))]]
        many = self.offsets[take + 1] - self.offsets[take]
        ends = np.cumsum(many)
        index = np.repeat(self.offsets[take] - (ends - many), many) + np.arange(int(many.sum()))
        return totals, digests, self.pairs[index], totals[:, 3]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner, kept from task to task."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


# --- runs ---------------------------------------------------------------------------
def _pack(values: np.ndarray) -> bytes:
    """A zstd frame of unsigned numbers, their bytes by place so that the high ones compress."""
    width = 8 if values.dtype.itemsize == 8 else 4
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(frame: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _framed(frames: list[bytes]) -> bytes:
    return b"".join(struct.pack("<I", len(f)) + f for f in frames)


def _frames(body: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(body):
        n = struct.unpack_from("<I", body, at)[0]
        yield body[at + 4:at + 4 + n]
        at += 4 + n


def write_pairs(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A run of pairs in order: frames of key steps and counts, two a stretch of ``FRAME`` entries."""
    frames = []
    for k in range(0, len(keys), FRAME):
        part = keys[k:k + FRAME]
        frames += [_pack(np.concatenate([part[:1], np.diff(part)])), _pack(counts[k:k + FRAME].astype(np.uint64))]
    return _framed(frames)


def read_pairs(body: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches (keys, counts) of a run."""
    frames = _frames(body)
    for f in frames:
        yield np.cumsum(_unpack(f, np.uint64)), _unpack(next(frames), np.uint64)


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches (keys, summed counts) in order of all runs together, a stretch of each run held at a time.

    The heap is ordered by the last key that each cursor holds: up to the least of these, all runs are known.
    """
    cursors = [read_pairs(r) for r in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(k: int) -> None:
        stretch = next(cursors[k], None)
        if stretch is None:
            held.pop(k, None)
        else:
            held[k] = stretch
            heapq.heappush(heap, (int(stretch[0][-1]), k))

    for k in range(len(cursors)):
        load(k)
    while heap:
        limit = heap[0][0]
        keys, counts = [], []
        for k, (ks, cs) in list(held.items()):
            n = int(np.searchsorted(ks, np.uint64(limit), "right"))
            if n:
                keys.append(ks[:n])
                counts.append(cs[:n])
                held[k] = ks[n:], cs[n:]
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every = every[order]
        begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        yield every[begin], np.add.reduceat(np.concatenate(counts)[order], begin)


def with_maxima(stretches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, best) by whole A ids: ``best`` tells that no pair of the A id has a higher count."""
    rest: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def judged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = keys >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        top = np.repeat(np.maximum.reduceat(counts, begin), np.diff(np.append(begin, len(keys))))
        return keys, counts, counts == top

    for keys, counts in stretches:
        keys, counts = np.concatenate([rest[0], keys]), np.concatenate([rest[1], counts])
        cut = int(np.searchsorted(keys, keys[-1] >> np.uint64(32) << np.uint64(32)))  # the last A id may go on
        if cut:
            yield judged(keys[:cut], counts[:cut])
        rest = keys[cut:], counts[cut:]
    if len(rest[0]):
        yield judged(*rest)


RUNS = "slice bigint, radix int, docs binary, pairs binary, places binary"


def _slice_rows(number: int, keys: list, totals: list, digests: list, records: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """A slice's rows: one of its documents, one run for each radix partition that has records."""
    table = pa.table({"key": pa.chunked_array(keys), "digest": pa.array(digests, pa.string()),
                      **{n: pa.array(np.concatenate([t[:, k] for t in totals])) for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))}})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    out = [(number, -1, sink.getvalue().to_pybytes(), None, None)]
    key, place, times = (np.concatenate(c) for c in zip(*records, strict=True))
    radix = (key >> np.uint64(32)) % np.uint64(RADIX)
    order = np.lexsort((place, key, radix))
    key, place, times, radix = key[order], place[order], times[order], radix[order]
    ends = np.searchsorted(radix, np.arange(RADIX + 1))
    for r in range(RADIX):
        k, p, t = (x[ends[r]:ends[r + 1]] for x in (key, place, times))
        if not len(k):
            continue
        begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        step = p.astype(np.int64)
        step[1:] -= p[:-1]
        step[begin] = p[begin]  # places go up within a pair
        out.append((number, r, None, write_pairs(k[begin], np.diff(np.append(begin, len(k)))), _framed([_pack(step.astype(np.uint32)), _pack(t)])))
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                      ["slice", "radix", "docs", "pairs", "places"])


def write_runs(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored runs and documents of all slices."""
    ship(docs.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        keys, totals, digests, records, docs_held, held = [], [], [], [], 0, 0
        for batch in batches:
            for i, j in slices(batch.column(1), SLICE):
                total, digest, pairs, many = tool.align(batch.column(1).slice(i, j - i))
                doc = np.repeat(np.arange(j - i, dtype=np.uint64), many)
                names, coded = np.unique(pairs, return_inverse=True)  # a record: one document and one of its pairs
                both, times = np.unique(doc * np.uint64(max(1, len(names))) + coded.astype(np.uint64), return_counts=True)
                place, which = np.divmod(both, np.uint64(max(1, len(names))))
                records.append((names[which.astype(np.int64)], (place + np.uint64(docs_held)).astype(np.uint32), times.astype(np.uint32)))
                keys.append(batch.column(0).slice(i, j - i))
                totals.append(total)
                digests.extend(digest)
                docs_held += j - i
                held += len(both)
                if held >= RECORDS:
                    yield _slice_rows(number, keys, totals, digests, records)
                    number += 1
                    keys, totals, digests, records, docs_held, held = [], [], [], [], 0, 0
        if docs_held:
            yield _slice_rows(number, keys, totals, digests, records)

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("t")).mapInArrow(runs, RUNS)
    return stored(rows, "alignment-runs")


# --- counting and contributions -----------------------------------------------------
COUNTS = "radix int, counts binary"


def _by_group(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of rows that follow each other and have the first ``width`` columns in common."""
    rows = (r for batch in batches for k in range(batch.num_rows) for r in zip(*(c.to_pylist() for c in batch.slice(k, 1).columns), strict=True))
    return groupby(rows, key=lambda r: r[:width])


def count_pairs(runs: DataFrame) -> DataFrame:
    """(radix, counts): the counts of all pairs of each radix partition and whether they are their A id's highest, packed."""
    level = runs.where("radix >= 0").select("radix", "slice", "pairs")
    slices_in = runs.where("radix < 0").count()

    def merge(last: bool):
        def merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (radix, group), rows in _by_group(batches, 2):
                stretches = merged([r[2] for r in rows])
                if last:
                    body = _framed([f for keys, counts, best in with_maxima(stretches) for f in (_pack(keys), _pack(counts), _pack(best.astype(np.uint32)))])
                else:
                    body = b"".join(write_pairs(*s) for s in stretches)
                yield pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([group], pa.int64()), pa.array([body], pa.binary())],
                                                 ["radix", "slice", "pairs"])
        return merging

    while True:
        groups = max(1, -(-slices_in // MERGE))
        dealt = level.select("radix", F.pmod(F.xxhash64("slice"), F.lit(groups)).alias("slice"), "pairs")
        dealt = dealt.repartition(_parts(runs), "radix", "slice").sortWithinPartitions("radix", "slice")
        level = dealt.mapInArrow(merge(groups == 1), "radix int, slice bigint, pairs binary")
        if groups == 1:
            return stored(level.select("radix", F.col("pairs").alias("counts")), "alignment-counts")
        level, slices_in = stored(level, "alignment-merged"), groups


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _read_counts(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, counts, best = [], [], []
    frames = _frames(body)
    for f in frames:
        keys.append(_unpack(f, np.uint64))
        counts.append(_unpack(next(frames), np.uint64))
        best.append(_unpack(next(frames), np.uint32))
    return np.concatenate(keys), np.concatenate(counts).astype(np.int64), np.concatenate(best).astype(np.int64)


def contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(slice, sums): what each radix partition adds to n_best and count_sum of the slice's documents, packed by place."""
    groups = max(1, -(-runs.where("radix < 0").count() // MERGE))
    of_runs = runs.where("radix >= 0").select("radix", F.pmod(F.xxhash64("slice"), F.lit(groups)).alias("g"), F.col("slice").alias("slice"),
                                              "pairs", "places")
    to_each = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("g"),
                            F.lit(None).cast("bigint").alias("slice"), F.col("counts").alias("pairs"), F.lit(None).cast("binary").alias("places"))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_group(batches, 2):
            keys, count, best = _read_counts(next(rows)[3])  # a null slice comes first
            for _, _, number, pairs, places in rows:
                at, many = [], []
                for k, n in read_pairs(pairs):
                    at.append(np.searchsorted(keys, k))
                    many.append(n.astype(np.int64))
                at, many = np.concatenate(at), np.concatenate(many)
                frames = _frames(places)
                step, times = _unpack(next(frames), np.uint32).astype(np.int64), _unpack(next(frames), np.uint32).astype(np.int64)
                place = np.cumsum(step)
                begin = np.concatenate([[0], np.cumsum(many)[:-1]])
                place -= np.repeat(place[begin] - step[begin], many)  # steps begin anew in each pair
                at = np.repeat(at, many)
                sums = np.zeros((2, int(place.max()) + 1), np.int64)
                np.add.at(sums[0], place, times * best[at])
                np.add.at(sums[1], place, times * count[at])
                body = _framed([_pack(s.view(np.uint64)) for s in sums])
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([body], pa.binary())], ["slice", "sums"])

    rows = to_each.unionByName(of_runs).repartition(_parts(runs), "radix", "g").sortWithinPartitions("radix", "g", F.asc_nulls_first("slice"))
    return rows.mapInArrow(streamed, "slice bigint, sums binary")


ALIGNED = "key bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def align_corpus(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of alignment figures for each document, with corpus-wide counts of linked id pairs."""
    runs = write_runs(docs, path_a, path_b, key, text)
    counts = count_pairs(runs)
    adds = contributions(runs, counts).select("slice", F.lit(1).alias("kind"), F.col("sums").alias("body"))
    rows = runs.where("radix < 0").select("slice", F.lit(0).alias("kind"), F.col("docs").alias("body")).unionByName(adds)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _by_group(batches, 1):
            table = pa.ipc.open_stream(next(group)[2]).read_all()
            sums = np.zeros((2, table.num_rows), np.int64)
            for _, _, body in group:
                for total, frame in zip(sums, _frames(body), strict=True):
                    part = _unpack(frame, np.uint64).view(np.int64)
                    total[:len(part)] += part
            yield from pa.table({**{n: table[n] for n in ("key", "n_a", "n_b", "n_groups", "n_links")}, "n_best": pa.array(sums[0]),
                                 "count_sum": pa.array(sums[1]), "groups_sha256": table["digest"]}).combine_chunks().to_batches()

    return rows.repartition(_parts(runs), "slice").sortWithinPartitions("slice", "kind").mapInArrow(summed, ALIGNED)
