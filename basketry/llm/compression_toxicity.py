"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more.

Training, on a bounded sample of labelled texts: beginnings of words whose counts speak
for toxic text are found, zstandard trains one dictionary on the
toxic texts' words with such a beginning and one on ordinary text.  The toxic
dictionary is used together with the ordinary one, so that what both know costs the
same and the difference of two lengths comes from toxic text alone.

Scoring covers whole texts: every window, a word (a run of letters, in lower case), is
compressed with either dictionary (equal windows of a task once).  A logistic curve
over the largest saving of a window and the number and share of windows with a large saving,
fitted on a third of the sample with dictionaries of the rest and shifted so that the threshold
has the fewest errors there, gives the score.

Defined cases: a null or empty text, or one without words, saves nothing and scores
as such; null labels are not learned from; repeated rows are scored each on their own;
without labels of both classes every score is 0; keys may be null or tie; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_keys, having, ship, stored
from .tokens import slices

#: Bounds of the training sample: texts of a class, and characters of a text that may be learned from.
SAMPLE_TOXIC = 1500
SAMPLE_ORDINARY = 3000
SAMPLE_CHARS = 20_000
#: Groups that have a share of their own.
GROUPS = 30
#: A beginning of a word is evidence if it is in so many toxic texts, is this many times as common there, and more than by chance.
EVIDENCE_TEXTS = 2
EVIDENCE_RATIO = 12.0
EVIDENCE_MARGIN = 3.0
#: Finds of a beginning in one text that count.
TEXT_COUNT = 8
STEM_CHARS = (4, 5, 6, 7, 8, 9, 10)
DICT_BYTES = 12 << 10
#: Bytes saved from which a window counts as toxic; windows whose savings a task remembers.
STRONG = 2
KNOWN_WINDOWS = 500_000
#: Depth and kind (btlazy2) of zstandard's match search.
SEARCH_LOG = 7
STRATEGY = 6
MIN_MATCH = 4
THRESHOLD = 0.3
#: The share of strong windows counts as if a text had so many more windows.
SHARE_WINDOWS = 30
#: Weights without labels of both classes: every score is 0.
NOTHING = (-30.0, 0.0, 0.0, 0.0)

@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


WIDTH = 2
#: Each byte of text is compressed as ``WIDTH`` bytes (a fixed rule), so that a shared beginning weighs more than a match costs.
_WIDE = (((np.arange(256, dtype=np.uint64) * 2654435761 + 97) & 0xFFFFFFFF).astype("<u4").view(np.uint8).reshape(256, 4)[:, :WIDTH]).copy()


def widened(text: bytes) -> bytes:
    return _WIDE[np.frombuffer(text, np.uint8)].tobytes()


class Scorer:
    """Compresses windows (a word between two spaces) with both dictionaries of a model, equal windows once."""

    def __init__(self, model: Model):
        import zstandard

        def compressor(content: bytes):
            # a deep search, so that the longest match in the dictionary is found
            params = zstandard.ZstdCompressionParameters(
                window_log=18, chain_log=17, hash_log=15, search_log=SEARCH_LOG, min_match=MIN_MATCH, target_length=64,
                strategy=STRATEGY, write_content_size=False, write_checksum=False, write_dict_id=False)
            if not content:
                return zstandard.ZstdCompressor(compression_params=params)
            held = zstandard.ZstdCompressionDict(widened(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            return zstandard.ZstdCompressor(dict_data=held, compression_params=params)

        self.compressors = compressor(model.ordinary), compressor(model.toxic + model.ordinary)
        self.weights = model.weights
        self.known: dict[bytes, float] = {}

    def savings(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window, against the ordinary one."""
        import zstandard

        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) * _WIDE.shape[1]
        spans = np.column_stack([np.cumsum(sizes) - sizes, sizes]).astype(np.uint64).tobytes()
        data = widened(b"".join(parts))
        lengths = []
        for c in self.compressors:
            done = c.multi_compress_to_buffer(zstandard.BufferWithSegments(data, spans), threads=0)
            lengths.append(np.fromiter((len(x) for x in done), np.int64, len(parts)))
        return lengths[0] - lengths[1]

    def features(self, texts: pa.Array) -> np.ndarray:
        """(largest saving of a window, windows saved ``STRONG`` bytes or more, all windows) of each text."""
        # the words that training sees: runs of letters in lower case, whatever signs are attached to them
        plain = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\pL]+", " ")
        raw = plain.cast(pa.large_binary()).fill_null(b"")
        at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        body = raw.buffers()[2]
        data = np.frombuffer(body, np.uint8)[at[0]:at[-1]] if body is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        out = np.zeros((len(texts), 3))
        inside = data != ord(" ")
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[at[at < len(data)]] |= inside[at[at < len(data)]]
        begins = np.flatnonzero(begins)
        if not len(begins):
            return out
        owner = np.searchsorted(at, begins, "right") - 1
        place = np.cumsum(inside) - 1
        data = np.ascontiguousarray(data[inside])
        ends = np.append(place[begins], len(data)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        spans = np.frombuffer(column.dictionary.buffers()[1], np.int64)[:len(column.dictionary) + 1].tolist()
        held = bytes(column.dictionary.buffers()[2])
        distinct = [held[i:j] for i, j in pairwise(spans)]
        if len(self.known) > KNOWN_WINDOWS:
            self.known.clear()
        known = self.known
        missing = [w for w in distinct if w not in known]
        if missing:
            known.update(zip(missing, self.savings([b" " + w + b" " for w in missing]).tolist(), strict=True))
        saved = np.fromiter((known[w] for w in distinct), np.float64, len(distinct))[column.indices.to_numpy(zero_copy_only=False)]
        np.maximum.at(out[:, 0], owner, saved)
        out[:, 1] = np.bincount(owner[saved >= STRONG], minlength=len(texts))
        out[:, 2] = np.bincount(owner, minlength=len(texts))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_curve(features) @ np.array(self.weights), -30, 30)))


def _surprise(toxic: int, ordinary: int, share: float) -> float:
    """Log-likelihood ratio of toxic and ordinary counts against the share of toxic text."""
    total = toxic + ordinary
    return toxic * math.log(toxic / (total * share)) + (ordinary * math.log(ordinary / (total * (1 - share))) if ordinary else 0.0)


def _beginnings(word: str) -> list[str]:
    """What of a word may be evidence: its beginnings, or the whole of a short word with the space behind it."""
    return [word[:m] for m in STEM_CHARS if len(word) >= m] or [word + " "]


def _evidence(split: list[Counter], labels: list[int]) -> tuple[set[str], Counter]:
    """Beginnings that speak for toxic text, and in how many toxic texts each beginning is that was looked at.

    Only absolute counts are tested, so a family of words of a small language passes with
    a few texts.  A text counts ``TEXT_COUNT`` times at most for a beginning.
    """
    seen, held = {0: Counter(), 1: Counter()}, Counter()
    said = {c: max(1, sum(min(k, TEXT_COUNT) for ws, y in zip(split, labels, strict=True) if y == c for k in ws.values())) for c in (0, 1)}

    def add(c: int, only: set[str] | None = None) -> None:
        for ws, y in zip(split, labels, strict=True):
            if y == c:
                found = Counter()
                for w, k in ws.items():
                    for s in _beginnings(w):
                        if only is None or s in only:
                            found[s] += k
                if only is None:
                    held.update(found.keys())
                seen[c].update({s: min(k, TEXT_COUNT) for s, k in found.items()})

    add(1)
    common = {s for s, k in held.items() if k >= EVIDENCE_TEXTS}
    add(0, common)
    # and not by chance: the more beginnings are looked at, the more surprising it has to be
    surprise = math.log(max(2, len(common))) + EVIDENCE_MARGIN
    strong = {s for s in common if seen[1][s] / said[1] >= EVIDENCE_RATIO * (seen[0][s] + 0.5) / said[0]
              and _surprise(seen[1][s], seen[0][s], said[1] / (said[0] + said[1])) >= surprise}
    return strong, Counter({s: held[s] for s in common})


def _distinct(texts: list[str]) -> list[int]:
    """Texts but for copies and most near copies, whose words would pass for common ones: no two share a smallest shingle hash."""
    seen: set[int] = set()
    kept = []
    for k, t in enumerate(texts):
        ws = t.lower().split()
        hashes = [zlib.crc32(" ".join(ws[i:i + 4]).encode()) for i in range(max(1, len(ws) - 3))]
        marks = {min(hashes), max(hashes)}
        if not marks & seen:
            kept.append(k)
        seen |= marks
    return kept


def _stem(word: str, strong: set[str], count: Counter) -> str:
    """The longest beginning that still is in half the toxic texts that have the shortest one that speaks for toxic text."""
    said = [s for s in _beginnings(word) if s in strong]
    return max((s for s in said if 2 * count[s] >= count[said[0]]), key=len, default="")


def _words(text: str) -> list[str]:
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def learn(texts: list[str], labels: list[int]) -> Model:
    """Dictionaries of all the texts; calibrated on a third of them (every third) with dictionaries of the others."""
    first = _distinct(texts)
    texts, labels = [texts[k] for k in first], [labels[k] for k in first]
    fit, rest = [k for k in range(len(texts)) if k % 3 != 2], range(2, len(texts), 3)
    if len({labels[k] for k in fit}) < 2:
        return Model(b"", b"", NOTHING)
    toxic, ordinary = dictionaries([texts[k] for k in fit], [labels[k] for k in fit])
    x = Scorer(Model(toxic, ordinary, NOTHING)).features(pa.array([texts[k] for k in rest], pa.string()))
    weights = calibrate(x, np.array([labels[k] for k in rest]))
    return Model(*dictionaries(texts, labels), weights)


def dictionaries(texts: list[str], labels: list[int]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary."""
    import zstandard

    vocabulary: dict[str, str] = {}  # each word once, however many texts have it
    split = [Counter(vocabulary.setdefault(w, w) for w in _words(t)) for t in texts]
    strong, held = _evidence(split, labels)
    marked = [sorted({_stem(w, strong, held) for w in ws} - {""}) for ws in split]
    whole = Counter(w for ws, y in zip(split, labels, strict=True) if y == 1 for w in ws)
    closed = {s for s, k in held.items() if 10 * whole[s] >= 8 * k}
    marked = [[f" {s} " if s in closed else f" {s}" for s in ws] for ws in marked]

    def trained(samples: list[bytes], size: int) -> bytes:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples for the trainer: their end is the dictionary
            return b"".join(samples)[-size:]

    ordinary = [w.encode() for t, y in zip(texts, labels, strict=True) if y == 0 for w in _pieces(t.lower())]
    forms = Counter({f" {w} ": whole[w] for w in whole if whole[w] >= 2 and not strong.isdisjoint(_beginnings(w))})
    words = Counter(w for ws, y in zip(marked, labels, strict=True) if y == 1 for w in ws) | forms
    toxic = "\n".join(sorted(words, key=lambda w: (words[w], w))).encode()[-DICT_BYTES:] + b"\n"
    # ordinary text that comes closest: what a toxic word shares with ordinary words must cost the same
    plain = " " + "  ".join(sorted({w for ws, y in zip(split, labels, strict=True) if y == 0 for w in ws})) + " "

    def usual(part: str) -> bool:
        if part[0] == " " and part[1:] in strong:  # a beginning that is evidence, though some ordinary words have it
            return False
        return plain.find(part, plain.find(part) + 1) > 0 if part in plain else False

    near = set()
    for w in sorted(words):
        reach = 0
        for i in range(len(w) - 1):
            j = max(reach, i + 1)
            while j < len(w) and usual(w[i:j + 1]):
                j += 1
            if j > reach:
                near.add(w[i:j])
            reach = j
    shared = "\n".join(sorted(near)).encode()
    learned = trained(["\n".join(ws).encode() for ws, y in zip(marked, labels, strict=True) if y == 1 and ws], DICT_BYTES // 4)
    return learned + toxic, trained(ordinary[:40_000], DICT_BYTES) + shared


def _curve(x: np.ndarray) -> np.ndarray:
    """The largest saving, the number of strong windows, and their share, which tells chance finds in long texts."""
    return np.column_stack([np.ones(len(x)), np.minimum(x[:, 0], 40) / 4, np.log1p(x[:, 1]), np.log1p(100 * x[:, 1] / (x[:, 2] + SHARE_WINDOWS))])


def _pieces(text: str) -> Iterator[str]:
    for i in range(0, len(text), 400):
        yield text[i:i + 400]


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge, then shifted so that ``THRESHOLD`` is where errors are fewest."""
    z = _curve(x)
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (y - p) - 0.05 * w)
    s = z @ w
    order = np.argsort(s)
    ys = y[order]
    errors = np.concatenate([[np.sum(ys == 0)], np.sum(ys == 0) + np.cumsum(np.where(ys == 1, 1, -1))])
    edges = np.concatenate([[s[order][0] - 1], (s[order][1:] + s[order][:-1]) / 2, [s[order][-1] + 1]])
    same = np.concatenate([[False], s[order][1:] == s[order][:-1], [False]])
    best = edges[np.argmin(np.where(same, len(s) + 1, errors))]
    w[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - best
    return tuple(float(v) for v in w)


def shares(counts: list[int], n: int) -> list[int]:
    """How many to take of each group, ``n`` together: as many of each as of the others, or all of it."""
    taken, left = [0] * len(counts), n
    for done, k in enumerate(sorted(range(len(counts)), key=lambda k: counts[k])):
        taken[k] = min(counts[k], left // (len(counts) - done))
        left -= taken[k]
    return taken


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, group: str | None = None) -> tuple[list[str], list[int]]:
    """A bounded sample of texts and labels: keys of each class by hash order, then those texts that are not too long.

    With a ``group`` column of the documents, the groups (the rarest beyond ``GROUPS`` as one) have equal shares.
    """
    texts, found = [], []
    # a key labelled both ways speaks for neither class
    labels = (labels.where(F.col(label).cast("int").isin(0, 1)).groupBy(key).agg(F.min(F.col(label).cast("int")).alias("_y"), F.max(F.col(label).cast("int")).alias("_z"))
              .where("_y = _z").select(key, "_y"))
    if group is not None:  # keys and groups alone are joined, not texts
        labels = stored(labels.join(docs.select(key, F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_group")), key), "toxicity-labels")
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        rows = labels.where(F.col("_y") == y)
        if group is None:
            keys = first_keys(rows, key, n)
        else:
            counts = [(r["_group"], r["count"]) for r in rows.groupBy("_group").count().orderBy(F.desc("count"), "_group").limit(GROUPS).collect()]
            names = [name for name, _ in counts]
            parts = [rows.where(F.col("_group") == name) for name in names]
            sizes = [size for _, size in counts]
            if len(counts) == GROUPS:
                parts.append(rows.where(~F.col("_group").isin(names)))
                sizes.append(parts[-1].count())
            keys = reduce(DataFrame.unionAll, [first_keys(p, key, m) for p, m in zip(parts, shares(sizes, n), strict=True)], first_keys(rows, key, 0))
        some = having(docs, key, keys).where(F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS)) \
            .groupBy(F.col(key).alias("k")).agg(F.min(text).alias("t")).collect()
        texts += [r.t for r in sorted(some, key=lambda r: (r.k, r.t))]
        found += [y] * len(some)
    return texts, found


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, max_saving, strong_windows) of every whole text."""
    ship(docs.sparkSession)
    kind = docs.select(F.col(key).cast("bigint").alias(key)).schema[key].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for i, j in slices(batch.column(1)):
                x = scorer.features(batch.column(1).slice(i, j - i))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(scorer.scores(x)), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                                 [key, "score", "max_saving", "strong_windows"])

    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("_t")).mapInArrow(
        scored, f"`{key}` {kind}, score double, max_saving double, strong_windows double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that score below the threshold; nothing is shuffled."""
    ship(docs.sparkSession)
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for i, j in slices(batch.column(place)):
                part = batch.slice(i, j - i)
                yield part.filter(pa.array(scorer.scores(scorer.features(part.column(place))) < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
