"""Language by cross-parsing entropy over suffix automata.

For each language a suffix automaton of labelled text is built.  A text is parsed
against it into phrases, each the longest run that the labelled text contains; the
language with the fewest phrases per letter, weighed by the log of the size of its
text, wins.  An automaton becomes a dense table, and whole batches of texts are parsed
one letter at a time for all of them and all languages at once.

Letters are lower-cased; everything that is no letter is white space, and runs of it
count once.  Texts are parsed in stretches of ``STRETCH`` letters side by side, which
adds at most one phrase each.

Defined cases: a null or empty text, or one without letters, is ``und`` with score 0;
rows without a label, text or letter are not learned from; repeated rows are judged
each on their own; equal languages go to the first by name; without any labelled text
every text is ``und``; keys may be null or tie; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship
from .tokens import slices

#: Bounds of the labelled sample: texts of a language (by hash order of the key), their first characters, letters of a language
#: (of all its texts, in equal shares), cells of all languages' tables before states are doubled, and letters told apart.
SAMPLE_TEXTS = 60
SAMPLE_CHARS = 2_000
TRAIN_LETTERS = 16_000
ALL_CELLS = 32_000_000
ALPHABET = 250
STRETCH = 384
UNKNOWN = "und"
#: A text of an unknown language needs this many times the phrases per letter of the labelled texts left out.
STRANGE = 2.5

SPACE, OTHER = 0, 1  # symbols before the alphabet's


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    letters: tuple[int, ...]        # code points (lower case) of symbols 2, 3, ...
    table: np.ndarray               # next state, times four, plus the phrases that end (an unknown letter is one itself)
    roots: tuple[int, ...]
    weights: tuple[float, ...]      # log2 of each language's letters
    usual: float                    # phrases per letter, so weighed, of labelled texts left out


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


def _lower_points() -> tuple[np.ndarray, np.ndarray]:
    """For code points below 0x10000: lower case, and whether a letter."""
    chars = [chr(c) for c in range(0x10000)]
    lower = np.array([ord(x) if len(x := c.lower()) == 1 else k for k, c in enumerate(chars)], np.uint32)
    return lower, np.array([c.isalpha() for c in chars])


_points: list[tuple[np.ndarray, np.ndarray]] = []


def symbol_map(letters: tuple[int, ...]) -> np.ndarray:
    """Symbol of every code point below 0x10000; rarer letters are ``OTHER``."""
    if not _points:
        _points.append(_lower_points())
    lower, alpha = _points[0]
    out = np.where(alpha, OTHER, SPACE).astype(np.uint8)
    own = np.zeros(0x10000, np.uint8)
    for k, c in enumerate(letters):
        own[c] = k + 2
    return np.where(alpha & (own[lower] > 0), own[lower], out)


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts end to end, runs of white space as one and none in front, and where each text begins (one more than texts)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    s = table[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):  # letters there are rare ones; signs and pictures are none
        values, which = np.unique(points[far], return_inverse=True)
        s[far] = np.array([OTHER if chr(v).isalpha() else SPACE for v in values.tolist()], np.uint8)[which]
    at = np.concatenate([[0], np.cumsum(sizes)])
    blank = s == SPACE
    drop = np.zeros(len(s), bool)
    drop[1:] = blank[1:] & blank[:-1]
    starts = at[:-1][at[:-1] < len(s)]
    drop[starts] = blank[starts]
    left = np.concatenate([[0], np.cumsum(~drop)])
    return s[~drop], left[at]


def common_letters(samples: list[list[str]]) -> tuple[int, ...]:
    """The letters of the alphabet: the languages' most common ones in turn, so that each script has its share."""
    ranked = [[c for c, _ in sorted(Counter(c for t in texts for c in t.lower() if c.isalpha() and ord(c) < 0x10000).items(), key=lambda x: (-x[1], x[0]))]
              for texts in samples]
    found = dict.fromkeys(c for row in zip_longest(*ranked) for c in row if c is not None)
    return tuple(ord(c) for c in list(found)[:ALPHABET])


def spread(texts: list[list[int]], most: int) -> list[list[int]]:
    """The texts cut so that all of them together have ``most`` symbols: shorter ones whole, what they leave for the longer ones."""
    out: list[list[int]] = [[]] * len(texts)
    for done, k in enumerate(sorted(range(len(texts)), key=lambda k: len(texts[k]))):
        out[k] = texts[k][:most // (len(texts) - done)]
        most -= len(out[k])
    return out


def build(samples: dict[str, list[str]]) -> Model:
    """Automata from three quarters of each language's texts; the rest says how many phrases are usual."""
    names = sorted(samples)
    letters = common_letters([samples[name] for name in names])
    mapped, width = symbol_map(letters), len(letters) + 3  # the last column ends a stretch
    most = min(TRAIN_LETTERS, ALL_CELLS // (max(1, len(names)) * width))
    rows, roots, weights, left_out = [], [], [], []
    for name in names:
        fit = [t for k, t in enumerate(samples[name]) if k % 4 != 3] or samples[name]
        left_out += [(name, t) for k, t in enumerate(samples[name]) if k % 4 == 3]
        learned = [c for t in spread([symbols([t], mapped)[0].tolist() for t in fit], most - len(fit)) for c in (*t, width - 1)]
        go = automaton(learned)
        root = sum(map(len, rows))
        block = np.zeros((len(go), width), np.int64)
        start = np.full(width, root, np.int64)
        for c, q in go[0].items():
            if c < width - 1 and c != OTHER:
                start[c] = root + q
        block[:] = 4 * start + 1 + (start == root)
        block[0] = 4 * start + (start == root)
        for p, to in enumerate(go):
            for c, q in to.items():
                if c < width - 1 and c != OTHER:
                    block[p, c] = 4 * (root + q)
        block[:, width - 1] = 4 * root + 1
        block[0, width - 1] = 4 * root
        rows.append(block)
        roots.append(root)
        weights.append(float(np.log2(max(2, len(learned)))))
    table = np.concatenate(rows).astype(np.int32) if rows else np.zeros((0, width), np.int32)
    model = Model(tuple(names), letters, table, tuple(roots), tuple(weights), float("inf"))
    if not left_out:
        return model
    rates, n = parse(model, [t for _, t in left_out], mapped)
    return Model(*list(vars(model).values())[:-1], float(np.median(rates.min(axis=1))))


def parse(model: Model, texts: list[str], mapped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrases per letter weighed by log size, text by language; letters of each text)."""
    width, many = model.table.shape[1], len(model.languages)
    s, at = symbols(texts, mapped)
    n = np.diff(at)
    pieces = -(-n // STRETCH)
    owner = np.repeat(np.arange(len(texts)), pieces)
    if not len(owner) or not many:
        return np.full((len(texts), max(1, many)), np.inf), np.zeros(len(texts), np.int64)
    begin = at[:-1][owner] + STRETCH * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(at[1:][owner] - begin, STRETCH)
    order = np.argsort(-size, kind="stable")  # longest first: those at their end drop off behind
    begin, size, owner = begin[order], size[order], owner[order]
    flat = model.table.reshape(-1)
    phrases = np.zeros((many, len(owner)), np.int32)
    roots = np.array(model.roots, np.int64)[:, None]
    state = np.repeat(roots, len(owner), axis=1)
    live = len(owner)
    for step in range(int(size[0])):
        live = int(np.searchsorted(-size[:live], -step, "left"))
        code = s[begin[:live] + step]
        found = flat[state[:, :live] * width + code]
        phrases[:, :live] += found & 3
        state[:, :live] = found >> 2
    phrases += state != roots
    total = np.zeros((len(texts), many))
    for k in range(many):
        total[:, k] = np.bincount(owner, phrases[k], len(texts))
    letters = np.bincount(np.repeat(np.arange(len(texts)), n)[s != SPACE], minlength=len(texts)) if len(s) else np.zeros(len(texts), np.int64)
    return total * np.array(model.weights) / np.maximum(n, 1)[:, None], letters


def sample(docs: DataFrame, key: str, text: str, label: str) -> dict[str, list[str]]:
    """Bounded samples of labelled texts by language: keys by hash order, then the beginnings of those texts."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0)) \
        .select(F.col(key).alias("k"), F.col(label).cast("string").alias("l"), F.substring(text, 1, SAMPLE_CHARS).alias("t")) \
        .withColumn("h", F.xxhash64("k"))
    # the limit is pushed below the shuffle, so that each task sends a few texts of a language
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "k", "t"))).where(F.col("r") <= SAMPLE_TEXTS)
    out: dict[str, list[str]] = {}
    for r in best.orderBy("l", "r").collect():
        out.setdefault(r.l, []).append(r.t)
    return out


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, strange): language, its lead over the next (0 to 1), and whether no language fits the text."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)  # bounded by ALL_CELLS

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        mapped = symbol_map(m.letters)
        for batch in batches:
            for i, j in slices(batch.column(1), 4 << 20):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                rates, letters = parse(m, texts, mapped)
                best = rates.argmin(axis=1)
                low = rates.min(axis=1)
                second = np.partition(rates, 1, axis=1)[:, 1] if rates.shape[1] > 1 else np.full(len(texts), np.inf)
                with np.errstate(invalid="ignore", divide="ignore"):
                    lead = np.where(np.isinf(second), 1.0, 1 - low / second)
                known = (letters > 0) & bool(m.languages)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.array([m.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], pa.string()),
                     pa.array(np.where(known, np.clip(np.nan_to_num(lead), 0, 1), 0.0)), pa.array(known & (low > STRANGE * m.usual))],
                    [key, "lang_pred", "score", "strange"])

    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("_t")).mapInArrow(
        judged, f"`{key}` bigint, lang_pred string, score double, strange boolean")


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents, with all their columns, whose language is known and fits them; nothing is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        mapped = symbol_map(m.letters)
        for batch in batches:
            for i, j in slices(batch.column(place), 4 << 20):
                part = batch.slice(i, j - i)
                rates, letters = parse(m, [t or "" for t in part.column(place).to_pylist()], mapped)
                keep = (letters > 0) & (rates.min(axis=1) <= STRANGE * m.usual) & bool(m.languages)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(known, docs.schema)
