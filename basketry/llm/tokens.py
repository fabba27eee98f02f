"""Token ids of whole texts, with each distinct piece of text encoded only once.

The tokenizers library does every encoding.  Some vocabularies (an encoder tries its own) never
let a token cross certain places (a single space or newline between two visible
characters, a full stop or comma after a letter), so a text may be cut there and
the ids of the parts put together again.  Most parts are words that were seen
before: Arrow's dictionary encoding finds the distinct ones of a slice, a cache in
the worker holds their ids, and NumPy strings the ids together.  A place that is
not surely such a boundary is not cut, which costs time but never changes ids.
"""

from __future__ import annotations

import os
from itertools import chain, pairwise
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once (a longer single text is one slice).
SLICE_BYTES = 4 << 20
#: Bounds of a worker's cache of encoded parts: once full, further parts are encoded but not remembered.
CACHE_PARTS = 500_000
CACHED_BYTES = 48

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xCA] = True  # first bytes of two-byte Latin letters
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[ord("A"):ord("Z") + 1] = True
_MARKS = np.zeros(256, bool)
_MARKS[[0x20, 0x0A, 0x2E, 0x2C]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

#: Byte-level BPE writes each byte as a character: printable ones as themselves, the others, in order, from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


#: Texts that an encoder tries when it is made: cut into parts they must give the ids of the whole texts.
PROBES = ["Hello world, a b.c d", "It's the end. Ab cd,ef gh!", "line\nnext Line\nOf text", "É là, ça va ñandú. ÜBER größe", "x=1,2 (y) 3.5 A.B", "UPPER lower"]


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where surely a token boundary is, and the positions of those that are spaces between words."""
    n = len(data)
    if n < 3:
        return np.zeros(n, bool), np.zeros(0, np.int64)
    at = np.flatnonzero(_MARKS[data[1:-1]]) + 1
    mark, before, after = data[at], data[at - 1], data[at + 1]
    tail = (before & 0xC0) == 0x80
    second = data[np.maximum(at - 2, 0)]
    between = (_VISIBLE[before] | (tail & _LEAD[second])) & (_VISIBLE[after] | _LEAD[after])
    space = between & (mark == 0x20)
    line = between & (mark == 0x0A)
    # letters before a full stop or comma: A-Z, or two bytes after 0xC3 but for the multiplication and division signs
    letter = _LETTER[before] | (tail & (second == 0xC3) & (before != 0x97) & (before != 0xB7))
    stop = letter & ((mark == 0x2E) | (mark == 0x2C))
    cut = np.zeros(n, bool)
    cut[at[space | line | stop]] = True
    cut[at[line] + 1] = True
    return cut, at[space]


class Encoder:
    """Encodes lists of texts; ``folds_case``: the tokenizer ignores case and white space."""

    def __init__(self, path: str, folds_case: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.folds_case = folds_case
        self._reset()
        ids, at = self._by_parts(pa.array(PROBES))
        plain = [e.ids for e in self.tokenizer.encode_batch_fast(PROBES, add_special_tokens=False)]
        #: whether texts may be cut: for other kinds of tokenizers, whole texts are encoded
        self.may_cut = [ids[i:j].tolist() for i, j in pairwise(at.tolist())] == plain
        self._reset()

    def _word(self, part: bytes) -> list[int] | None:
        """Ids of a part that is one plain word, straight from the library's BPE model; None: not so plain."""
        text = part.decode("utf-8", "replace")
        word = text if self.folds_case or text[:1] != " " else text[1:]
        if not word.isalpha() or not is_normalized("NFC", word) or self.folds_case and word != word.lower():
            return None
        return [t.id for t in self.tokenizer.model.tokenize(part.decode("latin-1").translate(_BYTE_LEVEL))]

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.offsets = np.zeros(1 << 14, np.int64)
        self.parts = 0

    def _add(self, parts: list[bytes]) -> None:
        """Encode new parts; they get the next numbers."""
        lists = [self._word(p) for p in parts]
        rest = [k for k, x in enumerate(lists) if x is None]
        found = self.tokenizer.encode_batch_fast([parts[k].decode("utf-8", "replace") for k in rest], add_special_tokens=False)
        for k, e in zip(rest, found, strict=True):
            lists[k] = e.ids
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        begin = int(self.offsets[self.parts])
        end = begin + int(sizes.sum())
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.parts + len(parts) + 1 > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        self.ids[begin:end] = np.fromiter(chain.from_iterable(lists), np.uint32, end - begin)
        self.offsets[self.parts + 1:self.parts + 1 + len(parts)] = begin + np.cumsum(sizes)
        for k, p in enumerate(parts):
            if self.parts + k < CACHE_PARTS and len(p) <= CACHED_BYTES:
                self.known[p] = self.parts + k
        self.parts += len(parts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none) one after another, and where each text's ids begin (one more than texts).

        A text that holds the string of a special token, in whatever case, is encoded whole: there the string is that token.
        """
        whole = np.ones(len(texts), bool) if not self.may_cut else np.zeros(len(texts), bool)
        for name in self.special:
            whole |= pc.fill_null(pc.match_substring(texts, name, ignore_case=True), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_parts(texts)
        ids, at = self._by_parts(pc.if_else(pa.array(~whole), texts, pa.scalar("", texts.type)))
        lists = [ids[i:j] for i, j in pairwise(at.tolist())]
        places = np.flatnonzero(whole).tolist()
        found = self.tokenizer.encode_batch_fast([texts[k].as_py() or "" for k in places], add_special_tokens=False)
        for k, e in zip(places, found, strict=True):
            lists[k] = np.array(e.ids, np.uint32)
        return np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])

    def _by_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        self.parts = min(self.parts, CACHE_PARTS)  # what came after was not remembered
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        cut, space = cuts(data)
        cut[at[at < len(data)]] = True
        begins = np.append(np.flatnonzero(cut), len(data))
        first = np.searchsorted(begins, at)
        if self.folds_case:  # the space before a word and the case of A-Z make no difference
            keep = np.ones(len(data), bool)
            keep[space] = False
            gone = np.zeros(len(begins), np.int64)
            np.cumsum(~keep[begins[:-1]], out=gone[1:])
            data, begins = _LOWER[data[keep]], begins - gone
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        ends = np.frombuffer(coded.dictionary.buffers()[1], np.int64)[:len(coded.dictionary) + 1].tolist()
        held = bytes(coded.dictionary.buffers()[2] or b"")
        distinct = [held[i:j] for i, j in pairwise(ends)]
        known = self.known
        number = np.fromiter((known.get(p, -1) for p in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            number[missing] = self.parts + np.arange(len(missing))
            self._add([distinct[k] for k in missing.tolist()])
        number = number[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.offsets[number + 1] - self.offsets[number]
        ends = np.zeros(len(number) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        take = np.repeat(self.offsets[number] - ends[:-1], sizes)
        take += np.arange(ends[-1])
        return self.ids[take], ends[first]


def id_bytes(path: str, *ids: int) -> int:
    """Bytes that every id of a tokenizer file, and some others, fit in: two or four."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    most = max([tokenizer.get_vocab_size() - 1, *tokenizer.get_added_tokens_decoder(), *tokenizer.get_vocab().values(), *ids])
    return 2 if most < 1 << 16 else 4


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, folds_case: bool) -> Encoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    if (path, folds_case) not in _encoders:
        _encoders[path, folds_case] = Encoder(path, folds_case)
    return _encoders[path, folds_case]


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(from, to) row ranges of a string column, each of ``limit`` bytes at most or of one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for k, s in enumerate(sizes.tolist()):
        if total and total + s > limit:
            yield begin, k
            begin, total = k, 0
        total += s
    if begin < len(sizes):
        yield begin, len(sizes)
