import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from basketry.llm import queries, token_alignment

from .helpers import EDGE_TEXTS, MIDDLE, SMALL, edge_documents, empty_documents, rows

PATHS = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD = ["a  b", " x\n", "x \n y", "\n\n", "\nNext line\nand", "word. \nword", "a▁b", "<s> </s> <unk> <0x41>", "tab\tx\n\ty", "  lead", "trail  ", "é\nà b", "a\x00b c",
       " x 　y ﬁ", "x" * 900 + " y", "日本 語\nです"]


def whole_text(texts):
    """(a ids, b ids, byte ends of a and of b) of whole texts, or None, straight from the libraries."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(x): x for x in printed} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printed)}
    tokens = {i: bytes(chars[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    for text in texts:
        if not text:
            yield None
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        said = [tokens[i] for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if any(b"".join(s) != (" " + text).encode() for s in said):
            yield None
        else:
            yield *ids, *[np.cumsum([len(t) for t in s]).tolist() for s in said]


def brute(docs):
    aligned = list(whole_text([t for _, t in docs]))
    links, counts = [], Counter()
    for x in aligned:
        here = []
        if x:
            for i, end in enumerate(x[2]):
                begin = x[2][i - 1] if i else 0
                lo, hi = bisect_right(x[3], begin), bisect_left(x[3], end)
                here += [(x[0][i], x[1][j]) for j in range(lo, hi + 1)]
        links.append(here)
        counts.update(set(here))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for (key, _), x, here in zip(docs, aligned, links, strict=True):
        if not x:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        both = sorted(set(x[2]) & set(x[3]))
        groups, i, j = [], 0, 0
        for end in both:
            u, v = x[2].index(end, i) + 1, x[3].index(end, j) + 1
            groups.append(",".join(map(str, x[0][i:u])) + "|" + ",".join(map(str, x[1][j:v])))
            i, j = u, v
        out.append((key, len(x[0]), len(x[1]), len(both), len(here), sum(counts[p] == top[p[0]] for p in here), sum(counts[p] for p in here),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_given_tables(spark, folder):
    docs = rows(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    assert sorted(rows(queries.op13_token_alignment(spark, folder)), key=str) == brute(docs)


def test_edge_cases(spark):
    docs = edge_documents(spark)
    assert sorted(rows(token_alignment.align_corpus(docs, *PATHS)), key=str) == brute(rows(docs.select("doc_id", "text")))
    odd = list(enumerate([*ODD, *EDGE_TEXTS]))
    got = rows(token_alignment.align_corpus(spark.createDataFrame(odd, "doc_id long, text string"), *PATHS))
    assert sorted(got, key=str) == brute(odd) and sum(not r[-1] for r in got) == 3
    assert rows(token_alignment.align_corpus(empty_documents(spark), *PATHS)) == []


def test_many_runs_levels_and_frames(spark, monkeypatch):
    """Runs of a few records, merged two at a time, give the counts of one run."""
    docs = rows(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))[:60]
    want = brute(docs)
    held = [np.arange(k, 50_000, k + 1, dtype=np.uint64) for k in range(5)]
    stretches = list(token_alignment.merged([token_alignment.write_pairs(x, np.full(len(x), k + 1)) for k, x in enumerate(held)]))
    keys, counts = (np.concatenate([s[c] for s in stretches]) for c in (0, 1))
    expected = Counter()
    for k, x in enumerate(held):
        expected.update(dict.fromkeys(x.tolist(), k + 1))
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == expected and keys.tolist() == sorted(keys.tolist())
    monkeypatch.setattr(token_alignment, "MERGE", 2)
    spread = spark.createDataFrame(docs, "doc_id long, text string").repartition(13)
    assert sorted(rows(token_alignment.align_corpus(spread, *PATHS)), key=str) == want


def test_small_slices_in_one_task():
    """Texts aligned a few at a time, from a warm memory, are aligned as whole ones."""
    import pyarrow as pa
    tool = token_alignment.Aligner(*PATHS)
    texts = [t for t in [*ODD, *EDGE_TEXTS] if t]
    one = tool.align(pa.array(texts))
    for _ in range(2):
        parts = [tool.align(pa.array(texts[k:k + 3])) for k in range(0, len(texts), 3)]
        assert [d for p in parts for d in p[1]] == one[1]
        assert np.concatenate([p[2] for p in parts]).tolist() == one[2].tolist()


def test_a_full_memory_changes_nothing(monkeypatch):
    import pyarrow as pa
    texts = [t for t in [*ODD, *EDGE_TEXTS, *ODD] if t]
    one = token_alignment.Aligner(*PATHS).align(pa.array(texts))
    monkeypatch.setattr(token_alignment, "KNOWN_PARTS", 40)
    tool = token_alignment.Aligner(*PATHS)
    parts = [tool.align(pa.array(texts[k:k + 2])) for k in range(0, len(texts), 2)]
    assert [d for p in parts for d in p[1]] == one[1] and len(tool.known) == 40 <= tool.kept
    assert np.concatenate([p[2] for p in parts]).tolist() == one[2].tolist()
