import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from basketry.llm import common, queries, token_files
from basketry.llm.tokens import Encoder, slices

from .helpers import EDGE_TEXTS, MIDDLE, edge_documents, empty_documents, rows


def plain(name):
    return Tokenizer.from_file(queries.tokenizer_path(name))


@pytest.mark.parametrize("name,folds", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_cached_parts_give_the_ids_of_whole_texts(spark, name, folds):
    odd = ["a  b", " x\n", "it's. a's,b ", "é.à ,", "a\n\nb\n c", "  a  ", "×. ÷,", "a.b,c 1.2,3", "'s. 'll, we're.", "!!.", "a. , b", ".\n,",
           "hello <|endoftext|> world", "A <|ENDOFTEXT|> B", "<|startoftext|>x<|endoftext|>", "<|endoftext|>" * 3 + " a.b"]
    texts = EDGE_TEXTS + odd + [r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("text").collect()]
    encoder = Encoder(queries.tokenizer_path(name), folds)
    column = pa.array(texts, pa.string())
    want = [e.ids for e in plain(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # cold and from the cache
        got = []
        for i, j in slices(column, 200_000):
            ids, at = encoder.encode(column[i:j])
            got += [ids[at[k]:at[k + 1]].tolist() for k in range(j - i)]
        assert got == want


def expected(docs, tokenizer):
    """(doc_id, start, n, crc) by encoding text after text in order of the key, ties by their ids."""
    out, start = [], 0
    listed = [(r.doc_id, np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")) for r in docs.collect()]
    for key, ids in sorted(listed, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]))):
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_edge_texts_and_middle_table(spark):
    for docs in (edge_documents(spark), spark.read.parquet(f"{MIDDLE}/documents.parquet")):
        got = rows(token_files.token_digest(docs, queries.tokenizer_path("word_bpe_49k.json")))
        order = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(got, key=order) == sorted(expected(docs, plain("word_bpe_49k.json")), key=order)


def test_short_document_access_and_dictionary(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    folder = common.shared_path(spark, "test-tokens")
    token_files.write_token_files(docs, folder, queries.tokenizer_path("word_bpe_49k.json"), 1)
    held = spark.read.parquet(f"{folder}/dictionary").first()
    assert held.content and token_files.dictionary_hash(bytes(held.content)) == held.dict_hash
    assert spark.read.parquet(f"{folder}/blocks").where(f"dict_hash != '{held.dict_hash}'").count() == 0
    one = token_files.read_tokens(spark, folder, 123, 124)
    got = {r.key: np.frombuffer(r.ids, "<u2").tolist() for r in one.collect()}
    text = {r.doc_id: r.text for r in docs.where("doc_id in (123, 124)").collect()}
    assert got == {k: [*plain("word_bpe_49k.json").encode(t or "", add_special_tokens=False).ids, 1] for k, t in text.items()}
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(last_key,123)" in plan


def test_empty_table(spark):
    assert rows(token_files.token_digest(empty_documents(spark), queries.tokenizer_path("word_bpe_49k.json"))) == []


def test_ids_that_do_not_fit_two_bytes(tmp_path):
    from basketry.llm.tokens import id_bytes
    from tokenizers import models
    assert [id_bytes(queries.tokenizer_path(n), 1) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")] == [2, 2]
    assert id_bytes(queries.tokenizer_path("byte_bpe_50k.json"), 70_000) == 4
    wide = Tokenizer(models.WordLevel({f"w{k}": k for k in range(70_000)}, "w0"))
    wide.save(str(tmp_path / "wide.json"))
    assert id_bytes(str(tmp_path / "wide.json")) == 4


def test_a_tokenizer_that_may_not_be_cut(tmp_path):
    from tokenizers import models, pre_tokenizers
    t = Tokenizer(models.WordLevel({"hello world": 1, "?": 0, "a": 2}, "?"))
    t.pre_tokenizer = pre_tokenizers.Split("|", "removed")
    t.save(str(tmp_path / "odd.json"))
    encoder = Encoder(str(tmp_path / "odd.json"), False)
    ids, at = encoder.encode(pa.array(["hello world", "hello world|a", None, "x"]))
    assert not encoder.may_cut and ids.tolist() == [1, 1, 2, 0] and at.tolist() == [0, 1, 3, 3, 4]


def test_samples_are_bounded_by_keys(spark):
    """Half of all rows have one key: the sample has as many keys as asked for, one text of each is collected."""
    docs = spark.range(20_000).selectExpr("if(id % 2 = 0, 7, id) AS doc_id", "concat('text ', id) AS text", "1 AS _key")
    assert common.first_keys(docs, "doc_id", 1024).count() == 1024
    sample = common.hash_sample(docs, docs, "doc_id", 1024)
    assert sample.columns == docs.columns and sample.select("doc_id").distinct().count() == 1024
    path = queries.tokenizer_path("word_bpe_49k.json")
    assert token_files.train_dictionary(docs, "doc_id", "text", path, True, 1, 2)
