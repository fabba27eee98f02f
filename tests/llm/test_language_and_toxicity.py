import zlib

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import compression_toxicity, cross_parsing, queries

from .helpers import EDGE_TEXTS, LARGE, MIDDLE, edge_documents, empty_documents, rows


def phrases(text, learned, letters):
    """Longest-match parse by searching the learned text, stretch by stretch."""
    def norm(s):
        out = ""
        for c in s.lower():
            c = c if c.isalpha() else " "
            if not (c == " " and (not out or out[-1] == " ")):
                out += c
        return out

    text, total = norm(text), 0
    n = len(text)
    for begin in range(0, n, cross_parsing.STRETCH):
        part, i = text[begin:begin + cross_parsing.STRETCH], 0
        while i < len(part):
            j = i
            while j < len(part) and part[i:j + 1] in learned and all(c == " " or c in letters for c in part[i:j + 1]):
                j += 1
            total += 1
            i = max(j, i + 1)
    return total, n


def test_parse_against_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").where("lang = 'en'").limit(12).collect()]
    model = cross_parsing.build({"en": [t[:700] for t in texts[:3]]})
    letters = {chr(c) for c in model.letters}
    mapped = cross_parsing.symbol_map(model.letters)
    learned = "|".join("".join(chr(model.letters[s - 2]) if s > 1 else " " for s in cross_parsing.symbols([t[:700]], mapped)[0]) for t in texts[:3])
    rates, _ = cross_parsing.parse(model, texts[4:8], mapped)
    for k, t in enumerate(texts[4:8]):
        total, n = phrases(t, learned, letters)
        assert rates[k, 0] == pytest.approx(total * model.weights[0] / n)


def test_held_out_languages(spark):
    got = queries.op6_cross_parsing(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_language_edge_cases(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = cross_parsing.build(cross_parsing.sample(docs, "doc_id", "text", "lang"))
    got = rows(cross_parsing.predict(edge_documents(spark), model).select("doc_id", "lang_pred", "score"))
    assert len(got) == len(EDGE_TEXTS) + 3
    for key, lang, score in got:
        text = EDGE_TEXTS[key] if key is not None else None
        if key is not None and not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
        else:
            assert lang in ("und", "en", "fr", "de", "es") and 0 <= score <= 1
    nothing = cross_parsing.build(cross_parsing.sample(empty_documents(spark), "doc_id", "text", "lang"))
    assert {r[1] for r in rows(cross_parsing.predict(edge_documents(spark), nothing))} == {"und"}
    assert rows(cross_parsing.predict(empty_documents(spark), model)) == []


def test_held_out_toxicity(spark):
    got = queries.op8_compression_toxicity(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").where("held_out").collect()
    caught = [r.predicted for r in got if r.toxic]
    alarms = [r.predicted for r in got if not r.toxic]
    assert len(caught) > 80 and sum(caught) >= 0.9 * len(caught) and sum(alarms) <= 0.01 * len(alarms)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_held_out_toxicity_of_every_language(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "lang")
    got = queries.op8_compression_toxicity(spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").join(docs, "doc_id").where("held_out").collect()
    for lang in (None, "en", "fr", "de", "es"):
        caught = [r.predicted for r in got if r.toxic == 1 and lang in (None, r.lang)]
        assert len(caught) > 10 and sum(caught) >= 0.9 * len(caught), lang


def test_signs_and_capitals_do_not_hide_a_word(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    scorer = compression_toxicity.Scorer(queries.toxicity_model(spark, docs, MIDDLE))
    bare, dressed = (scorer.features(pa.array([t])) for t in ("the idiot and réeuxch", "THE!! IDIOT!! AND!! (RÉEUXCH)###"))
    assert bare[0, 1] == 2 and np.array_equal(bare, dressed)


def test_rare_families_and_short_words_are_learned():
    rng = np.random.default_rng(5)
    syllables = ["ba", "co", "di", "fe", "gu", "lo", "mi", "na", "pe", "ru", "sa", "to"]
    said = lambda n: ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(n)]
    texts = [" ".join([*said(40), ["horrid", "xuq", "zw" + "ylkt" + said(1)[0]][0 if k % 40 > 1 else 1 if k % 40 else 2]] * 2) for k in range(600)]
    texts += [" ".join(said(41) * 2) for _ in range(2400)]
    scorer = compression_toxicity.Scorer(compression_toxicity.learn(texts, [1] * 600 + [0] * 2400))
    # one in forty toxic texts has the short word, one in forty a word of the family
    got = scorer.scores(scorer.features(pa.array([" ".join([*said(40), w] * 2) for w in ("horrid", "xuq", "zwylktbaco", "zwylktnaru", "bagu")])))
    assert np.array_equal(got >= compression_toxicity.THRESHOLD, [True, True, True, True, False])


def test_sample_is_balanced_over_groups(spark, monkeypatch):
    monkeypatch.setattr(compression_toxicity, "SAMPLE_TOXIC", 20)
    rows = [(k, ("es " if k % 20 == 0 else "en ") + str(k), "es" if k % 20 == 0 else "en", 1) for k in range(400)] + [(1000, "null", None, 1), (1001, "fine", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    texts, labels = compression_toxicity.sample(docs.drop("toxic"), docs.select("doc_id", "toxic"), "doc_id", "text", "toxic", "lang")
    assert labels.count(1) == 20 and labels.count(0) == 1 and "null" in texts and sum(t.startswith("es ") for t in texts) == 9


def test_toxicity_edge_cases(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = queries.toxicity_model(spark, docs, MIDDLE)
    got = rows(compression_toxicity.score(edge_documents(spark), model))
    assert len(got) == len(EDGE_TEXTS) + 3 and all(0 <= r[1] < 0.3 for r in got)  # none of them is toxic
    assert compression_toxicity.keep_clean(edge_documents(spark), model).columns == edge_documents(spark).columns
    nothing = compression_toxicity.learn(*compression_toxicity.sample(docs, docs.limit(0).withColumn("toxic", docs.n_chars), "doc_id", "text", "toxic"))
    assert {round(r[1], 6) for r in rows(compression_toxicity.score(edge_documents(spark), nothing))} == {0.0}
    assert rows(compression_toxicity.score(empty_documents(spark), model)) == []


def test_dictionaries_save_on_toxic_words_alone(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    scorer = compression_toxicity.Scorer(queries.toxicity_model(spark, docs, MIDDLE))
    saved = scorer.savings([b" idiot ", b" worthless ", b" the ", b" of ", b" and "])
    assert np.all(saved[:2] > 2) and np.all(saved[2:] <= 1)


def test_signs_are_no_letters_and_each_script_is_learned(spark):
    latin = [" ".join(f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr") + f" text {k}" for k in range(12)]
    han = ["".join(chr(0x4E00 + (7 * i + k) % 90) for i in range(200)) for k in range(60)]
    model = cross_parsing.build({"de": latin, "zh": han})
    docs = spark.createDataFrame([(1, "\U0001F600 \U0001F602 12"), (2, han[3][20:90]), (3, latin[2][5:60]), (4, "\U0001F600"), (5, "\U00020000\U00020001")],
                                 "doc_id long, text string")
    got = {r[0]: r[1:] for r in rows(cross_parsing.predict(docs, model).select("doc_id", "lang_pred", "score"))}
    assert got[1] == got[4] == ("und", 0.0) and got[2][0] == "zh" and got[3][0] == "de"
    assert cross_parsing.spread([[1] * 10, [2] * 2, [3] * 30], 20) == [[1] * 9, [2] * 2, [3] * 9]
    assert len(cross_parsing.common_letters([latin, han])) > 90
