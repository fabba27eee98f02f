"""Quality cascade, chat formatting and mixing: the native operators."""
import hashlib
import math
import re

from pyspark.sql import functions as F

import pytest

from basketry.llm import chat_format, quality_cascade, queries, temperature_mix
from basketry.oracle.harness import compare, duck_connect

from .helpers import MIDDLE, edge_documents, empty_documents, rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    ok, said = compare(queries.QUERIES[name](spark, MIDDLE), duck_connect(MIDDLE), queries.ORACLES[name])
    assert ok, said


@pytest.mark.parametrize("name", ["op2_quality_cascade", "op4_chat_format", "op10_temperature_mix"])
def test_no_python_on_the_native_path(spark, name):
    plan = queries.QUERIES[name](spark, MIDDLE)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def measured(text):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t\n\x0b\x0c\r]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures_against_brute_force(spark):
    docs = edge_documents(spark)
    got = sorted(rows(quality_cascade.measure(docs).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    assert got == sorted(measured(r.text) for r in docs.collect())


def test_any_order_of_rules_keeps_the_same_rows(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rules = quality_cascade.production_rules()
    judged = quality_cascade.measure(docs).cache()
    kept = [sorted(r[0] for r in quality_cascade.cascade(judged, o).where("rejected_by IS NULL").select("doc_id").collect()) for o in (rules, rules[::-1])]
    assert kept[0] == kept[1]
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").where("quality = 1").join(docs, "doc_id").where("length(text) > 200").select("doc_id")
    good = {r[0] for r in labels.collect()}
    assert len(good & set(kept[0])) >= 0.97 * len(good)  # clean documents stay
    order = quality_cascade.estimate(judged.limit(200), rules)
    assert sorted(r.name for r, _, _ in order) == sorted(r.name for r in rules)
    assert [s / c for _, c, s in order] == sorted((s / c for _, c, s in order), reverse=True)


def test_cascade_on_an_empty_table(spark):
    assert rows(quality_cascade.judge(empty_documents(spark))) == []


def test_fold_of_deltas_edits_and_regenerations(spark):
    said = [  # conv, turn, msg, seq, kind, role, text
        (1, 0, 1, 1, "message", "user", "hi"), (1, 1, 1, 2, "delta", "assistant", "he"), (1, 1, 1, 3, "delta", None, "llo"),
        (1, 0, 1, 4, "edit", "user", "hi there"), (1, 1, 1, 5, "regenerate", None, None), (1, 1, 1, 6, "delta", "assistant", "good "),
        (1, 1, 1, 7, "delta", "assistant", "day"), (2, 0, 1, 1, "delta", None, None), (None, None, 1, 1, "message", None, "x"),
    ]
    log = spark.createDataFrame(said, "conv_id long, turn long, msg int, seq long, kind string, role string, text string").repartition(3)
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.fold(log).collect()}
    assert got == {(1, 0): ("user", "hi there"), (1, 1): ("assistant", "good day"), (2, 0): ("", ""), (None, None): ("", "x")}


def test_template_is_reversible_and_places_are_right(spark):
    texts = ["", None, "</turn>", "<turn assistant>", r"\l\b<\\", "a\nb<b>\\", "\\", "plain", "\\### Assistant: </turn> ok"]
    said = [(k % 2, k, ["user", "assistant", "sys<t>em\\"][k % 3], t) for k, t in enumerate(texts * 150)]
    said += [said[1], (None, 0, None, "null"), (None, None, "assistant", "<")]
    rows_in = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    drawn = chat_format.render(chat_format.fold(chat_format.rows_as_events(rows_in)))
    back = chat_format.parse(drawn)
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in back.collect()), key=order) == \
        sorted(((c, t, r or "", x or "") for c, t, r, x in said), key=order)
    for conv in (0, 1):
        parts = drawn.where(F.col("conv_id") == conv).orderBy("turn", "msg").collect()
        whole = "".join(p.segment for p in parts)
        for p in parts:
            assert whole[p.segment_start:p.segment_start + len(p.segment)] == p.segment
            assert p.segment.count("<") == 2
    digest = {r.conv_id: r for r in chat_format.digest(back).collect()}
    want = "".join(f"{r or ''}\n{t or ''}\n" for c, k, r, t in sorted((s for s in said if s[0] == 0), key=lambda s: s[1]))
    assert digest[0].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert rows(chat_format.digest(chat_format.parse(chat_format.render(chat_format.fold(chat_format.rows_as_events(rows_in.limit(0))))))) == []


def test_mixture_meets_its_limits(spark):
    rows_in = [(k, "x " * (1 + k % 7), "hot" if k % 3 else f"s{k % 5}") for k in range(3000)] + [(9000, None, "empty"), (None, "a b", None)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, source string").withColumn("n", F.lit("clash"))
    mix = temperature_mix.plan_mix(docs, max_repeat=3.0)
    assert mix.count() == len(rows_in) and mix.where("blocks < 1").count() == 0  # every document at least once
    per = {r.source: r for r in mix.groupBy("source").agg(F.sum(F.col("n") * (F.col("blocks") + F.col("last").cast("int"))).alias("got"), F.sum("n").alias("t")).collect()}
    ratio = {s: r.got / r.t for s, r in per.items() if r.t}
    assert max(ratio.values()) <= 3.0 and min(ratio.values()) >= 1.0 and max(ratio.values()) > 2.5
    assert temperature_mix.mix_documents(docs, max_repeat=3.0).columns == docs.columns
    totals = docs.where("text IS NOT NULL").groupBy("source").agg(F.sum(F.size(F.split("text", " "))).cast("long").alias("tokens"))
    alpha = temperature_mix.exponent(totals, target_entropy=0.8)
    t = [r.tokens for r in totals.collect()]
    w = [x**alpha / sum(y**alpha for y in t) for x in t]
    assert abs(-sum(x * math.log(x) for x in w) / math.log(len(w)) - 0.8) < 1e-4


def test_mixture_budget_cut_and_edges(spark):
    docs = spark.createDataFrame([(k, "a b c", "one" if k < 900 else "two") for k in range(1000)], "doc_id long, text string, source string")
    mix = temperature_mix.plan_mix(docs, max_repeat=1.0, budget=600.0)
    taken = mix.withColumn("times", F.col("blocks") + F.col("last").cast("int")).agg(F.sum(F.col("times") * F.col("n"))).first()[0]
    assert 600 - 12 <= taken <= 600
    drawn = temperature_mix.draw(mix)
    assert drawn.groupBy("k", "block").count().where("count > 1").count() == 0
    assert rows(temperature_mix.draw(temperature_mix.plan_mix(empty_documents(spark), max_repeat=2.0))) == []
    assert temperature_mix.mix_documents(edge_documents(spark), max_repeat=2.0).count() >= edge_documents(spark).count()


def test_mixing_with_clashing_columns(spark):
    rows_in = [(k, "a b c" if k % 2 else "d", "s" if k < 30 else "t", 10 + k, 20, 30, 40, 50) for k in range(40)] + [(None, "x", None, 1, 2, 3, 4, 5)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, source string, _key int, _time int, _times int, k int, doc int")
    got = temperature_mix.mix_documents(docs, max_repeat=2.0)
    assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == set(rows_in)
